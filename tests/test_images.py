"""Images told from their bytes, in columns, and the detector that needs no model."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktally.functions.images import image_state
from sparktally.plans import blobs


def chunk(name, data):
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def png(pixels, more=(), kinds=None):
    height, width = pixels.shape
    lines = bytearray()
    for y in range(height):
        kind = kinds[y] if kinds else 0
        row = pixels[y].astype(np.int64)
        if kind == 1:
            row = np.diff(row, prepend=0)
        if kind == 2:
            row = row - (pixels[y - 1] if y else 0)
        lines += bytes([kind]) + (row & 255).astype(np.uint8).tobytes()
    packed = zlib.compress(bytes(lines))
    parts = [chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)), *more,
             chunk(b"IDAT", packed[:7]), chunk(b"IDAT", packed[7:]), chunk(b"IEND", b"")]
    return b"\x89PNG\r\n\x1a\n" + b"".join(parts)


def jpeg(width=30, height=20, scan=b"\x01\x02\xff\x00\x03", end=b"\xff\xd9"):
    segment = lambda mark, data: bytes([255, mark]) + struct.pack(">H", len(data) + 2) + data
    return (b"\xff\xd8" + segment(0xE0, b"JFIF\0" + bytes(9)) + segment(0xDB, bytes(65)) + segment(0xC4, bytes(20))
            + segment(0xC0, struct.pack(">BHHB", 8, height, width, 1) + bytes(3)) + segment(0xDA, bytes(8)) + scan + end)


def states(spark, files):
    df = spark.createDataFrame([(i, bytearray(x) if x is not None else None) for i, x in enumerate(files)], "i int, x binary")
    return [tuple(r[1]) for r in df.select("i", image_state(F.col("x"))).orderBy("i").collect()]


PIXELS = np.arange(12 * 9).reshape(9, 12) % 256


def test_whole_images(spark):
    text = chunk(b"tEXt", b"Comment\0hello")
    assert states(spark, [png(PIXELS), png(PIXELS, [text] * 40), jpeg(), jpeg(1, 65535)]) == [
        ("png", 12, 9, None), ("png", 12, 9, None), ("jpeg", 30, 20, None), ("jpeg", 1, 65535, None)]


def test_every_cut_is_found(spark):
    for whole, kind in ((png(PIXELS), "png"), (jpeg(), "jpeg")):
        found = states(spark, [whole[:n] for n in range(len(whole))])
        assert [f[3] for f in found if f[0] is None] == ["foreign"] * (8 if kind == "png" else 3)
        assert {f[3] for f in found if f[0] == kind} == {"truncated"}


def test_foreign_and_damaged_files(spark):
    whole = png(PIXELS)
    rng = random.Random(1)
    flipped = []
    for _ in range(40):
        at = rng.randrange(8, len(whole))
        flipped.append(whole[:at] + bytes([whole[at] ^ (1 << rng.randrange(8))]) + whole[at + 1:])
    assert all(f[3] in ("damaged", "truncated") for f in states(spark, flipped))
    odd = [None, b"", b"GIF89a....", b"<html>", png(np.zeros((0, 5), np.uint8)), jpeg(0, 5),
           b"\x89PNG\r\n\x1a\n" + chunk(b"IDAT", b"x") + chunk(b"IEND", b""), b"\xff\xd8\xff\x00" * 9]
    assert [f[3] for f in states(spark, odd)] == ["foreign"] * 4 + ["damaged"] * 3 + ["truncated"]


def by_hand(bright):
    """Regions by flooding from each pixel."""
    seen, out = set(), []
    for y, x in zip(*np.nonzero(bright)):
        if (y, x) in seen:
            continue
        todo, mine = [(y, x)], []
        seen.add((y, x))
        while todo:
            a, b = todo.pop()
            mine.append((a, b))
            for c, d in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if 0 <= c < bright.shape[0] and 0 <= d < bright.shape[1] and bright[c, d] and (c, d) not in seen:
                    seen.add((c, d))
                    todo.append((c, d))
        ys, xs = zip(*mine)
        out.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    return sorted(out)


@pytest.mark.parametrize("seed", range(8))
def test_regions_equal_flooding(seed):
    rng = np.random.default_rng(seed)
    bright = rng.random((20, 17)) < (0.3 + 0.05 * seed)
    assert sorted(blobs.regions(bright)) == by_hand(bright)


def test_pixels_and_boxes():
    pixels = np.zeros((20, 30), np.uint8)
    pixels[2:12, 3:7], pixels[15:18, 10:25] = 204, 51
    for kinds in (None, [1] * 20, [2] * 20, [y % 3 for y in range(20)]):
        assert (blobs.grey_pixels(png(pixels, kinds=kinds)) == pixels).all()
    score = blobs.bright_regions()
    assert score([png(pixels), b"no image", png(pixels)[:60], jpeg(), png(pixels, kinds=[3] * 20)]) == [
        [("person", 0.8, (3.0, 2.0, 7.0, 12.0)), ("object", 0.2, (10.0, 15.0, 25.0, 18.0))], None, None, None, None]
