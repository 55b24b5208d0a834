"""A detector without a model: bright regions of grey PNG images.

For fixed cameras over a dark floor, and to run the scoring step where no network is at hand.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from sparktally.plans.frames import PERSON, Box, Scorer

#: Grey from which a pixel belongs to a region.
BRIGHT = 32


def grey_pixels(data: bytes) -> np.ndarray | None:
    """Rows of pixels of an 8-bit grey PNG that is not interlaced; None if it is none or broken."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, packed, size = 8, b"", None
    while at + 12 <= len(data):
        length, name = struct.unpack(">I4s", data[at:at + 8])
        part = data[at + 8:at + 8 + length]
        if name == b"IHDR" and length == 13:
            size = struct.unpack(">IIBBBBB", part)
        elif name == b"IDAT":
            packed += part
        at += 12 + length
    if size is None or size[2:] != (8, 0, 0, 0, 0):
        return None
    width, height = size[:2]
    try:
        lines = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, width + 1)
    except (zlib.error, ValueError):
        return None
    rows = np.zeros((height, width), np.uint8)
    above = np.zeros(width, np.int64)
    for y, line in enumerate(lines):
        kind, row = line[0], line[1:].astype(np.int64)
        if kind == 1:  # differences along the row
            row = np.cumsum(row) & 255
        elif kind == 2:  # differences to the row above
            row = (row + above) & 255
        elif kind:
            return None
        rows[y] = above = row
    return rows


def regions(bright: np.ndarray) -> list[tuple[int, int, int, int]]:
    """x1, y1, x2, y2 (ends exclusive) around each region of touching pixels, in order of their first pixel."""
    boxes: list[list[int] | int] = []  # a region, or the region it was joined to

    def top(i: int) -> int:
        while isinstance(boxes[i], int):
            i = boxes[i]
        return i

    before: list[tuple[int, int, int]] = []
    for y, row in enumerate(bright):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], row.astype(np.int8), [0]]))).tolist()
        now = []
        for x1, x2 in zip(edges[::2], edges[1::2]):
            touching = sorted({top(i) for a, b, i in before if a < x2 and x1 < b})
            mine = touching[0] if touching else len(boxes)
            if not touching:
                boxes.append([x1, y, x2, y + 1])
            for other in touching[1:]:
                a, b = boxes[mine], boxes[other]
                boxes[mine], boxes[other] = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])], mine
            box = boxes[mine]
            boxes[mine] = [min(box[0], x1), box[1], max(box[2], x2), y + 1]
            now.append((x1, x2, mine))
        before = now
    return [tuple(b) for b in boxes if not isinstance(b, int)]


def bright_regions() -> Scorer:
    """A scorer: a region taller than wide is a person, any other an object; confidence is its mean brightness."""
    def boxes(data: bytes) -> list[Box] | None:
        pixels = grey_pixels(data)
        if pixels is None:
            return None
        found = []
        for x1, y1, x2, y2 in regions(pixels >= BRIGHT):
            kind = PERSON if y2 - y1 > x2 - x1 else "object"
            found.append((kind, float(pixels[y1:y2, x1:x2].mean()) / 255, (float(x1), float(y1), float(x2), float(y2))))
        return found

    return lambda images: [boxes(image) for image in images]
