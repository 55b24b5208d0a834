"""Whether bytes are a whole image, read in columns from the structure of the file.

PNG: signature, then chunks of length, name, data and checksum, up to the
end chunk.  JPEG: start mark, segments with their lengths up to the scan,
end mark.  Pixels are not decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_PNG = "89504E470D0A1A0A"
_STATE = "struct<at:int,width:int,height:int,fault:string>"


def _number(content: Column, at: Column, size: int) -> Column:
    """The big-endian number of `size` bytes from the 1-based place `at`."""
    return F.conv(F.hex(F.substring(content, at, F.lit(size))), 16, 10).cast("bigint")


def _next(at, width=None, height=None, fault=None) -> Column:
    none = F.lit(None)
    return F.struct((at if isinstance(at, Column) else F.lit(at)).cast("int").alias("at"),
                    (none if width is None else width).cast("int").alias("width"),
                    (none if height is None else height).cast("int").alias("height"),
                    (none if fault is None else F.lit(fault)).cast("string").alias("fault")).cast(_STATE)


def _walk(content: Column, start: int, least: int, step) -> Column:
    """Parts of at least `least` bytes, one after the other, until `step` sets the place to 0.

    A file of n bytes has at most n / least parts; the steps after the last one do nothing.
    """
    most = F.greatest(F.octet_length(content) / least, F.lit(1)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), most), _next(start),
                       lambda state, _: F.when(state["at"] == 0, state).otherwise(step(state)))


def _png(content: Column) -> Column:
    size = F.octet_length(content)

    def step(state: Column) -> Column:
        at = state["at"]
        length = _number(content, at, 4)
        name = F.hex(F.substring(content, at + 4, F.lit(4)))
        cut = length.isNull() | (F.octet_length(F.substring(content, at, F.lit(8))) < 8) | (at + length + 11 > size)
        data = length.cast("int")
        sound = F.crc32(F.substring(content, at + 4, data + 4)) == _number(content, at + data + 8, 4)
        header = name == "49484452"
        width, height = (F.when(header, _number(content, at + 8 + k, 4)).otherwise(state[f])
                         for k, f in ((0, "width"), (4, "height")))
        return (F.when(cut, _next(0, state["width"], state["height"], "truncated"))
                .when(~sound | (header != (at == 9)) | (header & (data != 13)),
                      _next(0, state["width"], state["height"], "damaged"))
                .when(name == "49454E44", _next(0, width, height))
                .otherwise(_next(at + data + 12, width, height)))

    return _walk(content, 9, 12, step)


def _jpeg(content: Column) -> Column:
    size = F.octet_length(content)

    def step(state: Column) -> Column:
        at = state["at"]
        mark, length = _number(content, at, 2), _number(content, at + 2, 2)
        kind = mark.bitwiseAND(F.lit(255))
        cut = (F.octet_length(F.substring(content, at, F.lit(4))) < 4) | (at + length + 1 > size)
        # Marks C0 to CF start a frame, but for three that hold tables.
        frame = kind.between(0xC0, 0xCF) & ~kind.isin(0xC4, 0xC8, 0xCC)
        height, width = (F.when(frame, _number(content, at + k, 2)).otherwise(state[f])
                         for k, f in ((5, "height"), (7, "width")))
        ended = F.hex(F.substring(content, size - 1, F.lit(2))) == "FFD9"
        return (F.when(cut, _next(0, state["width"], state["height"], "truncated"))
                .when((mark < 0xFF00) | (length < 2), _next(0, state["width"], state["height"], "damaged"))
                .when((kind == 0xDA) & ~ended, _next(0, width, height, "truncated"))
                .when(kind == 0xDA, _next(0, width, height))
                .otherwise(_next(at + length + 2, width, height)))

    return _walk(content, 3, 4, step)


def image_state(content: Column) -> Column:
    """struct of format, width, height and fault of a file's bytes.

    `fault` is null for a whole image, else 'foreign' (no PNG or JPEG), 'truncated' (it ends
    before its structure does) or 'damaged' (a checksum, a part or the size is
    wrong).  Null bytes give a null format and the fault 'foreign'.
    """
    png = F.coalesce(F.hex(F.substring(content, F.lit(1), F.lit(8))) == _PNG, F.lit(False))
    jpeg = F.coalesce(F.hex(F.substring(content, F.lit(1), F.lit(3))) == "FFD8FF", F.lit(False))
    state = F.when(png, _png(content)).when(jpeg, _jpeg(content))
    sized = (state["width"] > 0) & (state["height"] > 0)
    fault = (F.when(~png & ~jpeg, "foreign").when(state["fault"].isNotNull(), state["fault"])
             .when(state["at"] != 0, "truncated").when(F.coalesce(~sized, F.lit(True)), "damaged"))
    return F.struct(F.when(png, "png").when(jpeg, "jpeg").alias("format"), state["width"].alias("width"),
                    state["height"].alias("height"), fault.alias("fault"))
