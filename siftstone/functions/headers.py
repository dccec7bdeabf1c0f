"""Sides of images from the first bytes of their files: PNG, GIF, BMP, JPEG and WebP.

Only headers are read, as a viewer does that opens a file without decoding it: a file whose picture is cut off has its
sides. Batches of file contents come as Arrow arrays; of formats whose sides stand at a fixed place no more than the
first bytes are handed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import unpack_from

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the formats keep their sides, and the markers of a JPEG's frames.
FIXED_PART = 32
FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
ALONE = frozenset(range(0xD0, 0xD8)) | {0x01}
UNREADABLE = (-1, -1)


def _png(b: bytes) -> tuple[int, int]:
    if b[12:16] != b"IHDR":
        return UNREADABLE
    return unpack_from(">II", b, 16)


def _gif(b: bytes) -> tuple[int, int]:
    return unpack_from("<HH", b, 6)


def _bmp(b: bytes) -> tuple[int, int]:
    if unpack_from("<I", b, 14)[0] == 12:  # the oldest kind has short sides
        return unpack_from("<HH", b, 18)
    w, h = unpack_from("<ii", b, 18)
    return w, abs(h)  # a negative height: rows from the top


def _webp(b: bytes) -> tuple[int, int]:
    kind = b[12:16]
    if kind == b"VP8X":  # the canvas, in 24 bits each, less one
        return int.from_bytes(b[24:27], "little") + 1, int.from_bytes(b[27:30], "little") + 1
    if kind == b"VP8L" and b[20] == 0x2F:
        bits = unpack_from("<I", b, 21)[0]
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 " and b[23:26] == b"\x9d\x01\x2a":
        w, h = unpack_from("<HH", b, 26)
        return w & 0x3FFF, h & 0x3FFF
    return UNREADABLE


def _jpeg(b: bytes) -> tuple[int, int]:
    """The first frame header; segments before it are passed over by their lengths."""
    at = 2
    while True:
        if b[at] != 0xFF:
            return UNREADABLE
        while b[at] == 0xFF:  # a marker may be preceded by any number of these
            at += 1
        marker = b[at]
        at += 1
        if marker in FRAMES:
            h, w = unpack_from(">HH", b, at + 3)
            return w, h
        if marker in (0xD9, 0xDA):  # the end, or the picture itself
            return UNREADABLE
        if marker not in ALONE:
            at += max(2, unpack_from(">H", b, at)[0])


def sides(b: bytes | None) -> tuple[int, int]:
    """(width, height), or (-1, -1) of what is no image of these formats, is damaged before its sides, or has none."""
    from struct import error

    b = b or b""
    read = _png if b[:8] == b"\x89PNG\r\n\x1a\n" else _gif if b[:6] in (b"GIF87a", b"GIF89a") else _jpeg if b[:2] == b"\xff\xd8" else _bmp if b[:2] == b"BM" else _webp if b[:4] == b"RIFF" and b[8:12] == b"WEBP" else None
    if read is None:
        return UNREADABLE
    try:
        w, h = read(b)
    except (IndexError, error):  # cut off before the sides
        return UNREADABLE
    return (w, h) if w > 0 and h > 0 else UNREADABLE


def image_size(content: Column) -> Column:
    """struct(width, height) of a file's content; -1 each where sides() has none, nulls included."""

    @F.arrow_udf("width int, height int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [sides(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays([pa.array([w for w, _ in found], pa.int32()), pa.array([h for _, h in found], pa.int32())], ["width", "height"])

    jpeg = F.substring(content, 1, 2) == F.lit(b"\xff\xd8")
    return run(F.when(jpeg, content).otherwise(F.substring(content, 1, FIXED_PART)))
