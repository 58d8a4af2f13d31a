"""Width and height from the header of an image file."""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame

DIMENSIONS = "width int, height int, error string"
#: Bytes at the beginning that hold the dimensions of every format but JPEG.
HEAD = 32
# Fixed value: JPEG frame markers, which carry the dimensions.
_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def _big(data: bytes, start: int, size: int) -> int:
    return int.from_bytes(data[start : start + size], "big")


def _little(data: bytes, start: int, size: int) -> int:
    return int.from_bytes(data[start : start + size], "little")


def _jpeg(file: BinaryIO) -> tuple[int, int]:
    """From segment to segment: what a segment holds is skipped, not read."""
    at = 2
    while True:
        file.seek(at)
        segment = file.read(9)
        if len(segment) < 9:
            raise ValueError("no JPEG frame")
        if segment[0] != 0xFF:
            raise ValueError("broken JPEG segment")
        marker = segment[1]
        if marker == 0xFF or 0xD0 <= marker <= 0xD8 or marker == 0x01:
            at += 1 if marker == 0xFF else 2
        elif marker in _FRAMES:
            return _big(segment, 7, 2), _big(segment, 5, 2)
        else:
            at += 2 + max(2, _big(segment, 2, 2))


def _webp(data: bytes) -> tuple[int, int]:
    kind = data[12:16]
    if kind == b"VP8X":
        return _little(data, 24, 3) + 1, _little(data, 27, 3) + 1
    if kind == b"VP8L" and data[20] == 0x2F:
        bits = _little(data, 21, 4)
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 " and data[23:26] == b"\x9d\x01\x2a":
        return _little(data, 26, 2) & 0x3FFF, _little(data, 28, 2) & 0x3FFF
    raise ValueError("unknown WebP chunk")


def image_size(file: BinaryIO) -> tuple[int, int]:
    """Dimensions of a PNG, JPEG, BMP or WebP file; ValueError for anything else."""
    data = file.read(HEAD)
    if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR":
        need, size = 24, (_big(data, 16, 4), _big(data, 20, 4))
    elif data[:2] == b"\xff\xd8":
        need, size = 4, _jpeg(file)
    elif data[:2] == b"BM" and _little(data, 14, 4) == 12:
        need, size = 22, (_little(data, 18, 2), _little(data, 20, 2))
    elif data[:2] == b"BM":
        height = int.from_bytes(data[22:26], "little", signed=True)
        need, size = 26, (_little(data, 18, 4), abs(height))
    elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        need, size = 30 if data[12:16] != b"VP8L" else 25, _webp(data)
    else:
        raise ValueError("unknown kind of image")
    if len(data) < need or size[0] < 1 or size[1] < 1:
        raise ValueError("image header ends early")
    return size


def measure(file: BinaryIO) -> tuple[int | None, int | None, str | None]:
    """(width, height, error) of an image file, of which only the header is read."""
    try:
        return *image_size(file), None
    except (ValueError, IndexError) as exc:
        return None, None, f"no dimensions: {exc}"


def image_dimensions(images: DataFrame) -> DataFrame:
    """Dimensions of each row's ``content``; a failure fills ``error`` instead of ending the job.
    All other columns are kept. Only the content column's rows of images should be passed."""
    kept = [f for f in images.schema.fields if f.name != "content"]
    names = [f.name for f in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [DIMENSIONS])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [measure(io.BytesIO(data or b"")) for data in batch["content"]]
            out = batch[names].copy()
            for i, name in enumerate(("width", "height")):
                out[name] = pd.array([s[i] for s in sizes], dtype="Int32")
            out["error"] = pd.array([s[2] for s in sizes], dtype="string")
            yield out

    return images.mapInPandas(work, schema)
