"""Image sink: projections as PNG data URIs, one row per image."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def png_bytes(pixels: np.ndarray) -> bytes:
    """8-bit grayscale (h, w) or RGB (h, w, 3) image as a PNG file."""
    if pixels.ndim == 2:
        color = 0
    elif pixels.ndim == 3 and pixels.shape[2] == 3:
        color = 2
    else:
        raise ValueError(f"unsupported image shape {pixels.shape}")
    h, w = pixels.shape[:2]
    rows = np.ascontiguousarray(pixels, dtype=np.uint8).reshape(h, -1)
    body = np.hstack([np.zeros((h, 1), dtype=np.uint8), rows]).tobytes()

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    header = struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def pack_images(pixels: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Pixel rows -> one row per image row (scan line), then per image: ``keys, h, w, data``.

    Two-level grouping: lines are built first and images from lines, so an aggregation buffer
    holds one value per pixel of one object crop. ``data`` is uint8, band-interleaved.
    """
    value = F.struct("x", *bands)
    lines = pixels.groupBy(*keys, "y").agg(F.sort_array(F.collect_list(value)).alias("line"))
    return lines.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("y", "line"))).alias("lines"))


def _band(name: str):
    """Array of scan lines (arrays of integers) of one band."""
    return F.transform("lines", lambda line: F.transform(line["line"], lambda pixel: pixel[name].cast("int")))


def render_png(pixels: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """``keys, h, w, uri`` with a base64 PNG data URI per image; values are clipped to 0..255."""
    packed = pack_images(pixels, keys, bands)
    fields = [_band(b).alias(b) for b in bands]
    images = packed.select(*keys, *fields)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema.fields[: len(keys)])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[keys].copy()
            pngs, heights, widths = [], [], []
            for row in batch[bands].itertuples(index=False):
                planes = [np.clip(np.vstack(list(band)), 0, 255).astype(np.uint8) for band in row]
                image = planes[0] if len(planes) == 1 else np.dstack(planes)
                heights.append(image.shape[0])
                widths.append(image.shape[1])
                pngs.append(png_bytes(image))
            out["h"], out["w"], out["png"] = heights, widths, pngs
            yield out

    encoded = images.mapInPandas(encode, f"{key_schema}, h int, w int, png binary")
    return encoded.select(*keys, "h", "w", F.concat(F.lit("data:image/png;base64,"), F.base64("png")).alias("uri"))
