"""Tile manifests: stage positions and registered views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_position(chars: Column) -> Column:
    """Number stored as an array of characters."""
    return F.array_join(chars, "").try_cast("double")


def tile_manifest(tiles: DataFrame) -> DataFrame:
    """``tile, x, y, z`` from character-array positions; a missing position is 0, z is fixed at 0."""
    return tiles.select(
        "tile",
        F.coalesce(parse_position(F.col("x_chars")), F.lit(0.0)).alias("x"),
        F.coalesce(parse_position(F.col("y_chars")), F.lit(0.0)).alias("y"),
        F.lit(0.0).alias("z"),
    )


def select_tile_channel(tile_blocks: DataFrame, channel: str) -> DataFrame:
    """One channel of the tile payloads; an unknown channel is an error."""
    chosen = tile_blocks.filter(F.col("channel") == channel)
    if not chosen.take(1):
        raise ValueError(f"channel {channel!r} not found")
    return chosen


def tile_views(offsets: DataFrame, n_channels: int) -> DataFrame:
    """One view per tile and channel: row-major 3x4 matrix, identity with the offset as translation."""
    one, zero = F.lit(1.0), F.lit(0.0)
    matrix = F.array(
        F.array(one, zero, zero, F.col("ox").cast("double")),
        F.array(zero, one, zero, F.col("oy").cast("double")),
        F.array(zero, zero, one, F.col("oz").cast("double")),
    )
    return offsets.withColumn("channel", F.explode(F.sequence(F.lit(0), F.lit(n_channels - 1)))).select(
        "tile", "channel", matrix.alias("affine"), F.format_string("tile %d translation", "tile").alias("name")
    )
