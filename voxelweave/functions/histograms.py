"""Exact statistics of dense images from sparse rows, through value histograms.

A uint16 image has at most 65 536 distinct values, so one histogram row per value is a
bounded summary of any number of voxels, and background voxels are added as one row
instead of being materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense_histogram(rows: DataFrame, keys: list[str], sizes: DataFrame, value: str = "value") -> DataFrame:
    """``keys, value, n`` over dense images.

    ``sizes`` has one row per image: ``keys`` and the dense voxel count ``dense_size``; the
    voxels not present in ``rows`` are counted under value 0.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    # Each stored voxel counts once under its value and is taken off the background count; both
    # entries meet in the per-task aggregation, so there is one scan and one exchange.
    entries = F.array(
        F.struct(F.col(value).cast("bigint").alias("value"), one.alias("n")), F.struct(zero.alias("value"), (-one).alias("n"))
    )
    stored = rows.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.value", "e.n")
    background = sizes.select(*keys, zero.alias("value"), F.col("dense_size").cast("bigint").alias("n"))
    return stored.unionByName(background).groupBy(*keys, "value").agg(F.sum("n").alias("n")).filter("n > 0")


def percentiles(histogram: DataFrame, keys: list[str], named: dict[str, float]) -> DataFrame:
    """Exact linearly interpolated percentiles (0..100) per image; also ``vmin``/``vmax``."""
    aggs: list[Column] = [
        F.percentile("value", F.lit(p / 100.0), F.col("n")).alias(name) for name, p in named.items()
    ]
    aggs += [F.min("value").alias("vmin"), F.max("value").alias("vmax")]
    return histogram.groupBy(*keys).agg(*aggs)
