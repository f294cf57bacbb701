"""Segmented objects as a table: measurement, filtering, paging and dataset statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.model import AXES, DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE, Shape


def region_props(labels: DataFrame, min_object_size: int = 1) -> DataFrame:
    """One row per label > 0: area, half-open bounding box and centroid.

    All aggregates are partially combined before the only shuffle, so a label that owns a
    third of the voxels costs one row per task.
    """
    aggs = [F.count(F.lit(1)).alias("area")]
    aggs += [F.min(a).alias(f"min_{a}") for a in AXES]
    aggs += [(F.max(a) + 1).alias(f"max_{a}") for a in AXES]
    aggs += [F.avg(a).alias(f"c{a}") for a in AXES]
    props = labels.filter("label > 0").groupBy("label").agg(*aggs)
    return filter_by_size(props, min_object_size) if min_object_size > 1 else props


def filter_by_size(nuclei: DataFrame, min_object_size: int) -> DataFrame:
    return nuclei.filter(F.col("area") >= min_object_size)


def object_count(nuclei: DataFrame) -> DataFrame:
    return nuclei.agg(F.count(F.lit(1)).alias("num_objects"))


def padded_bbox(nuclei: DataFrame, pad_xy: int, shape: Shape) -> DataFrame:
    """Widen the box in y and x only, clipped to the volume; adds ``pmin_*``/``pmax_*``."""
    cols = {"pmin_z": F.col("min_z"), "pmax_z": F.col("max_z")}
    for axis, n in (("y", shape.ny), ("x", shape.nx)):
        cols[f"pmin_{axis}"] = F.greatest(F.col(f"min_{axis}") - pad_xy, F.lit(0).cast("bigint"))
        cols[f"pmax_{axis}"] = F.least(F.col(f"max_{axis}") + pad_xy, F.lit(n).cast("bigint"))
    return nuclei.withColumns(cols)


def nucleus_by_label(nuclei: DataFrame, label: int) -> DataFrame:
    return nuclei.filter(F.col("label") == label)


def nuclei_page(nuclei: DataFrame, page: int, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Slice ``[page * size, (page + 1) * size)`` in label order with paging flags.

    ``orderBy.limit.offset`` keeps only ``(page + 1) * size`` rows per task; the total is one
    scalar aggregate.
    """
    if page < 0 or not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page must be >= 0 and page_size in 1..{MAX_PAGE_SIZE}")
    counted = nuclei.agg(F.count(F.lit(1)).alias("n")).scalar()
    pages = F.ceil(counted / F.lit(page_size)).cast("bigint")
    return (
        nuclei.orderBy("label")
        .offset(page * page_size)
        .limit(page_size)
        .withColumns({"total_nuclei": counted, "total_pages": pages})
        .withColumns(
            {
                "page": F.lit(page).cast("bigint"),
                "has_next": F.col("total_pages") > page + 1,
                "has_previous": F.lit(page > 0),
            }
        )
    )


def total_pages(nuclei: DataFrame, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    return nuclei.agg(F.ceil(F.count(F.lit(1)) / F.lit(page_size)).cast("bigint").alias("total_pages"))


def upper_median(df: DataFrame, value: str) -> DataFrame:
    """Element ``n div 2`` (0-based) of the sorted values, one row.

    The discrete median of the descending order is the upper element for an even count. It is
    computed from value counts, which are merged per task before the exchange.
    """
    return df.agg(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)").alias("median"))


def nuclei_stats(nuclei: DataFrame) -> DataFrame:
    """One row: count, area min/max/mean/upper median and centroid ranges (zeros when empty)."""
    aggs = [F.count(F.lit(1)).alias("total_nuclei")]
    aggs += [f("area").alias(f"area_{n}") for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    for a in AXES:
        aggs += [F.min(f"c{a}").alias(f"c{a}_min"), F.max(f"c{a}").alias(f"c{a}_max")]
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY area DESC)").cast("bigint").alias("area_median")
    return nuclei.agg(*aggs, median).na.fill(0)
