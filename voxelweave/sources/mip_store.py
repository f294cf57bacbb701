"""Stored projections: compute only what is missing, recompute on request, inspect, clear."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelweave.functions.sizing import written
from voxelweave.operators.projections import crop_pixels, masked_voxels, missing_mips, nucleus_mip

MIP_SCHEMA = "label bigint, channel string, y bigint, x bigint, value bigint"


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The stored projections; empty when nothing was written yet."""
    try:
        return spark.read.schema(MIP_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], MIP_SCHEMA)


def materialize_mips(
    path: str, labels: DataFrame, voxels: DataFrame, nuclei: DataFrame, channels: list[str], force: bool = False
) -> DataFrame:
    """Project the (label, channel) pairs not stored yet, append them and return the store.

    ``nuclei`` carries padded boxes. ``force`` recomputes every wanted pair: channels touched
    are rewritten through dynamic partition overwrite, keeping the other labels' rows.
    """
    spark = labels.sparkSession
    stored = read_store(spark, path)
    if force:
        wanted = nuclei.select("label", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"))
        kept = stored.filter(F.col("channel").isin(channels)).join(wanted, ["label", "channel"], "left_anti")
    else:
        wanted = missing_mips(nuclei, channels, stored)
        kept = None
    crops = crop_pixels(nuclei, channels).join(wanted, ["label", "channel"], "left_semi")
    masked = masked_voxels(labels, voxels.filter(F.col("channel").isin(channels)), nuclei)
    fresh = nucleus_mip(masked.join(wanted, ["label", "channel"], "left_semi"), crops)
    if kept is None:
        fresh.write.mode("append").partitionBy("channel").parquet(path)
    else:
        staged = written(fresh.unionByName(kept), "mip-store-stage")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("channel").parquet(path)
    return read_store(spark, path)


def store_info(store: DataFrame) -> DataFrame:
    """Per channel: how many objects are stored."""
    return store.groupBy("channel").agg(F.countDistinct("label").alias("stored_objects"))


def clear_store(spark: SparkSession, path: str) -> None:
    """Forget every stored projection (the table becomes empty)."""
    spark.createDataFrame([], MIP_SCHEMA).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("channel").parquet(path)
