"""Volume tables: ingestion of raw slabs, partitioned storage, catalog, cropping, slice export."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelweave.functions.columns import within
from voxelweave.functions.sizing import written
from voxelweave.model import BLOCK_KEY, DEFAULT_COLOR, NUCLEAR_STAIN_COLOR, Shape
from voxelweave.operators.blocks import DEFAULT_BLOCK, reblock
from voxelweave.sources import slabs

VOLUME = ["round", "channel"]


def ingest_round(
    spark: SparkSession, files: dict[str, str], round_name: str, shape: Shape, block: Shape = DEFAULT_BLOCK,
    dtype: str = "uint16",
) -> DataFrame:
    """Blocks of every channel of one round."""
    return ingest_all_rounds(spark, {round_name: files}, shape, block, dtype)


def ingest_all_rounds(
    spark: SparkSession, rounds: dict[str, dict[str, str]], shape: Shape, block: Shape = DEFAULT_BLOCK,
    dtype: str = "uint16",
) -> DataFrame:
    """Blocks of all rounds and channels in one scan (round and channel are columns).

    Files are listed here (see :func:`slabs.list_slabs` for their order and for what is an error); their bytes are read by ranges, block
    layer by block layer, and filters on round, channel and ``z0`` decide which.
    """
    plane = shape.ny * shape.nx * np.dtype(dtype).itemsize
    found = [(r, c, slabs.list_slabs(spark, path, plane)) for r, files in rounds.items() for c, path in files.items()]
    if not found:
        raise ValueError("no rounds to ingest")
    return slabs.read_slabs(spark, found, shape, block, dtype)


def write_raw_slabs(blocks: DataFrame, shape: Shape, folder: str, slab_nz: int, strip_rows: int = 64, dtype: str = "uint16") -> DataFrame:
    """Files ``folder/round/channel/slab_N.raw`` of ``slab_nz`` slices each (the last may be lower); returns their list.

    A slab is streamed strip by strip, so a task holds one strip whatever the size of the file.
    """
    strips = _strips(blocks, shape, strip_rows, dtype).withColumn("slab", F.floor(F.col("z") / slab_nz).cast("bigint"))
    placed = strips.repartition(*VOLUME, "slab").sortWithinPartitions(*VOLUME, "slab", "z", "y0").select(*VOLUME, "slab", "data")
    listed = "round string, channel string, slab bigint, path string, length bigint, dtype string"
    return written(placed.mapInArrow(slabs.slab_writer(folder, dtype), listed), "raw-slabs")


def write_volume(volume: DataFrame, path: str, mode: str = "overwrite", key: str | None = None) -> None:
    """Store blocks or voxels partitioned by round and channel, sorted for row-group pruning.

    ``key`` adds a named array level above the partitions. Rows are spread by position too, so
    one large channel is written by many tasks.
    """
    order = [c for c in (*BLOCK_KEY, "z", "y", "x") if c in volume.columns]
    parts = VOLUME
    if key is not None:
        volume, parts = volume.withColumn("array_key", F.lit(key)), ["array_key", *VOLUME]
    spread = volume.repartition(*VOLUME, *order[:2]) if order else volume
    spread.sortWithinPartitions(*VOLUME, *order).write.mode(mode).partitionBy(*parts).parquet(path)


def read_volume(
    spark: SparkSession, path: str, round_name: str | None = None, channel: str | None = None, key: str | None = None
) -> DataFrame:
    """Open a stored volume; round, channel and key are partition filters (pruned at planning)."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from None
        raise
    # Names of rounds, channels and keys are text even when they look like numbers.
    names = ("array_key", *VOLUME)
    fields = [T.StructField(f.name, T.StringType() if f.name in names else f.dataType) for f in stored.schema.fields]
    stored = spark.read.schema(T.StructType(fields)).parquet(path)
    if "array_key" in stored.columns:
        if key is None or stored.filter(F.col("array_key") == key).isEmpty():
            problem = "a key is required" if key is None else f"key {key!r} not found"
            first = [r[0] for r in stored.select("array_key").distinct().orderBy("array_key").limit(20).collect()]
            raise KeyError(f"{problem}; the first keys are: {first}")
        stored = stored.filter(F.col("array_key") == key).drop("array_key")
    elif key is not None:
        warnings.warn(f"key {key!r} ignored: {path} holds a single array", stacklevel=2)
    if round_name is not None:
        stored = stored.filter(F.col("round") == round_name)
    if channel is not None:
        stored = stored.filter(F.col("channel") == channel)
    return stored


def catalog(blocks: DataFrame) -> DataFrame:
    """Name, shape, dtype and block count of every stored (round, channel) volume."""
    ends = [F.max(F.col(f"{a}0") + F.col(f"n{a}")).alias(f"size_{a}") for a in "zyx"]
    return blocks.groupBy(*VOLUME).agg(*ends, F.max("dtype").alias("dtype"), F.count(F.lit(1)).alias("blocks"))


def voxel_catalog(voxels: DataFrame, dtype: str = "uint16") -> DataFrame:
    """Catalog of voxel-form volumes (extent of the stored voxels)."""
    ends = [(F.max(a) + 1).alias(f"size_{a}") for a in "zyx"]
    return voxels.groupBy(*VOLUME).agg(*ends, F.lit(dtype).alias("dtype"), F.count(F.lit(1)).alias("stored"))


def configured_channels(configured: DataFrame, stored: DataFrame, stain: str = "dapi") -> DataFrame:
    """Configured channels with type, display colour and whether a volume exists."""
    joined = configured.join(stored.withColumn("found", F.lit(True)), "channel", "left")
    is_stain = F.col("channel") == stain
    return joined.select(
        "channel",
        F.when(is_stain, "dapi").otherwise("epitope").alias("type"),
        F.when(is_stain, NUCLEAR_STAIN_COLOR).otherwise(F.coalesce("color", F.lit(DEFAULT_COLOR))).alias("color"),
        F.coalesce("found", F.lit(False)).alias("exists"),
        *[f"size_{a}" for a in "zyx"],
        "dtype",
    )


def common_shape(volumes: DataFrame) -> DataFrame:
    """One row: element-wise minimum of the catalogued shapes."""
    return volumes.agg(*[F.min(f"size_{a}").alias(f"size_{a}") for a in "zyx"])


def common_extent(volumes: DataFrame) -> Shape:
    row = common_shape(volumes).first()
    if row is None or row[0] is None:
        raise ValueError("no volumes to compare")
    return Shape(*(int(v) for v in row))


def crop(voxels: DataFrame, shape: Shape) -> DataFrame:
    """Voxels inside ``shape``; literal bounds reach the scan as pushed filters."""
    return voxels.filter(within(shape))


def export_slices(blocks: DataFrame, shape: Shape, strip_rows: int, dtype: str = "uint16") -> DataFrame:
    """Ordered image strips ``round, channel, z, y0, h, w, data`` of ``strip_rows`` rows each (the last may be lower).

    ``strip_rows = shape.ny`` gives whole slices. A task holds one strip at a time; strips without
    any stored block are filled with zeros.
    """
    full = _strips(blocks, shape, strip_rows, dtype)
    return full.repartitionByRange(*VOLUME, "z", "y0").sortWithinPartitions(*VOLUME, "z", "y0")


def _strips(blocks: DataFrame, shape: Shape, strip_rows: int, dtype: str) -> DataFrame:
    itemsize = np.dtype(dtype).itemsize
    strips = reblock(blocks, shape, Shape(1, strip_rows, shape.nx)).select(
        *VOLUME, F.col("z0").alias("z"), "y0", "data"
    )
    last = (shape.ny - 1) // strip_rows
    index = (
        blocks.select(*VOLUME).distinct()
        .withColumn("z", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shape.nz - 1).cast("bigint"))))
        .withColumn("y0", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))))
        .withColumn("y0", F.col("y0") * strip_rows)
        .withColumn("h", F.least(F.lit(strip_rows), F.lit(shape.ny) - F.col("y0")).cast("int"))
    )
    empty = F.expr(f"unhex(repeat('00', CAST(h AS INT) * {shape.nx * itemsize}))")
    full = index.join(strips, [*VOLUME, "z", "y0"], "left")
    return full.select(*VOLUME, "z", "y0", "h", F.lit(shape.nx).alias("w"), F.coalesce("data", empty).alias("data"))
