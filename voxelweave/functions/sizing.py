"""Written tables in the shared folder, and lineage cuts that survive executor loss.

Joins with small tables carry no hint: adaptive execution broadcasts a side whose measured size allows it.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's ``spark.checkpoint.dir``.

    A single-process session (``local[...]``, as in tests) without the setting gets a temporary
    folder; any other session must name a folder that driver and executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="voxelweave-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{workspace(spark)}/voxelweave/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; used once per round by iterative operators."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(workspace(spark))
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """State of an iterative operator, written once and read back, whatever its size."""
    return written(df, "state")


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Materialise as Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows by ``keys`` over all shuffle partitions, ahead of a per-group kernel.

    Adaptive execution sizes partitions by bytes and would put many small but compute-heavy
    blocks into one task; an explicit count is left alone, and the grouping reuses this exchange.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Rows of one partition ahead of a wide aggregation.
PART_ROWS = 1_000_000


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: the session's number, or more where one would outgrow ``PART_ROWS``.

    The session's number stands still while tables grow, and with it the memory of a task.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / PART_ROWS))
