"""Dense 1..n numbering of distinct values without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelweave.functions.sizing import cut_lineage


def global_rank(values: DataFrame, order: str, name: str) -> DataFrame:
    """Number rows 1..n by ``order``: range partition, number inside each part, add offsets.

    The range-partitioned rows are checkpointed first, because the partition borders are
    sampled and must not change between the two passes.
    """
    parts = cut_lineage(values.repartitionByRange(F.col(order)).withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return (
        parts.withColumn("inside", inside)
        .join(offsets, "part")
        .withColumn(name, (F.col("inside") + F.col("offset")).cast("bigint"))
        .drop("part", "inside", "offset")
    )
