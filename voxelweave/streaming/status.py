"""Streaming faces of the run ledger: live step status and windowed status counts.

The status aggregate has no watermark (its state is one row per step); late log rows are
therefore always applied. The windowed counts use a watermark, so their state is bounded by
time and only they may drop very late rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_log_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream of log rows from Parquet files; ``ts`` becomes an instant for watermarks."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_status(log: DataFrame) -> DataFrame:
    """Latest status per step, updated as rows arrive."""
    return log.groupBy("step_id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status"),
        F.max(F.struct("ts", "event_id"))["event_id"].alias("event_id"),
        F.count(F.lit(1)).alias("updates"),
    )


def stream_counts(log: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Tumbling counts per status."""
    return (
        log.withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"), "status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "status", "n")
    )


def write_updates(updates: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Update-mode sink: each micro-batch overwrites its own folder, so retries are idempotent."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        updates.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state from the update folders: the row of the highest batch per key."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*keys, "v.*")


def run_to_end(
    log: DataFrame, aggregate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, keys: list[str]
) -> DataFrame:
    """Process everything available now and return the resulting state."""
    query = write_updates(aggregate(log), path, checkpoint)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return latest_updates(log.sparkSession, path, keys)
