"""JSON documents: registration summaries, run state and processing reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTRATION_TYPE = "two_stage_affine_deformation"


def _volume(cat: DataFrame, name: str) -> DataFrame:
    shape = F.array(*[F.col(f"size_{a}") for a in "zyx"])
    return cat.select(
        F.struct(F.concat_ws("/", "round", "channel").alias("path"), shape.alias("shape"), "dtype").alias(name),
        F.lit(1).alias("one"),
    )


def registration_summary(
    fixed: DataFrame, moving: DataFrame, aligned: DataFrame, matrix: list[list[float]], affine_path: str,
    field_path: str,
) -> DataFrame:
    """One JSON row describing a registration; each input is a one-row catalog entry."""
    row = _volume(fixed, "fixed").join(_volume(moving, "moving"), "one").join(_volume(aligned, "aligned"), "one")
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in matrix])
    doc = F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct("fixed", "moving").alias("input_volumes"),
        F.struct(
            F.lit(affine_path).alias("affine_matrix_path"), rows.alias("affine_matrix"),
            F.lit(field_path).alias("deformation_field_path"),
        ).alias("transformations"),
        F.struct(
            F.col("aligned.path").alias("aligned_volume_path"), F.col("aligned.shape").alias("aligned_shape"),
            F.col("aligned.dtype").alias("aligned_dtype"),
        ).alias("output"),
        F.lit(REGISTRATION_TYPE).alias("registration_type"),
    )
    return row.select(F.to_json(doc).alias("value"))


def processing_report(runs: DataFrame, config_json: str = "{}") -> DataFrame:
    """One JSON row from a run table ``kind, name, detail``: counts per kind and the entries.

    Kinds are round, registration and segmentation: a handful of rows per processed round.
    """
    def entries(kind: str):
        entry = F.when(F.col("kind") == kind, F.struct("name", "detail"))
        return F.sort_array(F.collect_list(entry))

    def count(kind: str):
        return F.count(F.when(F.col("kind") == kind, 1))

    doc = F.struct(
        F.struct(
            count("round").alias("total_rounds_processed"), count("registration").alias("total_registrations"),
            count("segmentation").alias("total_segmentations"), F.lit(config_json).alias("processing_config"),
        ).alias("pipeline_summary"),
        entries("round").alias("rounds_processed"), entries("registration").alias("registration_results"),
        entries("segmentation").alias("segmentation_results"),
    )
    stamped = runs.agg(doc.alias("d")).select(
        F.to_json(F.struct("d.*", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("report_timestamp"))).alias("value")
    )
    return stamped


def write_json(documents: DataFrame, path: str) -> None:
    """Write JSON rows (column ``value``) as text files."""
    documents.select("value").write.mode("overwrite").text(path)
