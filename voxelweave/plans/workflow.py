"""Whole runs: ingest, segment, register, align and report, tracked in the append-only ledger.

Each arrow is a table in the working directory, so an interrupted run resumes from the last
completed step and lost executors only repeat one step's tasks.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable
from dataclasses import asdict

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelweave.model import BLOCK_SCHEMA, Shape
from voxelweave.operators import objects as ob
from voxelweave.operators import registration as rg
from voxelweave.operators import resample as rs
from voxelweave.operators.blocks import to_blocks, to_voxels
from voxelweave.operators.components import segment_blocks
from voxelweave.plans import ledger as ld
from voxelweave.plans.config import RunConfig, rounds_table
from voxelweave.sources import reports, volumes

LOG_SCHEMA = "step_id string, status string, ts timestamp, event_id bigint, note string"
RUN_SCHEMA = "kind string, name string, detail string"


def segment_volume(
    blocks: DataFrame, shape: Shape, block: Shape, factors=(1, 3, 3), downsample: bool = True, upsample: bool = True,
    sigma: float = 2.0, fn: Callable | None = None, halo: int = 4,
) -> DataFrame:
    """Label one volume, optionally at reduced resolution; ``label, z, y, x``.

    Enlarged masks are given the original shape, so no border voxels are lost.
    """
    small = shape
    if downsample:
        small = shape.scaled_down(factors)
        blocks = to_blocks(rs.downsample(to_voxels(blocks), shape, factors), small, block)
    labels = segment_blocks(blocks, small, block, sigma, halo, fn)
    if downsample and upsample:
        labels = rs.upsample_labels(labels, small, target=shape)
    return labels


# Folder of a planned output by the end of its name; those of a registration lie in its round's folder.
FOLDERS = {
    "_affine_matrix.txt": "matrix",
    "_deformation_field.zarr": "field",
    "_final_aligned.zarr": "aligned",
    "_summary.json": "summary",
    "pipeline_state.json": "state",
    "processing_report.json": "report",
}


class Run:
    """One tracked run in ``config.working_directory``."""

    def __init__(self, spark: SparkSession, config: RunConfig, shape: Shape, dtype: str = "uint16", **options) -> None:
        self.spark, self.config, self.shape, self.dtype, self.options = spark, config, shape, dtype, options
        self.root = config.working_directory.rstrip("/")
        self.plan = ld.plan_steps(rounds_table(spark, config), config.reference_round)
        newest = self._read("step_log", LOG_SCHEMA).agg(F.max("event_id")).first()[0]
        self._event = 0 if newest is None else newest + 1

    # ------------------------------------------------------------ tables

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        frame = self.spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(f"{self.root}/{name}")

    def _log(self, step_id: str, status: str, note: str | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        self._append("step_log", [(step_id, status, now, self._event, note)], LOG_SCHEMA)
        self._event += 1

    def status(self) -> DataFrame:
        return ld.current_status(self.plan, self._read("step_log", LOG_SCHEMA))

    def progress(self) -> DataFrame:
        return ld.progress(self.status())

    def reset(self, phase: str) -> None:
        rows = ld.reset_phase(self.plan, phase, F.current_timestamp(), self._event).select(
            "step_id", "status", "ts", "event_id", "note"
        )
        self._event += rows.count()
        ld.append_log(f"{self.root}/step_log", rows)

    def volume(self, round_name: str, channel: str | None = None) -> DataFrame:
        return volumes.read_volume(self.spark, f"{self.root}/volumes", round_name, channel)

    def aligned(self, round_name: str) -> DataFrame:
        return self.spark.read.schema(BLOCK_SCHEMA).parquet(f"{self.root}/aligned/{round_name}")

    def segmentation(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/segmentation/labels")

    def nuclei(self, min_object_size: int = 1) -> DataFrame:
        return ob.region_props(self.segmentation(), min_object_size)

    def registration(self, round_name: str) -> dict:
        """Stored transforms of one round."""
        base = f"{self.root}/registration/{round_name}"
        row = self.spark.read.text(f"{base}/matrix").first()[0]
        stored = json.loads(row)
        chunked = stored["method"] == "chunk_alignment"
        return {
            "matrix": np.array(stored["matrix"]),
            "method": stored["method"],
            "initial_field": self.spark.read.parquet(f"{base}/initial_field") if chunked else None,
            "field": self.spark.read.parquet(f"{base}/field"),
        }

    # ------------------------------------------------------------ steps

    def _ingest(self, step: dict) -> str:
        name = step["round"]
        blocks = volumes.ingest_round(self.spark, self.config.rounds[name], name, self.shape, self.config.block, self.dtype)
        spread = blocks.repartition("channel", "bz", "by").sortWithinPartitions("channel", "bz", "by", "bx")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("round", "channel").parquet(
            f"{self.root}/volumes"
        )
        return ",".join(self.config.rounds[name])

    def _register(self, step: dict) -> str:
        c, name = self.config, step["round"]
        fixed, moving = (to_voxels(self.volume(r)) for r in (c.reference_round, name))
        result = rg.run_registration(
            fixed, moving, list(c.registration_channels), self.shape, c.block, c.voxel_spacing, c.merge_strategy,
            c.registration_factors, self.options.get("steps"), self.options.get("use_chunk_alignment", False),
            {
                "factors": c.chunk_alignment["downsample_factors"], "method": c.chunk_alignment["interpolation_method"],
                "overlap": c.chunk_alignment["overlap"],
            },
            **self.options.get("deformation", {}),
        )
        base = f"{self.root}/registration/{name}"
        doc = json.dumps({"method": result["method"], "matrix": np.asarray(result["matrix"]).tolist()})
        reports.write_json(self.spark.createDataFrame([(doc,)], "value string"), f"{base}/matrix")
        result["field"].write.mode("overwrite").parquet(f"{base}/field")
        if result["initial_field"] is not None:
            result["initial_field"].write.mode("overwrite").parquet(f"{base}/initial_field")
        result["aligned"].write.mode("overwrite").parquet(f"{base}/aligned")
        aligned = self.spark.read.parquet(f"{base}/aligned")
        first = c.registration_channels[0]
        entries = [volumes.catalog(self.volume(r, first)) for r in (c.reference_round, name)]
        reports.write_json(
            reports.registration_summary(
                *entries, volumes.catalog(aligned), np.asarray(result["matrix"]).tolist(), f"{base}/matrix", f"{base}/field"
            ),
            f"{base}/summary",
        )
        return result["method"]

    def _segment(self, step: dict) -> str:
        c = self.config
        labels = segment_volume(
            self.volume(c.reference_round, c.segmentation_channel), self.shape, c.block, c.segmentation_factors,
            c.downsample_for_segmentation, c.upsample_results, **self.options.get("segmentation", {}),
        )
        labels.write.mode("overwrite").parquet(f"{self.root}/segmentation/labels")
        return f"{ob.object_count(self.nuclei()).first()[0]} objects"

    def _align(self, step: dict) -> str:
        name, c = step["round"], self.config
        out = rg.align_channels(to_voxels(self.volume(name)), self.registration(name), self.shape, c.block, c.voxel_spacing)
        out.write.mode("overwrite").partitionBy("channel").parquet(f"{self.root}/aligned/{name}")
        return ",".join(c.rounds[name])

    def _finalize(self, step: dict) -> str:
        runs = self._read("runs", RUN_SCHEMA)
        document = reports.processing_report(runs, json.dumps(asdict(self.config), default=str))
        target = "state" if step["step_id"] == "save_pipeline_state" else "report"
        reports.write_json(document, f"{self.root}/{target}")
        return target

    def _execute(self, step: dict) -> None:
        actions = {
            "data_preparation": ("round", self._ingest), "registration_workflows": ("registration", self._register),
            "segmentation_workflow": ("segmentation", self._segment), "channel_alignment": ("alignment", self._align),
            "finalization": ("finalization", self._finalize),
        }
        kind, action = actions[step["phase"]]
        self._log(step["step_id"], ld.IN_PROGRESS)
        try:
            detail = action(step)
        except Exception as error:
            self._log(step["step_id"], ld.FAILED, str(error))
            raise
        self._append("runs", [(kind, step["round"] or self.config.reference_round, detail)], RUN_SCHEMA)
        self._log(step["step_id"], ld.COMPLETED)

    def _execute_all(self, steps: DataFrame) -> None:
        for row in steps.orderBy("phase_ord", "ord").collect():  # the run plan: a few rows per round
            self._execute(row.asDict())

    def run_step(self, step: str, round_name: str | None = None) -> DataFrame:
        """Run one step (missing prerequisites first, completed steps skipped); returns the status."""
        wanted = ld.steps_to_run(self.status(), step, round_name, self.config.reference_round)
        self._execute_all(self.plan.join(wanted.select("step_id"), "step_id", "left_semi"))
        return self.status()

    def run_all(self) -> DataFrame:
        """Run or resume everything that is not completed; returns the final progress row."""
        done = self.status().filter(F.col("status") == ld.COMPLETED).select("step_id")
        self._execute_all(self.plan.join(done, "step_id", "left_anti"))
        return ld.final_results(self.status())

    def stored_outputs(self) -> DataFrame:
        """``path, bytes`` of the planned outputs that storage holds now, from a listing of the run's folder."""
        planned = self.plan.select("round", F.explode("expected_outputs").alias("path"))
        volume = [F.regexp_extract("path", r"^(?:zarr_volumes|aligned)/([^/]+)/\1_(.*?)(?:_aligned)?\.zarr$", i) for i in (1, 2)]
        folder = (
            F.when(F.col("path").startswith("zarr_volumes/"), F.concat(F.lit("volumes/round="), volume[0], F.lit("/channel="), volume[1]))
            .when(F.col("path").startswith("aligned/"), F.concat(F.lit("aligned/"), volume[0], F.lit("/channel="), volume[1]))
            .when(F.col("path").startswith("segmentation/"), F.lit("segmentation/labels"))
        )
        for tail, part in FOLDERS.items():
            inside = F.col("path").startswith("registration/")
            here = F.concat(F.lit("registration/"), "round", F.lit(f"/{part}")) if tail.startswith("_") else F.lit(part)
            folder = folder.when(F.col("path").endswith(tail) & (inside == F.lit(tail.startswith("_"))), here)
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "path string, bytes bigint")
        name = re.escape(self.root.rstrip("/").rsplit("/", 1)[-1])
        inner = F.regexp_extract("path", rf"^.*?/{name}/(.*)/[^/]*$", 1).alias("folder")
        sizes = files.select(inner, "length").groupBy("folder").agg(F.sum("length").alias("bytes"))
        return planned.withColumn("folder", folder).join(sizes, "folder").select("path", "bytes")

    def missing_outputs(self) -> DataFrame:
        """Outputs of completed steps that are not in storage (any more)."""
        done = self.status().filter(F.col("status") == ld.COMPLETED)
        return ld.missing_outputs(done, self.stored_outputs())


def run_workflow(spark: SparkSession, config: RunConfig, shape: Shape, dtype: str = "uint16", **options) -> DataFrame:
    return Run(spark, config, shape, dtype, **options).run_all()
