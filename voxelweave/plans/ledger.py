"""Run plan and append-only status log as tables.

Plan: ``step_id, phase, phase_ord, ord, description, deps, expected_outputs``.
Log: ``step_id, status, ts, event_id`` -- never rewritten; the latest ``(ts, event_id)`` wins.
The log may be large; it is reduced to one row per step by partial aggregation before any join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.sizing import settled

# Phase order, phase dependencies, statuses and step names of the run plan.
PHASES = (
    "data_preparation",
    "registration_workflows",
    "segmentation_workflow",
    "channel_alignment",
    "finalization",
)
PHASE_DEPENDENCIES = {
    "data_preparation": (),
    "registration_workflows": ("data_preparation",),
    "segmentation_workflow": ("data_preparation",),
    "channel_alignment": ("registration_workflows",),
    "finalization": ("segmentation_workflow", "channel_alignment"),
}
PENDING, IN_PROGRESS, COMPLETED, FAILED = "pending", "in_progress", "completed", "failed"
STEP_PHASES = {
    "process_rounds": "data_preparation",
    "registration": "registration_workflows",
    "segmentation": "segmentation_workflow",
    "alignment": "channel_alignment",
    "finalization": "finalization",
}
PER_ROUND_STEPS = ("registration", "alignment")

_COLUMNS = ["step_id", "phase", "phase_ord", "ord", "round", "description", "deps", "expected_outputs"]


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _strings(*parts: Column) -> Column:
    return F.array(*parts) if parts else F.array().cast("array<string>")


def _phase(rows: DataFrame, phase: str) -> DataFrame:
    return rows.withColumns(
        {"phase": F.lit(phase), "phase_ord": F.lit(PHASES.index(phase)).cast("bigint"), "ord": F.col("ord").cast("bigint")}
    ).select(*_COLUMNS)


def plan_steps(rounds: DataFrame, reference: str) -> DataFrame:
    """Steps of all phases from ``round, channel, round_ord, channel_ord``.

    The reference round is ingested and segmented; every other round is also registered to it
    and has its channels aligned.
    """
    r, ref = F.col("round"), reference

    def per_channel(prefix: Column, suffix: str) -> Column:
        item = F.struct("channel_ord", _text(prefix, F.col("channel"), suffix).alias("path"))
        return F.transform(F.sort_array(F.collect_list(item)), lambda s: s["path"])

    by_round = rounds.groupBy("round", F.col("round_ord").alias("ord"))
    ingest = by_round.agg(
        per_channel(_text("zarr_volumes/", r, "/", r, "_"), ".zarr").alias("expected_outputs")
    ).withColumns(
        {"step_id": _text("tiff_to_zarr_", r), "description": _text("Ingest ", r), "deps": _strings()}
    )
    moving = by_round.agg(
        per_channel(_text("aligned/", r, "/", r, "_"), "_aligned.zarr").alias("aligned")
    ).filter(r != ref)
    pair = _text(ref, "_to_", r)
    base = _text("registration/", pair, "/", pair, "_")
    register = moving.withColumns(
        {
            "step_id": _text("registration_", pair),
            "description": _text("Register ", r, " to ", ref),
            "deps": _strings(F.lit(f"tiff_to_zarr_{ref}"), _text("tiff_to_zarr_", r)),
            "expected_outputs": _strings(
                *[_text(base, tail) for tail in ("affine_matrix.txt", "deformation_field.zarr", "final_aligned.zarr", "summary.json")]
            ),
        }
    )
    align = moving.withColumns(
        {
            "step_id": _text("align_channels_", r),
            "description": _text("Align all channels of ", r),
            "deps": _strings(_text("registration_", pair)),
            "expected_outputs": F.col("aligned"),
        }
    )
    seg = f"segmentation/{ref}_nuclei_segmentation"
    fixed = rounds.sparkSession.createDataFrame(
        [
            ("segment_reference_round", 0, "Segment nuclei of the reference round", [f"tiff_to_zarr_{ref}"], [f"{seg}.zarr", f"{seg}_fullres.zarr"]),
            ("save_pipeline_state", 0, "Save run state", [], ["pipeline_state.json"]),
            ("generate_processing_report", 1, "Write the processing report", ["save_pipeline_state"], ["processing_report.json"]),
        ],
        "step_id string, ord bigint, description string, deps array<string>, expected_outputs array<string>",
    ).withColumn("round", F.lit(None).cast("string"))
    segment = fixed.filter("step_id = 'segment_reference_round'")
    final = fixed.filter("step_id <> 'segment_reference_round'")
    phases = [ingest, register, segment, align, final]
    return reduce(DataFrame.unionByName, (_phase(rows, name) for rows, name in zip(phases, PHASES)))


def count_steps(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count(F.lit(1)).alias("total_steps"))


def _order() -> Column:
    return F.struct("ts", "event_id")


def step_history(log: DataFrame) -> DataFrame:
    """One row per step: latest status and the times of its milestones."""

    def last(status: str) -> Column:
        return F.max(F.when(F.col("status") == status, _order()))

    return log.groupBy("step_id").agg(
        F.max_by("status", _order()).alias("status"),
        F.min(F.when(F.col("status") == FAILED, _order())).alias("first_failed"),
        last(IN_PROGRESS).alias("last_started"),
        last(COMPLETED).alias("last_completed"),
    )


def current_status(plan: DataFrame, log: DataFrame) -> DataFrame:
    """Plan with the latest status of each step (pending without a log entry).

    The log is read once; the result has one row per planned step.
    """
    return plan.join(step_history(log), "step_id", "left").withColumn("status", F.coalesce("status", F.lit(PENDING)))


def _done(status: DataFrame) -> DataFrame:
    return status.filter(F.col("status") == COMPLETED)


def progress(status: DataFrame) -> DataFrame:
    """One row: totals, percentage, current and last completed step, failures, remaining steps.

    ``failed_steps`` lists every step that ever failed, in order of first failure;
    ``currently_failed`` only those whose latest status is failed.
    """
    ordered = F.struct("phase_ord", "ord", "step_id")
    completed = F.count(F.when(F.col("status") == COMPLETED, 1))
    total = F.count(F.lit(1))

    def names(cond: Column, order: Column) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.when(cond, order))), lambda s: s["step_id"])

    return status.agg(
        total.alias("total_steps"),
        completed.alias("completed_steps"),
        F.when(total > 0, completed / total * 100).otherwise(F.lit(0.0)).alias("percentage_complete"),
        F.max_by("phase", "last_started").alias("current_phase"),
        F.max_by("step_id", "last_started").alias("current_step"),
        F.max_by("step_id", "last_completed").alias("last_completed_step"),
        F.max(F.col("last_completed")["ts"]).alias("last_step_completed_at"),
        names(F.col("first_failed").isNotNull(), F.struct("first_failed", "step_id")).alias("failed_steps"),
        names(F.col("status") == FAILED, ordered).alias("currently_failed"),
        names(F.col("status") == PENDING, ordered).alias("remaining_steps"),
    )


def _unmet(status: DataFrame) -> DataFrame:
    """``step_id, dep`` for dependencies that are not completed."""
    wanted = status.select("step_id", F.explode("deps").alias("dep"))
    return wanted.join(_done(status).select(F.col("step_id").alias("dep")), "dep", "left_anti").select("step_id", "dep")


def open_phases(status: DataFrame) -> DataFrame:
    """Phases with at least one step not completed."""
    return status.filter(F.col("status") != COMPLETED).select("phase").distinct()


def ready_steps(status: DataFrame) -> DataFrame:
    """Pending steps whose phase dependencies and step dependencies are completed.

    A phase without steps counts as complete.
    """
    links = [(p, d) for p, deps in PHASE_DEPENDENCIES.items() for d in deps]
    needs = status.sparkSession.createDataFrame(links, "phase string, needs string")
    blocked = needs.join(open_phases(status).withColumnRenamed("phase", "needs"), "needs", "left_semi")
    return (
        status.filter(F.col("status") == PENDING)
        .join(blocked, "phase", "left_anti")
        .join(_unmet(status), "step_id", "left_anti")
        .select("step_id", "phase", "phase_ord", "ord", "description")
    )


def unmet_prerequisites(status: DataFrame) -> DataFrame:
    """Per step: the dependencies not completed, in plan order of the list."""
    return _unmet(status).groupBy("step_id").agg(F.sort_array(F.collect_set("dep")).alias("missing"))


def validate_step_prerequisites(status: DataFrame, step_id: str) -> tuple[bool, list[str]]:
    if not status.filter(F.col("step_id") == step_id).take(1):
        return False, [f"Step '{step_id}' not found"]
    row = unmet_prerequisites(status).filter(F.col("step_id") == step_id).first()
    missing = [] if row is None else list(row["missing"])
    return not missing, missing


def phase_rollup(status: DataFrame) -> DataFrame:
    """Phase status: completed when every step is; ``strict_status`` is failed when any step failed."""
    done = F.every(F.col("status") == COMPLETED)
    failed = F.bool_or(F.col("status") == FAILED)
    plain = F.when(done, COMPLETED).otherwise(PENDING)
    return status.groupBy("phase", "phase_ord").agg(
        plain.alias("status"),
        F.when(failed, FAILED).otherwise(plain).alias("strict_status"),
        F.count(F.lit(1)).alias("steps"),
    )


def missing_outputs(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """Expected outputs that are absent or empty in ``existing`` (``path, bytes``)."""
    expected = plan.select("step_id", F.explode("expected_outputs").alias("path"))
    return expected.join(existing.filter("bytes > 0").select("path"), "path", "left_anti").select("step_id", "path")


def validate_outputs(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """Per step: whether all outputs are present and how many are missing."""
    lost = missing_outputs(plan, existing).groupBy("step_id").agg(F.count(F.lit(1)).alias("missing"))
    return plan.join(lost, "step_id", "left").select(
        "step_id", F.col("missing").isNull().alias("valid"), F.coalesce("missing", F.lit(0).cast("bigint")).alias("missing")
    )


def reset_phase(plan: DataFrame, phase: str, ts: Column, first_event_id: int) -> DataFrame:
    """Log rows to append: the phase itself (with a note) and each of its steps back to pending."""
    if phase not in PHASES:
        raise ValueError(f"unknown phase {phase!r}")
    steps = plan.filter(F.col("phase") == phase).select("step_id", F.lit(None).cast("string").alias("note"), F.col("ord") + 1)
    head = plan.sparkSession.createDataFrame([(phase, "phase set back: its steps run again", 0)], "step_id string, note string, ord bigint")
    rows = head.union(steps)
    return rows.select(
        "step_id", F.lit(PENDING).alias("status"), ts.alias("ts"), (F.lit(first_event_id) + F.col("ord")).alias("event_id"), "note"
    )


def resume_plan(status: DataFrame) -> DataFrame:
    """Phases that contain ready steps, in order; empty means already completed."""
    return ready_steps(status).groupBy("phase", "phase_ord").agg(F.count(F.lit(1)).alias("ready"))


def final_results(status: DataFrame) -> DataFrame:
    """Progress with an overall verdict: completed or incomplete."""
    state = F.when(F.col("percentage_complete") < 100.0, "incomplete").otherwise(COMPLETED)
    return progress(status).withColumn("status", state)


def has_previous_progress(status: DataFrame) -> bool:
    return bool(_done(status).take(1))


#: What the outputs of a step are, by phase and by their place in the plan; further places are as the last one named.
OUTPUT_KINDS = {
    PHASES[0]: ("channel",),
    PHASES[1]: ("affine_transforms", "deformation_field", "other"),
    PHASES[2]: ("segmentation",),
}


def completed_outputs(status: DataFrame) -> DataFrame:
    """Outputs of completed steps, ``step_id, path, kind, channel``, as the plan placed them.

    The channel of an ingested volume is the last part of its file name.
    """
    out = _done(status).select("step_id", "phase", F.posexplode("expected_outputs").alias("place", "path"))
    places = {phase: F.array(*map(F.lit, kinds)) for phase, kinds in OUTPUT_KINDS.items()}
    kind = F.lit("other")
    for phase, kinds in places.items():
        named = F.element_at(kinds, F.least(F.col("place") + 1, F.size(kinds)))
        kind = F.when(F.col("phase") == phase, named).otherwise(kind)
    own = F.regexp_replace(F.substring_index("path", "_", -1), r"\.zarr$", "")
    channel = F.when(F.col("phase") == PHASES[0], own)
    return out.select("step_id", "path", kind.alias("kind"), channel.alias("channel"))


def outputs_by_step(status: DataFrame) -> DataFrame:
    """The mapping of :func:`completed_outputs` as one map per step: channel or kind to paths."""
    rows = completed_outputs(status).withColumn("key", F.coalesce("channel", "kind"))
    lists = rows.groupBy("step_id", "key").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return lists.groupBy("step_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "paths"))).alias("outputs"))


def steps_to_run(status: DataFrame, step: str, round_name: str | None, reference: str) -> DataFrame:
    """Ordered steps needed to run ``step`` for one round or ``all`` non-reference rounds.

    Missing prerequisites come first; completed steps are left out; the reference round has
    nothing to do for per-round steps.
    """
    if step not in STEP_PHASES:
        raise ValueError(f"unknown step {step!r}; expected one of {sorted(STEP_PHASES)}")
    chosen = status.filter(F.col("phase") == STEP_PHASES[step])
    if step in PER_ROUND_STEPS:
        if round_name is None:
            raise ValueError(f"step {step!r} needs a round")
        if round_name != "all":
            known = status.filter(F.col("phase") == PHASES[0]).filter(F.col("round") == round_name)
            if not known.take(1):
                raise ValueError(f"unknown round {round_name!r}")
            chosen = chosen.filter((F.col("round") == round_name) & (F.col("round") != reference))
    needed = settled(chosen.select("step_id"))
    links = settled(status.select("step_id", F.explode("deps").alias("dep")))
    # One level of prerequisites per pass; the chain is never longer than the number of phases.
    for _ in PHASES:
        deeper = links.join(needed, "step_id", "left_semi").select(F.col("dep").alias("step_id"))
        grown = settled(needed.union(deeper).distinct())
        if grown.count() == needed.count():
            break
        needed = grown
    return (
        status.join(needed, "step_id", "left_semi")
        .filter(F.col("status") != COMPLETED)
        .select("step_id", "phase", "phase_ord", "ord", "status")
        .orderBy("phase_ord", "ord")
    )


def append_log(log_path: str, rows: DataFrame) -> None:
    """Append status rows to the log table."""
    rows.write.mode("append").parquet(log_path)
