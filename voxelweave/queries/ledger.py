"""Run-ledger queries (batch and streaming) with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxelweave.functions.sizing import new_path
from voxelweave.plans import ledger as ld
from voxelweave.queries.registry import Registry
from voxelweave.sources import fixtures as fx
from voxelweave.streaming import status as st

query = Registry()

REFERENCE = "AFRICA"
LOGGED_STEPS = 12

# The same plan and log in SQL.
ROUNDS = "rounds AS (SELECT r_name AS round, n_name AS channel, r_regionkey AS round_ord, n_nationkey AS channel_ord FROM nation JOIN region ON n_regionkey=r_regionkey)"
_PAIR = "'AFRICA_to_'||round"
PLAN = (
    "plan AS (SELECT *, row_number() OVER (ORDER BY phase_ord, ord)-1 AS n FROM ("
    "SELECT 'tiff_to_zarr_'||round AS step_id, 'data_preparation' AS phase, 0 AS phase_ord, round_ord AS ord, round, CAST([] AS VARCHAR[]) AS deps, "
    "list('zarr_volumes/'||round||'/'||round||'_'||channel||'.zarr' ORDER BY channel_ord) AS outs FROM rounds GROUP BY round, round_ord "
    f"UNION ALL SELECT DISTINCT 'registration_'||{_PAIR}, 'registration_workflows', 1, round_ord, round, ['tiff_to_zarr_AFRICA','tiff_to_zarr_'||round], "
    f"list_transform(['affine_matrix.txt','deformation_field.zarr','final_aligned.zarr','summary.json'], lambda t: 'registration/'||{_PAIR}||'/'||{_PAIR}||'_'||t) "
    "FROM rounds WHERE round<>'AFRICA' "
    "UNION ALL SELECT 'segment_reference_round', 'segmentation_workflow', 2, 0, NULL, ['tiff_to_zarr_AFRICA'], "
    "['segmentation/AFRICA_nuclei_segmentation.zarr','segmentation/AFRICA_nuclei_segmentation_fullres.zarr'] "
    f"UNION ALL SELECT 'align_channels_'||round, 'channel_alignment', 3, round_ord, round, ['registration_'||any_value({_PAIR})], "
    "list('aligned/'||round||'/'||round||'_'||channel||'_aligned.zarr' ORDER BY channel_ord) FROM rounds WHERE round<>'AFRICA' GROUP BY round, round_ord "
    "UNION ALL SELECT 'save_pipeline_state', 'finalization', 4, 0, NULL, CAST([] AS VARCHAR[]), ['pipeline_state.json'] "
    "UNION ALL SELECT 'generate_processing_report', 'finalization', 4, 1, NULL, ['save_pipeline_state'], ['processing_report.json']))"
)
LOG = (
    "log AS (SELECT step_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'in_progress' ELSE 'completed' END AS status "
    f"FROM events JOIN plan ON user_id % {LOGGED_STEPS} = n)"
)
STATUS = (
    "st AS (SELECT p.*, coalesce(h.status,'pending') AS status, h.ff, h.ls, h.lc FROM plan p LEFT JOIN (SELECT step_id, arg_max(status, (ts,event_id)) AS status, "
    "min((ts,event_id)) FILTER (WHERE status='failed') AS ff, max((ts,event_id)) FILTER (WHERE status='in_progress') AS ls, max((ts,event_id)) FILTER (WHERE status='completed') AS lc "
    "FROM log GROUP BY step_id) h USING (step_id))"
)
UNMET = "unmet AS (SELECT step_id, dep FROM (SELECT step_id, unnest(deps) AS dep FROM st) WHERE dep NOT IN (SELECT step_id FROM st WHERE status='completed'))"
READY = (
    "ready AS (SELECT * FROM st WHERE status='pending' AND step_id NOT IN (SELECT step_id FROM unmet) AND phase NOT IN (SELECT phase FROM (VALUES "
    "('registration_workflows','data_preparation'),('segmentation_workflow','data_preparation'),('channel_alignment','registration_workflows'),"
    "('finalization','segmentation_workflow'),('finalization','channel_alignment')) d(phase, needs) WHERE needs IN (SELECT phase FROM st WHERE status<>'completed')))"
)


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([ROUNDS, PLAN, *ctes]) + "\n" + body


def plan(spark, sf):
    nation, region = fx.table(spark, sf, "nation"), fx.table(spark, sf, "region")
    rounds = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("r_name").alias("round"), F.col("n_name").alias("channel"), F.col("r_regionkey").alias("round_ord"),
        F.col("n_nationkey").alias("channel_ord"),
    )
    return ld.plan_steps(rounds, REFERENCE)


def log(spark, sf, steps):
    numbered = steps.select("step_id", (F.row_number().over(Window.orderBy("phase_ord", "ord")) - 1).alias("n"))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "in_progress").otherwise("completed")
    events = fx.table(spark, sf, "events").select((F.col("user_id") % LOGGED_STEPS).alias("n"), "ts", "event_id", status.alias("status"))
    return events.join(numbered, "n").select("step_id", "ts", "event_id", "status")


def status(spark, sf):
    steps = plan(spark, sf)
    return ld.current_status(steps, log(spark, sf, steps))


def _join(column: str):
    return F.array_join(column, "|").alias(column)


@query(
    "run_plan",
    sql("SELECT step_id, phase, phase_ord::BIGINT AS phase_ord, ord::BIGINT AS ord, array_to_string(deps,'|') AS deps, array_to_string(outs,'|') AS expected_outputs FROM plan"),
)
def run_plan(spark, sf):
    return plan(spark, sf).select("step_id", "phase", "phase_ord", "ord", _join("deps"), _join("expected_outputs"))


@query("run_count_steps", sql("SELECT count(*) AS total_steps FROM plan"))
def run_count_steps(spark, sf):
    return ld.count_steps(plan(spark, sf))


@query("run_current_status", sql("SELECT step_id, phase, status FROM st", LOG, STATUS))
def run_current_status(spark, sf):
    return status(spark, sf).select("step_id", "phase", "status")


@query(
    "run_ledger_status",
    fx.with_views("fx_ledger", "SELECT step_id, arg_max(status,(ts,event_id)) AS status FROM fx_ledger GROUP BY step_id"),
)
def run_ledger_status(spark, sf):
    return ld.step_history(fx.ledger(spark, sf)).select("step_id", "status")


@query(
    "run_progress",
    sql(
        "SELECT count(*) AS total_steps, count(*) FILTER (WHERE status='completed') AS completed_steps, round(count(*) FILTER (WHERE status='completed')/count(*)*100,6) AS percentage_complete, "
        "arg_max(phase,ls) AS current_phase, arg_max(step_id,ls) AS current_step, arg_max(step_id,lc) AS last_completed_step, "
        "array_to_string(list(step_id ORDER BY ff) FILTER (WHERE ff IS NOT NULL),'|') AS failed_steps, coalesce(array_to_string(list(step_id ORDER BY phase_ord, ord) FILTER (WHERE status='failed'),'|'),'') AS currently_failed, "
        "array_to_string(list(step_id ORDER BY phase_ord, ord) FILTER (WHERE status='pending'),'|') AS remaining_steps FROM st",
        LOG, STATUS,
    ),
)
def run_progress(spark, sf):
    out = ld.progress(status(spark, sf))
    return out.select(
        "total_steps", "completed_steps", F.round("percentage_complete", 6).alias("percentage_complete"), "current_phase",
        "current_step", "last_completed_step", _join("failed_steps"), _join("currently_failed"), _join("remaining_steps"),
    )


@query("run_ready_steps", sql("SELECT step_id, phase FROM ready", LOG, STATUS, UNMET, READY))
def run_ready_steps(spark, sf):
    return ld.ready_steps(status(spark, sf)).select("step_id", "phase")


# A second status: every logged step completed, so later phases open up.
_ALL_DONE = STATUS.replace("coalesce(h.status,'pending') AS status", "CASE WHEN p.phase_ord = 0 THEN 'completed' ELSE 'pending' END AS status")


def _ingested(spark, sf):
    done = F.when(F.col("phase_ord") == 0, "completed").otherwise("pending")
    return status(spark, sf).withColumn("status", done)


@query("run_ready_after_ingest", sql("SELECT step_id, phase FROM ready", LOG, _ALL_DONE, UNMET, READY))
def run_ready_after_ingest(spark, sf):
    return ld.ready_steps(_ingested(spark, sf)).select("step_id", "phase")


@query(
    "run_unmet_prerequisites",
    sql("SELECT step_id, array_to_string(list_sort(list(dep)),'|') AS missing FROM unmet GROUP BY step_id", LOG, STATUS, UNMET),
)
def run_unmet_prerequisites(spark, sf):
    return ld.unmet_prerequisites(status(spark, sf)).select("step_id", _join("missing"))


@query(
    "run_phase_rollup",
    sql(
        "SELECT phase, CASE WHEN bool_and(status='completed') THEN 'completed' ELSE 'pending' END AS status, CASE WHEN bool_or(status='failed') THEN 'failed' "
        "WHEN bool_and(status='completed') THEN 'completed' ELSE 'pending' END AS strict_status, count(*) AS steps FROM st GROUP BY phase",
        LOG, STATUS,
    ),
)
def run_phase_rollup(spark, sf):
    return ld.phase_rollup(status(spark, sf)).select("phase", "status", "strict_status", "steps")


_EXISTING = "existing AS (SELECT path, (length(path) % 3)::BIGINT AS bytes FROM (SELECT unnest(outs) AS path FROM plan) WHERE length(path) % 5 <> 0)"


@query(
    "run_validate_outputs",
    sql(
        "SELECT step_id, count(*) FILTER (WHERE path NOT IN (SELECT path FROM existing WHERE bytes>0)) = 0 AS valid, "
        "count(*) FILTER (WHERE path NOT IN (SELECT path FROM existing WHERE bytes>0)) AS missing FROM (SELECT step_id, unnest(outs) AS path FROM plan) GROUP BY step_id",
        _EXISTING,
    ),
)
def run_validate_outputs(spark, sf):
    steps = plan(spark, sf)
    paths = steps.select(F.explode("expected_outputs").alias("path"))
    existing = paths.filter(F.length("path") % 5 != 0).withColumn("bytes", (F.length("path") % 3).cast("bigint"))
    return ld.validate_outputs(steps, existing)


@query(
    "run_reset_phase",
    sql(
        "SELECT step_id, CASE WHEN phase='data_preparation' THEN 'pending' ELSE status END AS status FROM st",
        LOG, STATUS,
    ),
)
def run_reset_phase(spark, sf):
    """Status after appending the reset rows to the log."""
    steps = plan(spark, sf)
    rows = log(spark, sf, steps)
    last = rows.agg(F.max("ts"), F.max("event_id")).first()
    reset = ld.reset_phase(steps, "data_preparation", F.lit(last[0]).cast(rows.schema["ts"].dataType), last[1] + 1)
    return ld.current_status(steps, rows.unionByName(reset.drop("note"))).select("step_id", "status")


@query("run_resume_plan", sql("SELECT phase, count(*) AS ready FROM ready GROUP BY phase", LOG, _ALL_DONE, UNMET, READY))
def run_resume_plan(spark, sf):
    return ld.resume_plan(_ingested(spark, sf)).select("phase", "ready")


@query(
    "run_final_results",
    sql("SELECT CASE WHEN bool_and(status='completed') THEN 'completed' ELSE 'incomplete' END AS status, count(*) FILTER (WHERE status='completed') AS completed_steps FROM st", LOG, STATUS),
)
def run_final_results(spark, sf):
    return ld.final_results(status(spark, sf)).select("status", "completed_steps")


@query(
    "run_completed_outputs",
    sql(
        "SELECT step_id, path, CASE WHEN contains(step_id,'tiff_to_zarr') THEN 'channel' WHEN contains(path,'deformation_field') THEN 'deformation_field' "
        "WHEN contains(path,'affine') AND regexp_matches(path,'\\.(npy|json|txt|yaml|yml)$') THEN 'affine_transforms' WHEN contains(path,'mask') OR contains(path,'labels') THEN 'masks' "
        "WHEN contains(path,'segmentation') THEN 'segmentation' ELSE 'other' END AS kind, CASE WHEN contains(step_id,'tiff_to_zarr') THEN regexp_extract(path,'_([^_/]+)\\.zarr$',1) END AS channel "
        "FROM (SELECT step_id, unnest(outs) AS path FROM st WHERE status='completed')",
        LOG, STATUS,
    ),
)
def run_completed_outputs(spark, sf):
    return ld.completed_outputs(status(spark, sf))


@query(
    "run_step_list",
    sql(
        "SELECT step_id, phase, status FROM st WHERE status<>'completed' AND (phase='channel_alignment' OR phase='registration_workflows' OR phase='data_preparation')",
        LOG, STATUS,
    ),
)
def run_step_list(spark, sf):
    """Everything needed to run channel alignment for all rounds."""
    return ld.steps_to_run(status(spark, sf), "alignment", "all", REFERENCE).select("step_id", "phase", "status")


def _stream(spark, sf):
    path = f"{sf}/events*.parquet"
    schema = spark.read.parquet(path).schema
    return fx.log_rows(st.read_log_stream(spark, path, schema))


@query(
    "run_stream_status",
    fx.with_views(
        "fx_ledger",
        "SELECT step_id, arg_max(status,(ts,event_id)) AS status, arg_max(event_id,(ts,event_id)) AS event_id, count(*) AS updates FROM fx_ledger GROUP BY step_id",
    ),
)
def run_stream_status(spark, sf):
    return st.run_to_end(_stream(spark, sf), st.stream_status, new_path(spark, "status"), new_path(spark, "status-ck"), ["step_id"])


@query(
    "run_stream_counts",
    fx.with_views(
        "fx_ledger",
        "SELECT strftime(date_trunc('hour', ts),'%Y-%m-%d %H:%M:%S') AS window_start, status, count(*) AS n FROM fx_ledger GROUP BY 1, 2",
    ),
)
def run_stream_counts(spark, sf):
    out = st.run_to_end(
        _stream(spark, sf), st.stream_counts, new_path(spark, "counts"), new_path(spark, "counts-ck"), ["window_start", "status"]
    )
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
