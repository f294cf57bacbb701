"""Storage, manifest, ledger and streaming behaviour on small hand-written tables."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import array_of, shape_of, texture, voxels_of
from voxelweave.functions.sizing import settled, workspace
from voxelweave.model import Shape
from voxelweave.operators import blocks as bl
from voxelweave.operators import objects as ob
from voxelweave.plans import ledger as ld
from voxelweave.sources import mip_store, synth, tile_manifest, volumes
from voxelweave.streaming import status as st


def test_read_volume_errors(spark, tmp_path):
    vox = voxels_of(spark, texture((2, 3, 4)), channel="0405")
    with pytest.raises(FileNotFoundError):
        volumes.read_volume(spark, str(tmp_path / "none"))
    plain, keyed = str(tmp_path / "plain"), str(tmp_path / "keyed")
    volumes.write_volume(vox, plain)
    volumes.write_volume(vox, keyed, key="raw")
    with pytest.warns(UserWarning):
        assert volumes.read_volume(spark, plain, key="raw").count() == 24
    with pytest.raises(KeyError):
        volumes.read_volume(spark, keyed)
    with pytest.raises(KeyError):
        volumes.read_volume(spark, keyed, key="labels")
    assert volumes.read_volume(spark, keyed, "O", "0405", key="raw").count() == 24


def test_ingest_raw_slices(spark, tmp_path):
    array = texture((4, 6, 5))
    for z in range(4):
        (tmp_path / f"img_{z}.raw").write_bytes(array[z].astype("<u2").tobytes())
    blocks = volumes.ingest_round(spark, {"A": str(tmp_path)}, "r1", shape_of(array), Shape(3, 4, 4))
    assert np.array_equal(array_of(bl.to_voxels(blocks), array.shape), array)
    row = volumes.catalog(blocks).first()
    assert (row["size_z"], row["size_y"], row["size_x"], row["dtype"]) == (4, 6, 5, "uint16")
    with pytest.raises(ValueError):
        volumes.ingest_all_rounds(spark, {}, shape_of(array))


def test_ingest_slabs_of_unequal_height(spark, tmp_path):
    """Numbers may start anywhere and skip; each slab starts where the one before it ends."""
    array, cuts = texture((6, 4, 5)), {1: (0, 2), 2: (2, 3), 10: (3, 6)}
    for number, (lo, hi) in cuts.items():
        (tmp_path / f"slab{number}.raw").write_bytes(array[lo:hi].astype("<u2").tobytes())
    read = lambda: volumes.ingest_round(spark, {"A": str(tmp_path)}, "r1", shape_of(array), Shape(4, 4, 4))
    assert np.array_equal(array_of(bl.to_voxels(read()), array.shape), array)
    for name, size in (("other10.raw", 40), ("nonumber.raw", 40), ("slab11.raw", 41)):
        extra = tmp_path / name
        extra.write_bytes(bytes(size))
        with pytest.raises(Exception, match="slice"):
            read().collect()
        extra.rename(tmp_path.parent / name)


def test_exported_strips_fill_missing_blocks(spark):
    array = np.zeros((2, 6, 4), dtype=int)
    array[1, 5, 3] = 9
    blocks = bl.to_blocks(voxels_of(spark, array), shape_of(array), Shape(1, 2, 4))
    strips = volumes.export_slices(blocks, shape_of(array), strip_rows=4).collect()
    assert [(r["z"], r["y0"], r["h"]) for r in strips] == [(0, 0, 4), (0, 4, 2), (1, 0, 4), (1, 4, 2)]
    image = np.frombuffer(b"".join(r["data"] for r in strips), "<u2").reshape(array.shape)
    assert np.array_equal(image, array)


def test_common_extent_of_nothing(spark):
    empty = volumes.voxel_catalog(voxels_of(spark, np.zeros((1, 1, 1), dtype=int)))
    with pytest.raises(ValueError):
        volumes.common_extent(empty)


def test_tile_channel_selection(spark):
    rows = spark.createDataFrame([(0, "A")], "tile int, channel string")
    assert tile_manifest.select_tile_channel(rows, "A").count() == 1
    with pytest.raises(ValueError):
        tile_manifest.select_tile_channel(rows, "B")


def test_store_is_incremental(spark, tmp_path):
    label_rows = [(1, 0, 1, 1), (1, 0, 1, 2), (2, 0, 4, 4)]
    labels = spark.createDataFrame(label_rows, "label bigint, z bigint, y bigint, x bigint")
    vox = spark.createDataFrame([("O", "405", 0, 1, 1, 50), ("O", "405", 0, 4, 4, 60)], "round string, channel string, z bigint, y bigint, x bigint, value bigint")
    nuclei = ob.padded_bbox(ob.region_props(labels), 1, Shape(1, 8, 8))
    path = str(tmp_path / "mips")
    first = mip_store.materialize_mips(path, labels, vox, nuclei.filter("label = 1"), ["405"]).collect()
    assert {r["label"] for r in first} == {1} and {r["channel"] for r in first} == {"405"}
    brighter = vox.withColumn("value", F.col("value") + 100)
    second = {(r["label"], r["value"]) for r in mip_store.materialize_mips(path, labels, brighter, nuclei, ["405"]).collect()}
    assert (1, 50) in second and (2, 160) in second
    forced = {(r["label"], r["value"]) for r in mip_store.materialize_mips(path, labels, brighter, nuclei, ["405"], force=True).collect()}
    assert (1, 150) in forced and (1, 50) not in forced
    mip_store.clear_store(spark, path)
    assert mip_store.read_store(spark, path).count() == 0


def test_stats_of_no_objects(spark):
    empty = ob.region_props(spark.createDataFrame([], "label bigint, z bigint, y bigint, x bigint"))
    row = ob.nuclei_stats(empty).first()
    assert row["total_nuclei"] == 0 and row["area_median"] == 0


def test_upper_median(spark):
    for values, want in (([1, 2, 3, 4], 3), ([5, 1, 9], 5), ([7], 7)):
        assert ob.upper_median(spark.createDataFrame([(v,) for v in values], "v bigint"), "v").first()[0] == want


def test_synthetic_channels_are_repeatable(spark):
    seeds = spark.createDataFrame([(1, 3, 10, 10, 4), (2, 3, 14, 12, 5)], "label bigint, cz bigint, cy bigint, cx bigint, radius bigint")
    shape = Shape(7, 24, 24)
    one, two = (sorted(map(tuple, synth.synth_stain(synth.synth_labels(seeds.repartition(n), shape)).collect())) for n in (1, 5))
    assert one == two
    assert all(0.7 * 8000 <= v <= 1.3 * 16000 + 200 for *_, v in one)


ROUNDS = [("r1", "a", 0, 0), ("r1", "b", 0, 1), ("r2", "a", 1, 0)]


@pytest.fixture(scope="module")
def plan(spark):
    rounds = spark.createDataFrame(ROUNDS, "round string, channel string, round_ord bigint, channel_ord bigint")
    return ld.plan_steps(rounds, "r1")


def log_of(spark, *entries):
    rows = [(s, status, dt.datetime(2024, 1, 1, 0, 0, t), i) for i, (s, status, t) in enumerate(entries)]
    return spark.createDataFrame(rows, "step_id string, status string, ts timestamp, event_id bigint")


def test_ready_steps_follow_phases(spark, plan):
    nothing = ld.current_status(plan, log_of(spark).limit(0))
    assert {r["step_id"] for r in ld.ready_steps(nothing).collect()} == {"tiff_to_zarr_r1", "tiff_to_zarr_r2"}
    half = ld.current_status(plan, log_of(spark, ("tiff_to_zarr_r1", "completed", 1)))
    assert {r["step_id"] for r in ld.ready_steps(half).collect()} == {"tiff_to_zarr_r2"}
    full = ld.current_status(plan, log_of(spark, ("tiff_to_zarr_r1", "completed", 1), ("tiff_to_zarr_r2", "completed", 1)))
    assert {r["step_id"] for r in ld.ready_steps(full).collect()} == {"registration_r1_to_r2", "segment_reference_round"}
    assert [r["phase"] for r in ld.resume_plan(full).orderBy("phase_ord").collect()] == ["registration_workflows", "segmentation_workflow"]


def test_one_round_plan_skips_empty_phases(spark):
    rounds = spark.createDataFrame(ROUNDS[:2], "round string, channel string, round_ord bigint, channel_ord bigint")
    plan = ld.plan_steps(rounds, "r1")
    done = log_of(spark, ("tiff_to_zarr_r1", "completed", 1), ("segment_reference_round", "completed", 2))
    ready = ld.ready_steps(ld.current_status(plan, done)).collect()
    assert [r["step_id"] for r in ready] == ["save_pipeline_state"]


def test_failures_stay_listed(spark, plan):
    log = log_of(spark, ("tiff_to_zarr_r1", "failed", 1), ("tiff_to_zarr_r1", "in_progress", 2), ("tiff_to_zarr_r1", "completed", 2))
    row = ld.progress(ld.current_status(plan, log)).first()
    assert row["failed_steps"] == ["tiff_to_zarr_r1"] and row["currently_failed"] == []
    assert row["last_completed_step"] == "tiff_to_zarr_r1" and row["completed_steps"] == 1


def test_prerequisites(spark, plan):
    status = ld.current_status(plan, log_of(spark, ("tiff_to_zarr_r1", "completed", 1)))
    assert ld.validate_step_prerequisites(status, "registration_r1_to_r2") == (False, ["tiff_to_zarr_r2"])
    assert ld.validate_step_prerequisites(status, "segment_reference_round") == (True, [])
    assert not ld.validate_step_prerequisites(status, "nope")[0]
    steps = [r["step_id"] for r in ld.steps_to_run(status, "alignment", "r2", "r1").collect()]
    assert steps == ["tiff_to_zarr_r2", "registration_r1_to_r2", "align_channels_r2"]
    assert ld.steps_to_run(status, "alignment", "r1", "r1").count() == 0


def test_completed_outputs_by_step(spark, plan):
    done = ld.current_status(plan, log_of(spark, ("tiff_to_zarr_r1", "completed", 1), ("registration_r1_to_r2", "completed", 2)))
    found = {r["step_id"]: r["outputs"] for r in ld.outputs_by_step(done).collect()}
    assert set(found["tiff_to_zarr_r1"]) == {"a", "b"}
    assert {"deformation_field", "affine_transforms"} <= set(found["registration_r1_to_r2"])


def test_stream_applies_late_rows_in_several_batches(spark, tmp_path):
    source = tmp_path / "log"
    batches = [[("s1", "in_progress", 10), ("s2", "completed", 5)], [("s1", "completed", 20)], [("s1", "failed", 15)]]
    schema = "step_id string, status string, ts timestamp, event_id bigint"
    for i, rows in enumerate(batches):
        data = [(s, v, dt.datetime(2024, 1, 1, 0, 0, t), i * 10 + j) for j, (s, v, t) in enumerate(rows)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(source))
    stream = st.read_log_stream(spark, str(source), schema, max_files=1)
    out = st.run_to_end(stream, st.stream_status, str(tmp_path / "out"), str(tmp_path / "ck"), ["step_id"])
    assert {r["step_id"]: (r["status"], r["updates"]) for r in out.collect()} == {"s1": ("completed", 3), "s2": ("completed", 1)}


def test_shared_folder_comes_from_the_session(spark):
    def session(folder, master):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert workspace(session("file:///shared/x/", "spark://host:7077")) == "file:///shared/x"
    with pytest.raises(ValueError):
        workspace(session(None, "spark://host:7077"))
    assert workspace(spark)


def test_written_state_is_the_same_at_any_size(spark):
    for n in (0, 3, 60_000):
        assert settled(spark.range(n)).count() == n
