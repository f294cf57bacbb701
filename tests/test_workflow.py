"""A tracked run over raw files: two rounds, the second one displaced."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pytest

from tests.helpers import texture
from voxelweave.model import Shape
from voxelweave.operators.blocks import to_voxels
from voxelweave.plans.config import validate_config
from voxelweave.plans.workflow import Run

SHAPE = Shape(6, 24, 28)


def base_config(root, files):
    return {
        "working_directory": root,
        "voxel_spacing": [1.0, 1.0, 1.0],
        "downsample_factors": {"registration": [1, 1, 1], "segmentation": [1, 2, 2]},
        "block_size": [6, 12, 14],
        "registration": {"merge_strategy": "mean", "channels": ["405"]},
        "segmentation": {"channel": "405", "downsample_for_processing": True, "upsample_results": True},
        "data": {"reference_round": "r1", "rounds": files},
        "cluster_config": {"cluster_type": "spark", "n_workers": 1, "threads_per_worker": 1, "memory_limit": "1GB"},
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    base = texture((SHAPE.nz, SHAPE.ny + 8, SHAPE.nx + 8), 5).astype("<u2")
    files = {}
    for name, (dy, dx) in {"r1": (4, 4), "r2": (3, 6)}.items():
        files[name] = {}
        for channel, gain in (("405", 1), ("640", 2)):
            folder = raw / name / channel
            folder.mkdir(parents=True)
            view = base[:, dy : dy + SHAPE.ny, dx : dx + SHAPE.nx] // gain
            for z in range(SHAPE.nz):
                (folder / f"slice_{z:03d}.raw").write_bytes(np.ascontiguousarray(view[z]).tobytes())
            files[name][channel] = str(folder)
    config = validate_config(base_config(str(tmp_path_factory.mktemp("work")), files))
    steps = [("ransac", {"blob_sizes": (2.0, 4.0), "patch": 1, "n_iter": 200, "tolerance": 0.5})]
    options = {"steps": steps, "deformation": {"search": (0, 1, 1)}, "segmentation": {"sigma": 1.0}}
    return Run(spark, config, SHAPE, **options), base


def test_run_step_runs_prerequisites_first(run):
    tracked, _ = run
    status = {r["step_id"]: r["status"] for r in tracked.run_step("registration", "r2").collect()}
    assert status["tiff_to_zarr_r1"] == status["tiff_to_zarr_r2"] == "completed"
    assert status["registration_r1_to_r2"] == "completed"
    assert status["align_channels_r2"] == "pending"


def test_registration_recovers_the_displacement(run):
    tracked, _ = run
    matrix = tracked.registration("r2")["matrix"]
    np.testing.assert_allclose(matrix[:3, :3], np.eye(3), atol=0.05)
    np.testing.assert_allclose(matrix[1:3, 3], [1, -2], atol=0.5)


def test_run_all_resumes_and_completes(run):
    tracked, base = run
    result = tracked.run_all().first()
    assert result["status"] == "completed" and result["percentage_complete"] == 100.0
    assert tracked.missing_outputs().count() == 0
    assert tracked.nuclei().count() > 0
    aligned = np.zeros(tuple(SHAPE))
    for r in to_voxels(tracked.aligned("r2").filter("channel = '640'")).collect():
        aligned[r["z"], r["y"], r["x"]] = r["value"]
    fixed = base[:, 4 : 4 + SHAPE.ny, 4 : 4 + SHAPE.nx] // 2
    inner = (slice(1, -1), slice(3, -3), slice(3, -3))
    assert np.corrcoef(aligned[inner].ravel(), fixed[inner].ravel())[0, 1] > 0.95
    report = json.loads(tracked.spark.read.text(f"{tracked.root}/report").first()[0])
    assert report["pipeline_summary"]["total_registrations"] == 1


def test_deleted_outputs_are_reported(run):
    tracked, _ = run
    kept = Path(f"{tracked.root}/aligned/r2/channel=640")
    aside = kept.rename(Path(tracked.root).parent / "channel=640-aside")
    found = [tuple(r) for r in tracked.missing_outputs().collect()]
    aside.rename(kept)
    assert found == [("align_channels_r2", "aligned/r2/r2_640_aligned.zarr")]
    assert tracked.missing_outputs().count() == 0


def test_reset_phase_reopens_its_steps(run):
    tracked, _ = run
    tracked.reset("channel_alignment")
    status = {r["step_id"]: r["status"] for r in tracked.status().collect()}
    assert status["align_channels_r2"] == "pending" and status["registration_r1_to_r2"] == "completed"


def test_unknown_round_and_step(run):
    tracked, _ = run
    with pytest.raises(ValueError):
        tracked.run_step("registration", "r9")
    with pytest.raises(ValueError):
        tracked.run_step("nothing")


@pytest.mark.parametrize("section,key", [("registration", "channels"), ("segmentation", "channel"), ("data", "rounds"), ("cluster_config", "n_workers")])
def test_config_names_the_missing_key(section, key):
    config = base_config("/tmp/x", {"r1": {"405": "a"}})
    del config[section][key]
    with pytest.raises(ValueError, match=key):
        validate_config(config)


def test_config_forms(spark):
    config = base_config("/tmp/x", {"r1": {"405": "a"}})
    config["downsample_factors"] = [2, 3, 3]
    checked = validate_config(config)
    assert checked.registration_factors == checked.segmentation_factors == (2, 3, 3)
    assert checked.segmentation_cluster == config["cluster_config"]
    config["data"]["reference_round"] = "r7"
    with pytest.raises(ValueError, match="r7"):
        validate_config(config)
