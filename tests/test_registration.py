"""Planted-truth tests of transform estimation and stitching."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import array_of, shape_of, texture, voxels_of
from voxelweave.model import VOXEL_SCHEMA, Shape
from voxelweave.operators import blocks as bl
from voxelweave.operators import matching as mt
from voxelweave.operators import registration as rg
from voxelweave.operators import stitching as sg
from voxelweave.operators import tiles as tl
from voxelweave.operators import transform as tf
from voxelweave.queries import registration


def test_phase_correlation_finds_a_planted_shift(spark):
    size, true = (6, 20, 20), (1, 3, -2)
    base, rows = texture((10, 30, 40), 11), []
    for tile, (oz, oy, ox) in enumerate([(0, 0, 0), (0 + true[0], 0 + true[1], 10 + true[2])]):
        values = base[oz : oz + size[0], oy : oy + size[1], ox : ox + size[2]]
        rows += [(tile, *map(int, at), int(values[at])) for at in np.ndindex(size)]
    vox = spark.createDataFrame(rows, "tile bigint, z bigint, y bigint, x bigint, value bigint")
    tiles = spark.createDataFrame(
        [(0, 0, 0, 0, *size), (1, 0, 0, 10, *size)], "tile bigint, oz bigint, oy bigint, ox bigint, dz bigint, dy bigint, dx bigint"
    )
    pairs = tl.overlap_pairs(tiles, 4)
    link = sg.phase_correlation(pairs, vox, min_overlap=3).first()
    np.testing.assert_allclose([link["sz"], link["sy"], link["sx"]], true, atol=0.5)
    assert link["r"] > 0.9
    # Many small windows, summed over several levels, give the same answer.
    small = sg.phase_correlation(pairs, vox, min_overlap=3, window=8).first()
    np.testing.assert_allclose([small[c] for c in ("sz", "sy", "sx", "r")], [link[c] for c in ("sz", "sy", "sx", "r")], atol=1e-6)


def test_phase_correlation_of_many_windows_and_of_nothing(spark, monkeypatch):
    size, true = (4, 24, 26), (0, -3, 2)
    base, rows = texture((8, 40, 60), 3), []
    for tile, (oy, ox) in enumerate([(5, 5), (5 + true[1], 7 + true[2])]):
        values = base[:4, oy : oy + size[1], ox : ox + size[2]]
        rows += [(tile, *map(int, at), int(values[at])) for at in np.ndindex(size)]
    rows += [(2, 0, 0, 0, 5)]  # a tile with a single voxel: no correlation
    vox = spark.createDataFrame(rows, "tile bigint, z bigint, y bigint, x bigint, value bigint")
    places = [(0, 0, 0, 0, *size), (1, 0, 0, 2, *size), (2, 0, 0, 0, *size)]
    tiles = spark.createDataFrame(places, "tile bigint, oz bigint, oy bigint, ox bigint, dz bigint, dy bigint, dx bigint")
    pairs = tl.overlap_pairs(tiles, 4)
    monkeypatch.setattr(sg, "FAN_IN", 2)
    links = {(r["tile_a"], r["tile_b"]): r for r in sg.phase_correlation(pairs, vox, min_overlap=3, window=8).collect()}
    near = links[0, 1]
    np.testing.assert_allclose([near["sz"], near["sy"], near["sx"]], true, atol=0.5)
    assert near["r"] > 0.9
    assert len(links) == 3 and abs(links[1, 2]["r"]) <= 1
    assert sg.phase_correlation(pairs.limit(0), vox, min_overlap=3).count() == 0
    with pytest.raises(ValueError):
        sg.phase_correlation(pairs, vox, window=7)


def textured_pairs(spark):
    """Two displaced tiles and one of a single voxel, with their pairs."""
    size, true = (4, 24, 26), (0, -3, 2)
    base, rows = texture((8, 40, 60), 3), []
    for tile, (oy, ox) in enumerate([(5, 5), (5 + true[1], 7 + true[2])]):
        values = base[:4, oy : oy + size[1], ox : ox + size[2]]
        rows += [(tile, *map(int, at), int(values[at])) for at in np.ndindex(size)]
    vox = spark.createDataFrame([*rows, (2, 0, 0, 0, 5)], "tile bigint, z bigint, y bigint, x bigint, value bigint")
    places = [(0, 0, 0, 0, *size), (1, 0, 0, 2, *size), (2, 0, 0, 0, *size)]
    tiles = spark.createDataFrame(places, "tile bigint, oz bigint, oy bigint, ox bigint, dz bigint, dy bigint, dx bigint")
    return tl.overlap_pairs(tiles, 4), vox


def test_no_table_that_grows_with_the_pairs_is_broadcast(spark, monkeypatch):
    """Tables read back are sized by their compressed files, so a small file can be millions of shifts on the driver."""
    plans, settled = [], sg.settled
    pairs, vox = textured_pairs(spark)
    pairs = settled(pairs)

    def watched(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return settled(df)

    monkeypatch.setattr(sg, "settled", watched)
    monkeypatch.setattr(sg, "PAIR_VOXELS", 0, raising=False)
    watched(sg.phase_correlation(pairs, vox, min_overlap=3, window=8))
    assert len(plans) > 3 and any("Join" in plan for plan in plans)
    assert not [plan for plan in plans if "BroadcastHashJoin" in plan]


def test_small_overlaps_are_one_task_s_work_with_the_same_shifts(spark, monkeypatch):
    """Whole pairs at once against windows, spectra and blocks in tables; null values, several windows and blocks, runs over batches."""
    pairs, vox = textured_pairs(spark)
    holes = vox.withColumn("value", F.when((F.col("tile") == 1) & (F.col("y") == 3) & (F.col("x") == 9), F.lit(None)).otherwise(F.col("value")))
    wrote, settled = [], sg.settled
    monkeypatch.setattr(sg, "FAN_IN", 2)
    monkeypatch.setattr(sg, "settled", lambda df: wrote.append(df.columns) or settled(df))
    for voxels, options in ((vox, {"window": 8}), (vox, {"window": 16, "peaks": 9}), (holes, {"window": 8}), (vox.filter("tile < 0"), {})):
        rows = {}
        for limit, held in ((32**3, 1 << 18), (32**3, 100), (0, 1 << 18)):
            monkeypatch.setattr(sg, "PAIR_VOXELS", limit)
            monkeypatch.setattr(sg, "RUN_ROWS", held)
            wrote.clear()
            found = sg.phase_correlation(pairs, voxels, min_overlap=3, **options)
            assert found.schema.names == ["tile_a", "tile_b", "sz", "sy", "sx", "r"]
            assert (len(wrote) == 1) == (limit > 0)
            rows[limit, held] = sorted(map(tuple, found.collect()))
        first, *others = rows.values()
        assert all(len(first) == len(other) for other in others)
        for other in others:
            np.testing.assert_allclose(np.array(first).reshape(-1, 6), np.array(other).reshape(-1, 6), atol=1e-9)


def test_placement_is_the_least_squares_one(spark):
    rng = np.random.default_rng(4)
    spots = {i: np.array([0.0, 10.0 * (i // 3), 10.0 * (i % 3)]) for i in range(9)}
    spots[9] = np.array([0.0, 99.0, 99.0])  # not linked to anything
    moved = {i: p + rng.normal(size=3) for i, p in spots.items()}
    rows = [(i, *map(float, p)) for i, p in spots.items()]
    tiles = spark.createDataFrame(rows, "tile bigint, oz double, oy double, ox double")
    pairs = [(i, j) for i in range(9) for j in range(i + 1, 9) if abs(i // 3 - j // 3) + abs(i % 3 - j % 3) == 1]
    links = [(i, j, *map(float, moved[j] - moved[i] + rng.normal(size=3) * 0.01)) for i, j in pairs]
    df = spark.createDataFrame(links, "tile_a bigint, tile_b bigint, mz double, my double, mx double")
    graph, pull, start = np.zeros((10, 10)), np.zeros((10, 3)), np.array([spots[i] for i in range(10)])
    for i, j, *gap in links:
        graph[[i, j], [i, j]] += 1.0
        graph[[i, j], [j, i]] -= 1.0
        pull[i] -= gap
        pull[j] += gap
    exact = start + np.linalg.lstsq(graph, pull - graph @ start, rcond=None)[0]
    spread = {r["tile"]: np.array(r[1:]) for r in sg._solve(tiles, df).collect()}
    for i in spots:
        np.testing.assert_allclose(spread[i], exact[i], atol=1e-5)
    np.testing.assert_allclose(spread[9], spots[9])


def test_block_shift_and_deformation_follow_a_displacement(spark):
    shape, block = Shape(4, 24, 24), Shape(4, 12, 12)
    base = texture((4, 40, 40), 7)
    fixed, moving = base[:, 8:32, 8:32], base[:, 7:31, 10:34]  # moving(x + (0, 1, -2)) = fixed(x)
    vf, vm = voxels_of(spark, fixed), voxels_of(spark, moving)
    bf, bm = (bl.to_blocks(v, shape, block) for v in (vf, vm))
    for r in rg.block_shifts(bf, bm, shape, block, search=(0, 2, 2)).collect():
        assert (r["dz"], r["dy"], r["dx"]) == (0.0, 1.0, -2.0)
    field, aligned = rg.register_deformation(bf, bm, shape, block, search=(0, 2, 2))
    got = array_of(bl.to_voxels(aligned), tuple(shape))
    assert np.array_equal(got[:, :-1, 2:], fixed[:, :-1, 2:])
    with pytest.raises(ValueError):
        rg.register_deformation(bf, bm, shape, block, use_chunk_alignment=True)


@pytest.mark.parametrize("true", [(0, 5, 0), (0, -5, 4), (1, 3, -5), (0, 0, 0)])
def test_pyramid_finds_a_third_of_a_block(spark, true):
    shape, block = Shape(8, 48, 48), Shape(8, 16, 16)
    base = texture((20, 80, 80), 21)
    fixed = base[6:14, 16:64, 16:64]
    moving = base[tuple(slice(o - d, o - d + n) for o, d, n in zip((6, 16, 16), true, shape))]
    pair = [bl.to_blocks(voxels_of(spark, v), shape, block) for v in (fixed, moving)]
    rows = {(r["by"], r["bx"]): (r["dz"], r["dy"], r["dx"]) for r in rg.block_shifts(*pair, shape, block).collect()}
    assert rows[1, 1] == true  # the block in the middle sees all of its displaced window
    assert set(rows.values()) == {tuple(map(float, true))}


def test_noise_and_displacements_beyond_reach_give_no_row(spark):
    shape, block = Shape(8, 48, 48), Shape(8, 16, 16)
    rng = np.random.default_rng(3)
    noise = [bl.to_blocks(voxels_of(spark, rng.integers(0, 60000, tuple(shape))), shape, block) for _ in range(2)]
    assert rg.block_shifts(*noise, shape, block).count() == 0
    base = texture((8, 120, 48), 22)
    far = [bl.to_blocks(voxels_of(spark, base[:, o : o + 48]), shape, block) for o in (8, 28)]
    rows = rg.block_shifts(*far, shape, block).collect()
    assert all(r["ncc"] < 0.6 for r in rows) and len(rows) <= 2
    with pytest.raises(rg.NotConverged):
        rg.refine_affine(*(bl.to_voxels(v) for v in far), shape, (1.0, 1.0, 1.0), shrink_factors=(1,), iterations=30)


def test_chunk_alignment_gives_physical_vectors(spark):
    shape, block = Shape(2, 24, 24), Shape(2, 12, 12)
    base = texture((2, 40, 40), 8)
    pair = [voxels_of(spark, base[:, 8:32, 8:32]), voxels_of(spark, base[:, 8:32, 10:34])]
    field = rg.chunk_alignment(*pair, shape, block, spacing=(1.0, 0.5, 0.5), factors=(1, 1, 1), search=(0, 1, 2))
    vectors = {(r["dz"], r["dy"], r["dx"]) for r in field.collect()}
    assert vectors == {(0.0, 0.0, -1.0)}
    with pytest.raises(ValueError):
        rg.chunk_alignment(*pair, shape, block, factors=(1, 0, 3))


def test_mutual_information_search_improves_the_matrix(spark):
    shape = Shape(3, 16, 16)
    base = texture((3, 30, 30), 9)
    fixed, moving = voxels_of(spark, base[:, 5:21, 5:21]), voxels_of(spark, base[:, 5:21, 6:22])
    best = rg.refine_affine(fixed, moving, shape, (1.0, 1.0, 1.0), shrink_factors=(1,), generations=1)
    np.testing.assert_allclose(best, [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, -1], [0, 0, 0, 1]])


def test_search_goes_on_until_nothing_improves(spark, monkeypatch):
    """Jobs asked for are the least of a level, not its end; the query leaves out no level and no job."""
    shape, base = Shape(3, 16, 16), texture((3, 30, 30), 9)
    fixed, moving = voxels_of(spark, base[:, 5:21, 5:21]), voxels_of(spark, base[:, 5:21, 7:23])
    best = rg.refine_affine(fixed, moving, shape, (1.0, 1.0, 1.0), shrink_factors=(1,), generations=1)
    np.testing.assert_allclose(best[:3, 3], [0, 0, -2])
    asked = []
    monkeypatch.setattr(registration, "_fixed_moving", lambda spark, sf: (fixed, moving, shape))
    monkeypatch.setattr(rg, "_ransac_step", lambda *args: np.eye(4))
    monkeypatch.setattr(rg, "refine_affine", lambda *args, **options: asked.append(options) or np.eye(4))
    registration.reg_affine(spark, "")
    assert asked == [{"shrink_factors": (4, 2, 1)}]


@pytest.mark.parametrize("worse", [1.0, 0.0])
def test_finer_levels_can_go_back_to_the_start(spark, monkeypatch, worse):
    """A coarse level that drifts does not cost the finest one the matrix that the search began with, nor do ties."""
    shape, start, seen = Shape(2, 8, 8), np.eye(4), []
    volume = voxels_of(spark, texture(tuple(shape), 4))

    def score(f, m, small, spacing, matrices):
        seen.append(tuple(small))
        moved = [float(np.abs(matrix - start).sum()) for matrix in matrices]
        mi = [-worse * x if small == shape else min(x, 9.0) for x in moved]
        return spark.createDataFrame(list(enumerate(mi)), "candidate int, mi double")

    monkeypatch.setattr(rg, "score_candidates", score)
    best = rg.refine_affine(volume, volume, shape, (1.0, 1.0, 1.0), start, shrink_factors=(2, 1), linear_step=0.02)
    np.testing.assert_allclose(best, start)
    assert len(set(seen)) == 2 and seen.count(tuple(shape)) <= 5


def test_scores_by_blocks_equal_voxel_by_voxel(spark, monkeypatch):
    """Candidates over several blocks against all voxels; singular and far ones too. A block's crop travels once for all of them."""
    rng, shape = np.random.default_rng(3), Shape(4, 20, 23)
    arrays = [rng.integers(0, 65536, tuple(shape)) * (rng.random(tuple(shape)) < 0.7) for _ in range(2)]
    f, m = (spark.createDataFrame([("O", "A", *map(int, at), int(v[at])) for at in np.ndindex(*shape) if v[at]], VOXEL_SCHEMA) for v in arrays)
    turned = np.array([[1.0, 0.03, 0.0, 0.4], [0.02, 0.9, -0.2, 3.0], [0.1, 0.2, 1.1, -2.5], [0, 0, 0, 1.0]])
    flat, far = np.diag([1.0, 0.0, 1.0, 1.0]), np.eye(4)
    far[:3, 3] = 1000
    matrices = [np.eye(4), turned, flat, far]
    monkeypatch.setattr(rg, "SCORE_BLOCK", Shape(3, 8, 7))
    got = rg.score_candidates(rg.binned_blocks(f, shape), rg.binned_blocks(m, shape), shape, (1.0, 1.0, 1.0), matrices)
    found = {r["candidate"]: r["mi"] for r in got.collect()}
    points = np.indices(tuple(shape)).reshape(3, -1)
    for i, matrix in enumerate(matrices):
        terms = [matrix[:3, 3:], *(matrix[:3, k : k + 1] * points[k] for k in range(3))]
        at = np.floor(sum(terms) + 0.5).astype(int)
        inside = ((at >= 0) & (at < np.array(tuple(shape))[:, None])).all(0)
        seen = np.zeros(shape.size, int)
        seen[inside] = arrays[1][tuple(at[:, inside])]
        joint = np.zeros((32, 32))
        np.add.at(joint, (arrays[0].reshape(-1) // 2048, seen // 2048), 1 / shape.size)
        p = joint[joint > 0]
        alone = np.outer(joint.sum(1), joint.sum(0))[joint > 0]
        assert found[i] == pytest.approx((p * np.log(p / alone)).sum(), abs=1e-9)


def test_features_are_block_independent(spark):
    array = texture((4, 20, 22), 3)
    found = []
    for block in (Shape(4, 7, 9), Shape(2, 20, 22)):
        blocks = bl.to_blocks(voxels_of(spark, array), shape_of(array), block)
        rows = mt.detect_blobs(blocks, shape_of(array), block, (2.0, 4.0), threshold=50.0).collect()
        found.append({(r["z"], r["y"], r["x"], r["response"]) for r in rows})
    assert found[0] == found[1] and found[0]


def test_ransac_needs_four_matches(spark):
    rows = spark.createDataFrame([(0.0,) * 6] * 3, "pz double, py double, px double, qz double, qy double, qx double")
    with pytest.raises(ValueError):
        mt.ransac_affine(rows)


def test_block_and_voxel_transforms_agree(spark):
    shape, block = Shape(4, 14, 13), Shape(2, 5, 6)
    array = texture(tuple(shape), 6)
    matrix = [[0.97, 0.02, 0.0, 0.3], [0.05, 1.02, -0.04, -1.2], [0.0, 0.03, 0.95, 1.1]]
    vox = voxels_of(spark, array)
    one = tf.apply_affine(vox, matrix, shape, (0.5, 0.2, 0.2))
    two = tf.apply_transforms_blocks(bl.to_blocks(vox, shape, block), matrix, shape, Shape(3, 4, 7), shape, (0.5, 0.2, 0.2))
    assert np.array_equal(array_of(one, shape), array_of(bl.to_voxels(two), shape))


def test_singular_matrix_is_still_exact_in_blocks(spark):
    shape, block = Shape(3, 6, 6), Shape(2, 3, 3)
    vox = voxels_of(spark, texture(tuple(shape), 6))
    flat = [[1, 0, 0, 0], [0, 0, 0, 2], [0, 0, 1, 0]]
    one = tf.apply_affine(vox, flat, shape)
    two = tf.apply_transforms_blocks(bl.to_blocks(vox, shape, block), flat, shape, block, shape)
    assert np.array_equal(array_of(one, shape), array_of(bl.to_voxels(two), shape))


def test_peaks_are_found_a_pair_at_a_time():
    """One pair's spectrum gives its distinct shifts; nothing of another pair is held beside it."""
    image = np.random.default_rng(0).random((2, 4, 4))
    spectrum = np.fft.rfftn(image) * np.conj(np.fft.rfftn(np.roll(image, 1, 2)))
    part = pd.DataFrame([(1, 2, 0, 2, 4, 4, spectrum.tobytes())], columns=["tile_a", "tile_b", "share", "ez", "ey", "ex", "spectrum"])
    found = sg._peaks(1)((1, 2), part)
    assert sorted(found[["sz", "sy", "sx"]].itertuples(index=False, name=None)) == [(z, y, x) for z in (-2, 0) for y in (-4, 0) for x in (-1, 3)]
    assert set(zip(found["tile_a"], found["tile_b"])) == {(1, 2)}
