"""Block form: invariance under block shape, halo kernels, components, segmentation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import array_of, shape_of, texture, voxels_of
from voxelweave.functions.kernels import gaussian_weights, local_components
from voxelweave.model import Shape
from voxelweave.operators import blocks as bl
from voxelweave.operators import components as cc
from voxelweave.operators import tile_blocks as tb
from voxelweave.operators import tiles as tl

BLOCKS = [Shape(2, 4, 5), Shape(5, 3, 9)]


def smooth_reference(array, sigma):
    taps = gaussian_weights(sigma)
    r = len(taps) // 2
    out = np.pad(array.astype(float), r, mode="symmetric")
    for axis in range(3):
        out = np.apply_along_axis(lambda v: np.convolve(v, taps, mode="same"), axis, out)
    return out[r:-r, r:-r, r:-r]


@pytest.mark.parametrize("block", BLOCKS)
def test_round_trip_and_reblock(spark, block):
    array = texture((5, 11, 9))
    blocks = bl.to_blocks(voxels_of(spark, array), shape_of(array), block)
    assert np.array_equal(array_of(bl.to_voxels(blocks), array.shape), array)
    again = bl.reblock(blocks, shape_of(array), Shape(3, 7, 4))
    assert np.array_equal(array_of(bl.to_voxels(again), array.shape), array)


@pytest.mark.parametrize("block", BLOCKS)
@pytest.mark.parametrize("sigma", [0.6, 1.5])
def test_gaussian_does_not_depend_on_blocks(spark, block, sigma):
    array = texture((5, 11, 9))
    blocks = bl.to_blocks(voxels_of(spark, array), shape_of(array), block)
    out = array_of(bl.block_values(bl.gaussian_smooth(blocks, shape_of(array), block, sigma)), array.shape)
    np.testing.assert_allclose(out, smooth_reference(array, sigma), rtol=1e-9)


def flood(mask):
    """26-connected labels in raster order by flood fill."""
    labels, count = np.zeros(mask.shape, dtype=int), 0
    for start in zip(*np.nonzero(mask)):
        if labels[start]:
            continue
        count += 1
        stack = [start]
        labels[start] = count
        while stack:
            at = stack.pop()
            for shift in np.ndindex(3, 3, 3):
                to = tuple(a + s - 1 for a, s in zip(at, shift))
                if all(0 <= t < n for t, n in zip(to, mask.shape)) and mask[to] and not labels[to]:
                    labels[to] = count
                    stack.append(to)
    return labels


def planted_mask():
    mask = np.zeros((6, 12, 14), dtype=bool)
    mask[0:2, 0:3, 0:3] = True
    mask[2:4, 3:5, 3:5] = True  # touches the first box at a corner only
    mask[5, 1, 0:14] = True  # spans several blocks
    mask[0, 11, 13] = True  # isolated voxel
    return mask


def test_local_components_match_flood_fill():
    rng = np.random.default_rng(3)
    for density in (0.05, 0.2, 0.6):
        mask = rng.random((7, 9, 8)) < density
        ours, truth = local_components(mask), flood(mask)
        pairs = set(zip(ours[mask], truth[mask]))
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


@pytest.mark.parametrize("block", [Shape(2, 4, 5), Shape(3, 5, 4), Shape(6, 12, 14)])
def test_components_across_blocks(spark, block):
    mask = planted_mask()
    blocks = bl.to_blocks(voxels_of(spark, mask.astype(int)), shape_of(mask), block, "uint8")
    found = array_of(cc.label_components(blocks, shape_of(mask), block), mask.shape, "label")
    assert np.array_equal(found, flood(mask))
    assert found.max() == 3


def test_user_segmenter_is_stitched(spark):
    mask = planted_mask()
    block = Shape(3, 5, 6)
    blocks = bl.to_blocks(voxels_of(spark, mask.astype(int) * 100), shape_of(mask), block)
    found = cc.segment_blocks(blocks, shape_of(mask), block, sigma=0, halo=2, fn=lambda a: local_components(a > 50))
    assert np.array_equal(array_of(found, mask.shape, "label"), flood(mask))


def test_long_chain_and_star_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5000, 5000)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in cc.connected_components(edges).collect()}
    assert {roots[i] for i in range(201)} == {0}
    assert {roots[1000 + i] for i in range(300)} == {1000}
    assert roots[5000] == 5000


def test_otsu_separates_two_levels(spark):
    array = np.full((2, 6, 6), 100)
    array[:, 3:, :] = 900
    level = cc.otsu_threshold(voxels_of(spark, array), array.size).first()[0]
    assert 100 < level < 900


def test_chunk_rule():
    assert bl.safe_chunk_shape(Shape(100, 1000, 1000), 2, 50) == Shape(50, 1000, 1000)
    assert bl.safe_chunk_shape(Shape(100, 20000, 20000), 2, 50) == Shape(1, 20000, 20000)


@pytest.mark.parametrize("method", ["max", "overwrite", "weighted_average"])
def test_blends_of_sparse_tiles_equal_the_voxel_form(spark, method):
    """Blocks left out as background count in statistics, overwrite with zeros and add weight."""
    rng, size = np.random.default_rng(3), Shape(2, 8, 8)
    rows = []
    for tile in range(3):
        image = rng.integers(1, 60_000, tuple(size))
        if tile:  # half of the tile is background
            image[:, :, 4:] = 0
        rows += [(tile, "A", *map(int, at), int(image[at])) for at in zip(*np.nonzero(image))]
    vox = spark.createDataFrame(rows, "tile bigint, channel string, z bigint, y bigint, x bigint, value bigint")
    tiles = spark.createDataFrame(
        [(t, 0, 3 * t, 3 * t, *size) for t in range(3)],
        "tile bigint, oz bigint, oy bigint, ox bigint, dz bigint, dy bigint, dx bigint",
    )
    by_channel = tl.per_channel(tiles, ["A"])
    stored = bl.to_blocks(vox.withColumn("round", F.col("tile").cast("string")).drop("tile"), size, Shape(2, 4, 4))
    assert stored.count() < 12
    whole = tb.dense_blocks(stored, tiles, Shape(2, 4, 4))
    assert whole.count() == 12
    want = {r["tile"]: r for r in tl.tile_stats(vox, by_channel).collect()}
    for r in tb.tile_stats(whole).collect():
        for c in ("p1", "p_hi", "mean", "std", "snr"):
            np.testing.assert_allclose(r[c], want[r["tile"]][c])
    got = bl.to_voxels(tb.blend(stored, tiles, Shape(2, 5, 5), Shape(2, 4, 4), method, True)).where("value > 0")
    expected = tl.blend(vox.drop("channel"), tiles, method, True).where("value > 0")
    key = ["z", "y", "x", "value"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted((r[0], r[1], r[2], int(r[3])) for r in expected.select(*key).collect())


def test_groups_that_go_on_over_batches(spark):
    """Groups longer and shorter than a batch, null keys among them, each seen once and whole."""
    rows = [(a, i % 5, i) for a in ("O", "F", None) for i in range(23)] + [("X", None, i) for i in range(7)]
    df = spark.createDataFrame(rows, "name string, part int, value long")
    wanted = {}
    for name, part, value in rows:
        wanted.setdefault((name, part), []).append(value)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = bl.by_group(df, ["name", "part"], lambda key, rows: [(*key, len(rows), sum(r.value for r in rows))], "name string, part int, n long, total long")
        assert "FlatMapGroupsInArrow" not in out._jdf.queryExecution().toString()  # a stream per group
        found = [tuple(r) for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert sorted(found, key=str) == sorted(((*k, len(v), sum(v)) for k, v in wanted.items()), key=str)


def test_blend_makes_the_blocks_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    shape = Shape(4, 8, 8)
    tiles = spark.createDataFrame([(t, 0, 0, 6 * t, *shape) for t in range(3)], "tile long, oz long, oy long, ox long, dz long, dy long, dx long")
    rows = [(str(t), "A", z, y, x, 1 + t) for t in range(3) for z in range(4) for y in range(8) for x in range(8)]
    voxels = spark.createDataFrame(rows, "round string, channel string, z long, y long, x long, value long")
    block = Shape(4, 4, 8)
    blocks = bl.to_blocks(voxels, shape, block)
    blocks = blocks.mapInArrow(counted, blocks.schema)
    found = bl.to_voxels(tb.blend(blocks, tiles, block, block, "max", normalize=False)).collect()
    assert {(r.z, r.y, r.x): r.value for r in found} == {(z, y, x): 1 + min(2, x // 6) for z in range(4) for y in range(8) for x in range(20)}
    assert made.value == 6
