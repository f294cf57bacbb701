"""Pixel math, tiles, projections and resampling against NumPy."""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np
import pytest

from tests.helpers import array_of, shape_of, texture, voxels_of
from voxelweave.model import Shape, check_percentile_range
from voxelweave.operators import objects as ob
from voxelweave.operators import pixel as px
from voxelweave.operators import projections as pr
from voxelweave.operators import resample as rs
from voxelweave.operators import tiles as tl
from voxelweave.operators import transform as tf
from voxelweave.sources.render import png_bytes, render_png


def test_scale_uses_float32_and_half_up(spark):
    array = texture((2, 5, 6))
    lo, hi = float(array.min()), float(array.max())
    want = (array.astype(np.float32) - np.float32(lo)) * np.float32(65535.0 / (hi - lo))
    want = (np.clip(want, np.float32(0), np.float32(65535)) + np.float32(0.5)).astype(np.uint16)
    got = array_of(px.scale_to_uint16(voxels_of(spark, array), shape_of(array)), array.shape)
    assert np.array_equal(got, want)


def test_flat_volume_scales_to_zero(spark):
    array = np.full((2, 3, 3), 7)
    assert not array_of(px.scale_to_uint16(voxels_of(spark, array), shape_of(array)), array.shape).any()


def test_merge_is_symmetric(spark):
    a, b = texture((2, 5, 6), 1), texture((2, 5, 6), 2)
    both = voxels_of(spark, a, channel="A").unionByName(voxels_of(spark, b, channel="B"))
    for strategy in ("mean", "max"):
        one = px.merge_channels(both, "A", "B", shape_of(a), strategy)
        two = px.merge_channels(both, "B", "A", shape_of(a), strategy)
        assert np.array_equal(array_of(one, a.shape), array_of(two, a.shape))


def test_argument_errors(spark):
    array = texture((2, 4, 4))
    vox = voxels_of(spark, array)
    with pytest.raises(ValueError):
        px.merge_channels(vox, "A", "B", shape_of(array), "median")
    with pytest.raises(ValueError):
        px.registration_channel(vox, ["A", "B", "C"], shape_of(array))
    with pytest.raises(ValueError):
        px.reorient(vox, shape_of(array), 45)
    with pytest.raises(ValueError):
        px.stack_images(vox, "A", "B", Shape(1, 2, 3), Shape(1, 2, 4))
    with pytest.raises(ValueError):
        tl.blend(vox, vox, "median")
    with pytest.raises(ValueError):
        ob.nuclei_page(vox, 0, 101)
    for bounds in ((5, 5), (-1, 50), (10, 101), (1,)):
        with pytest.raises(ValueError):
            check_percentile_range(bounds)


@pytest.mark.parametrize("rotation", [0, 90, 180, 270])
def test_reorient_matches_rot90(spark, rotation):
    array = texture((3, 4, 6))
    want = np.rot90(array, k=-(rotation // 90), axes=(1, 2))[::-1]
    got = array_of(px.reorient(voxels_of(spark, array), shape_of(array), rotation, flip_z=True), want.shape)
    assert np.array_equal(got, want)


def tile_set(spark, arrays, offsets):
    rows = [(i, *map(float, off), *arrays[i].shape) for i, off in enumerate(offsets)]
    tiles = spark.createDataFrame(rows, "tile bigint, oz double, oy double, ox double, dz bigint, dy bigint, dx bigint")
    vox = [(i, *map(int, at), int(a[at])) for i, a in enumerate(arrays) for at in zip(*np.nonzero(a))]
    return tiles, spark.createDataFrame(vox, "tile bigint, z bigint, y bigint, x bigint, value bigint")


@pytest.mark.parametrize("method", ["max", "overwrite", "weighted_average"])
@pytest.mark.parametrize("flip", [(), ("y", "x")])
def test_blend_matches_numpy(spark, method, flip):
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 5000, (2, 8, 9)) * (rng.random((2, 8, 9)) > 0.3) for _ in range(3)]
    offsets = [(0, 0, 0), (0, 0.5, 5), (0, 6, 1.5)]
    tiles, vox = tile_set(spark, arrays, offsets)
    shape = [int(np.ceil(max(o[i] + a.shape[i] for o, a in zip(offsets, arrays)))) for i in range(3)]
    stats = []
    for a in arrays:
        p1, p2 = np.percentile(a, 1.0), np.percentile(a, 99.9)
        c = np.clip(a.astype(float), p1, p2)
        stats.append((p1, p2, (c.mean() - p1) / (c.std() + 1e-6)))
    ref = np.median([s[1] for s in stats])
    top, weights = np.zeros(shape), np.zeros(shape)
    for a, off, (p1, p2, snr) in zip(arrays, offsets, stats):
        if flip:
            a = np.flip(a, axis=(1, 2))
        at = tuple(slice(int(round(o)), int(round(o)) + n) for o, n in zip(off, a.shape))
        if method == "max":
            top[at] = np.maximum(top[at], a)
        elif method == "overwrite":
            top[at] = a
        else:
            ramps = [np.clip(np.minimum(np.arange(n), np.arange(n)[::-1]) / 4, 0, 1) for n in a.shape]
            ramps[0] = np.clip(np.minimum(np.arange(2), np.arange(2)[::-1]) / 4, 0, 1)
            w = ramps[0][:, None, None] * ramps[1][None, :, None] * ramps[2][None, None, :]
            w = w * max(0.1, min(1, p2 / (ref + 1e-6))) * max(0.1, min(1, snr / 5))
            top[at] += w * a
            weights[at] += w
    if method == "weighted_average":
        top = np.rint(np.round(np.divide(top, weights, out=np.zeros(shape), where=weights > 0), 6))
    got = tl.blend(vox, tiles, method, normalize=False, feather_pad=4, flip_axes=flip)
    assert np.array_equal(array_of(got, shape), top)


@pytest.mark.parametrize("method", ["weighted_average", "overwrite"])
def test_parts_of_a_blend_grow_with_the_tiles(spark, monkeypatch, method):
    rows = [(t, 0, y, x, 100 * t + y * x) for t in (1, 2) for y in range(6) for x in range(6) if (y + x) % 3]
    vox = spark.createDataFrame(rows, "tile bigint, z bigint, y bigint, x bigint, value bigint")
    tiles = spark.createDataFrame([(1, 0, 0, 0, 1, 6, 6), (2, 0, 0, 4, 1, 6, 6)], "tile bigint, oz bigint, oy bigint, ox bigint, dz bigint, dy bigint, dx bigint")
    usual = sorted(map(tuple, tl.blend(vox, tiles, method, feather_pad=2).collect()))
    monkeypatch.setattr("voxelweave.functions.sizing.PART_ROWS", 4)
    wide = tl.blend(vox, tiles, method, feather_pad=2)
    assert wide.rdd.getNumPartitions() == 18  # 72 places, four a part
    assert sorted(map(tuple, wide.collect())) == usual


def test_crowded_cells_are_dealt_in_shares(spark, monkeypatch):
    rows = [(t, 0, t * 5 % 13, t * 7 % 17, 2, 9, 9) for t in range(25)]
    tiles = spark.createDataFrame(rows, "tile bigint, oz bigint, oy bigint, ox bigint, dz bigint, dy bigint, dx bigint")
    usual, few = tl.overlap_pairs(tiles, 2), tl.overlap_pairs(tiles, 2).rdd.getNumPartitions()
    monkeypatch.setattr(tl, "SHARE_TILES", 1)
    dealt = tl.overlap_pairs(tiles, 2)
    assert dealt.rdd.getNumPartitions() == 5 * int(spark.conf.get("spark.sql.shuffle.partitions")) >= few
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, usual.collect()))


def test_parts_grow_with_the_volume(spark, monkeypatch):
    """Projections, affine and spacing: more parts for more places, the same rows."""
    array = texture((2, 8, 8))
    vox, ext = voxels_of(spark, array), shape_of(array)
    masks = spark.createDataFrame([(1, z, y, 2) for z in (0, 1) for y in (2, 3)], "label bigint, z bigint, y bigint, x bigint")
    box = spark.createDataFrame([(1, 0, 8, 0, 6)], "label bigint, pmin_y bigint, pmax_y bigint, pmin_x bigint, pmax_x bigint")
    runs = {
        "mips": lambda: pr.nucleus_mip(pr.masked_voxels(masks, vox), pr.crop_pixels(box, ["A"])),
        "affine": lambda: tf.apply_affine(vox, np.eye(4), ext),
        "spacing": lambda: rs.resample_spacing(vox, ext, (1.0, 1.0, 1.0), (2.0, 2.0, 1.0)),
    }
    usual = {name: sorted(map(tuple, run().collect())) for name, run in runs.items()}
    monkeypatch.setattr("voxelweave.functions.sizing.PART_ROWS", 4)
    for name, parts in (("mips", 12), ("affine", 256), ("spacing", 64)):
        out = runs[name]()
        assert out.rdd.getNumPartitions() == parts, name
        assert sorted(map(tuple, out.collect())) == usual[name]


def test_dense_and_sparse_blends_agree(spark):
    arrays = [texture((3, 8, 9), s) // 20 + 1 for s in range(2)]
    tiles, vox = tile_set(spark, arrays, [(0, 0, 0), (0, 2, 4)])
    one = tl.blend(vox, tiles, feather_pad=2)
    two = tl.blend(vox, tiles, feather_pad=2, dense=True)
    assert np.array_equal(array_of(one, (3, 10, 13)), array_of(two, (3, 10, 13)))


def separable(array, weights):
    for axis, w in enumerate(weights):
        array = np.moveaxis(np.tensordot(w, array, axes=(1, axis)), 0, axis)
    return array


def linear_weights(n, m):
    w = np.zeros((m, n))
    for o in range(m):
        c = o * (n - 1) / (m - 1) if m > 1 else 0.0
        i = min(int(c), n - 1)
        w[o, i] += 1 - (c - i)
        if c > i:
            w[o, i + 1] += c - i
    return w


@pytest.mark.parametrize("factors", [(1, 2, 3), (2, 2.5, 4), (5, 1, 1)])
def test_downsample_matches_numpy(spark, factors):
    array = texture((5, 9, 13))
    out = shape_of(array).scaled_down(factors)
    want = np.floor(np.round(separable(array, [linear_weights(n, m) for n, m in zip(array.shape, out)]), 6) + 0.5)
    got = array_of(rs.downsample(voxels_of(spark, array), shape_of(array), factors), out)
    assert np.array_equal(got, want)


def test_upsampled_labels_keep_the_label_set(spark):
    labels = np.zeros((3, 5, 4), dtype=int)
    labels[1, 1:3, 0:2], labels[2, 4, 3] = 7, 2000000000
    rows = [(int(labels[at]), *map(int, at)) for at in zip(*np.nonzero(labels))]
    df = spark.createDataFrame(rows, "label bigint, z bigint, y bigint, x bigint")
    target = Shape(3, 16, 11)
    got = array_of(rs.upsample_labels(df, shape_of(labels), target=target), target, "label")
    index = [np.floor(np.arange(m) * (n - 1) / (m - 1) + 0.5).astype(int) for n, m in zip(labels.shape, target)]
    assert np.array_equal(got, labels[np.ix_(*index)])


def test_bspline_field_interpolates_the_coarse_values(spark):
    rng = np.random.default_rng(2)
    coarse = rng.normal(size=(3, 6, 7))
    rows = [(*map(int, at), float(coarse[at]), 0.0, 1.0) for at in np.ndindex(coarse.shape)]
    df = spark.createDataFrame(rows, "z bigint, y bigint, x bigint, dz double, dy double, dx double")
    target = Shape(3, 12, 14)
    out = rs.upsample_field(df, shape_of(coarse), target, (1, 2, 2), "bspline")
    got = array_of(out, target, "dz")
    np.testing.assert_allclose(got[:, ::2, ::2], coarse, atol=1e-5)
    np.testing.assert_allclose(array_of(out, target, "dx")[:, :11, :13], 1.0, atol=1e-5)


def test_bspline_rows_travel_once_a_pass_and_keep_odd_rows(spark):
    """A row goes to the runs of outputs it reaches, not to every output; repeats add up, nulls count for nothing."""
    wide = spark.range(2000).selectExpr("0L AS z", "0L AS y", "id AS x", "1D AS dz", "0D AS dy", "0D AS dx")
    assert rs._spline_chunks(wide, "x", 2000, 4000, 0.5).count() <= 1.3 * 2000
    schema = "z bigint, y bigint, x bigint, dz double, dy double, dx double"
    rows = [(0, 0, 300, 1.0, None, 2.0), (0, 0, 300, 2.0, None, None), (0, None, 300, 9.0, 9.0, 9.0)]
    out = rs.upsample_field(spark.createDataFrame(rows, schema), Shape(1, 1, 600), Shape(1, 1, 1200), (1, 1, 2), "bspline")
    got = {r["x"]: r for r in out.collect()}
    assert sorted(got) == list(range(576, 625))  # sources within twelve of the outputs' places
    assert got[600]["dz"] == pytest.approx(1.5 * got[600]["dx"]) and got[600]["dx"] == pytest.approx(2.0, abs=1e-5)
    assert all(r["dy"] is None for r in got.values())


def test_identity_transform_returns_the_volume(spark):
    array = texture((3, 6, 7))
    got = tf.apply_affine(voxels_of(spark, array), np.eye(4), shape_of(array), (0.3, 0.1, 0.1))
    assert np.array_equal(array_of(got, array.shape), array)


def test_field_list_equals_two_steps_on_whole_shifts(spark):
    array = texture((2, 8, 8))
    grid = [(z, y, x, 0.0, 1.0, 0.0) for z in range(2) for y in range(8) for x in range(8)]
    field = spark.createDataFrame(grid, "z bigint, y bigint, x bigint, dz double, dy double, dx double")
    vox = voxels_of(spark, array)
    once = tf.apply_transforms(vox, [field, field], shape_of(array))
    twice = tf.apply_field(tf.apply_field(vox, field, shape_of(array)), field, shape_of(array))
    assert np.array_equal(array_of(once, array.shape), array_of(twice, array.shape))


def read_png(data):
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    pos, body, head = 8, b"", None
    while pos < len(data):
        size, tag = struct.unpack(">I4s", data[pos : pos + 8])
        part = data[pos + 8 : pos + 8 + size]
        head = struct.unpack(">IIBBBBB", part) if tag == b"IHDR" else head
        body += part if tag == b"IDAT" else b""
        pos += 12 + size
    w, h, _, color = head[:4]
    lines = np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(h, -1)[:, 1:]
    return lines.reshape(h, w, 3) if color == 2 else lines


def test_png_sink_decodes_to_the_pixels(spark):
    image = np.arange(12).reshape(3, 4) * 20
    rows = [(1, y, x, int(image[y, x])) for y in range(3) for x in range(4)]
    df = spark.createDataFrame(rows, "label bigint, y bigint, x bigint, gray bigint")
    row = render_png(df, ["label"], ["gray"]).first()
    assert np.array_equal(read_png(base64.b64decode(row["uri"].split(",")[1])), image)
    rgb = np.random.default_rng(0).integers(0, 256, (4, 5, 3)).astype(np.uint8)
    assert np.array_equal(read_png(png_bytes(rgb)), rgb)
    with pytest.raises(ValueError):
        png_bytes(np.zeros((2, 2, 4)))


def test_unknown_channels_are_an_error(spark):
    vox = voxels_of(spark, texture((1, 2, 2)))
    assert pr.resolve_channels(vox, ["A", "Q"]) == (["A"], ["Q"])
    with pytest.raises(ValueError):
        pr.resolve_channels(vox, ["Q"])
