"""Pixel-wise queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.operators import pixel as px
from voxelweave.queries.registry import Registry
from voxelweave.sources import fixtures as fx
from voxelweave.sources.fixtures import with_views

query = Registry()

RANGES = (
    "ranges",
    "SELECT round, channel, CASE WHEN count(*) < 7*any_value(side)*any_value(side) THEN least(min(value),0) ELSE min(value) END AS lo, "
    "max(value) AS hi FROM fx_voxels CROSS JOIN fx_dim GROUP BY round, channel",
)
SLOPE = "CAST(CAST(65535 AS DOUBLE)/nullif(CAST(hi-lo AS DOUBLE),0) AS REAL)"
STRETCH = f"(CAST(value AS REAL)-CAST(lo AS REAL))*{SLOPE}"
CLIP = "greatest(least({0},CAST(65535 AS REAL)),CAST(0 AS REAL))"
# channels A and N scaled half-even, as the merge does
SCALED = (
    "scaled",
    f"SELECT round, channel, z, y, x, CAST({CLIP.format(f'round_even({STRETCH},0)')} AS BIGINT) AS value "
    "FROM fx_voxels JOIN ranges USING (round, channel) WHERE channel IN ('A','N')",
)


def _pair(source: str) -> tuple[str, str]:
    return (
        "pair",
        "SELECT round, z, y, x, coalesce(a.value,0) AS va, coalesce(b.value,0) AS vb FROM "
        f"(SELECT * FROM {source} WHERE channel='A') a FULL OUTER JOIN (SELECT * FROM {source} WHERE channel='N') b USING (round, z, y, x)",
    )


MEAN = "CAST(round_even((CAST(va AS REAL)+CAST(vb AS REAL))*CAST(0.5 AS REAL),0) AS BIGINT)"


def shape(spark, sf):
    return fx.volume_shape(spark, sf)


@query(
    "pix_scale_uint16",
    with_views(
        "fx_voxels",
        f"SELECT round, channel, z, y, x, CASE WHEN hi>lo THEN CAST(floor({CLIP.format(STRETCH)}+CAST(0.5 AS REAL)) AS BIGINT) ELSE 0 END AS value "
        "FROM fx_voxels JOIN ranges USING (round, channel)",
        [RANGES],
    ),
)
def pix_scale_uint16(spark, sf):
    return px.scale_to_uint16(fx.voxels(spark, sf), shape(spark, sf))


_FIXED = "(CAST(value AS REAL)-CAST(1000 AS REAL))*CAST(CAST(65535 AS DOUBLE)/39000 AS REAL)"


@query(
    "pix_scale_range",
    with_views(
        "fx_voxels",
        f"SELECT round, channel, z, y, x, CAST(floor({CLIP.format(_FIXED)}+CAST(0.5 AS REAL)) AS BIGINT) AS value FROM fx_voxels",
    ),
)
def pix_scale_range(spark, sf):
    return px.scale_to_uint16(fx.voxels(spark, sf), shape(spark, sf), bounds=(1000.0, 40000.0))


@query(
    "pix_merge_mean",
    with_views("fx_voxels", f"SELECT round, 'merged' AS channel, z, y, x, {MEAN} AS value FROM pair", [RANGES, SCALED, _pair("scaled")]),
)
def pix_merge_mean(spark, sf):
    return px.merge_channels(fx.voxels(spark, sf), "A", "N", shape(spark, sf), "mean")


@query(
    "pix_merge_max",
    with_views("fx_voxels", "SELECT round, 'merged' AS channel, z, y, x, greatest(va, vb) AS value FROM pair", [RANGES, SCALED, _pair("scaled")]),
)
def pix_merge_max(spark, sf):
    return px.merge_channels(fx.voxels(spark, sf), "A", "N", shape(spark, sf), "max")


@query(
    "pix_merge_stack",
    with_views("fx_voxels", "SELECT round, CASE channel WHEN 'A' THEN '0' ELSE '1' END AS channel, z, y, x, value FROM scaled", [RANGES, SCALED]),
)
def pix_merge_stack(spark, sf):
    return px.merge_channels(fx.voxels(spark, sf), "A", "N", shape(spark, sf), "stack")


@query(
    "pix_merge_unscaled",
    with_views("fx_voxels", f"SELECT round, 'merged' AS channel, z, y, x, {MEAN} AS value FROM pair", [_pair("fx_voxels")]),
)
def pix_merge_unscaled(spark, sf):
    return px.merge_channels(fx.voxels(spark, sf), "A", "N", shape(spark, sf), "mean", scale=False)


@query(
    "pix_registration_channel",
    with_views(
        "fx_voxels",
        f"SELECT round, 'dual' AS channel, z, y, x, {MEAN} AS value FROM pair UNION ALL "
        "SELECT round, 'single' AS channel, z, y, x, value FROM fx_voxels WHERE channel='R'",
        [RANGES, SCALED, _pair("scaled")],
    ),
)
def pix_registration_channel(spark, sf):
    vox, ext = fx.voxels(spark, sf), shape(spark, sf)
    dual = px.registration_channel(vox, ["A", "N"], ext, output="dual")
    return dual.unionByName(px.registration_channel(vox, ["R"], ext, output="single"))


@query(
    "pix_stack_images",
    with_views(
        "fx_voxels",
        "SELECT round, z, CAST(CASE channel WHEN 'A' THEN 0 ELSE 1 END AS BIGINT) AS position, y, x, value FROM fx_voxels WHERE channel IN ('A','N')",
    ),
)
def pix_stack_images(spark, sf):
    ext = shape(spark, sf)
    return px.stack_images(fx.voxels(spark, sf), "A", "N", ext, ext)


@query(
    "pix_imaging_channels",
    with_views(
        "fx_voxels",
        "SELECT round, channel, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM fx_voxels WHERE channel IN ('A','R') GROUP BY 1, 2",
    ),
)
def pix_imaging_channels(spark, sf):
    vox = fx.voxels(spark, sf)
    derived = px.registration_channel(vox, ["A"], shape(spark, sf), output="O_registration")
    kept = px.select_channels(px.imaging_channels(vox.unionByName(derived)), ["A", "R", "O_registration"])
    return kept.groupBy("round", "channel").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("pix_flip", with_views("fx_voxels", "SELECT round, channel, 6-z AS z, y, side-1-x AS x, value FROM fx_voxels CROSS JOIN fx_dim"))
def pix_flip(spark, sf):
    return px.flip(fx.voxels(spark, sf), ["z", "x"], shape(spark, sf))


@query("pix_reorient_90", with_views("fx_voxels", "SELECT round, channel, 6-z AS z, x AS y, side-1-y AS x, value FROM fx_voxels CROSS JOIN fx_dim"))
def pix_reorient_90(spark, sf):
    return px.reorient(fx.voxels(spark, sf), shape(spark, sf), 90, flip_z=True)


@query("pix_reorient_180", with_views("fx_voxels", "SELECT round, channel, z, side-1-y AS y, side-1-x AS x, value FROM fx_voxels CROSS JOIN fx_dim"))
def pix_reorient_180(spark, sf):
    return px.reorient(fx.voxels(spark, sf), shape(spark, sf), 180)


@query("pix_reorient_270", with_views("fx_voxels", "SELECT round, channel, z, side-1-x AS y, y AS x, value FROM fx_voxels CROSS JOIN fx_dim"))
def pix_reorient_270(spark, sf):
    return px.reorient(fx.voxels(spark, sf), shape(spark, sf), 270)
