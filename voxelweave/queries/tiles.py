"""Tile queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.operators import tiles as tl
from voxelweave.queries.registry import Registry
from voxelweave.sources import fixtures as fx
from voxelweave.sources.fixtures import with_views

query = Registry()

CHANNELS = ["A", "N", "R"]

STATS = (
    "stats",
    "SELECT tile, p1, p_hi, avg(c) AS mean, stddev_pop(c) AS std, CASE WHEN stddev_pop(c)>0 THEN (avg(c)-p1)/(stddev_pop(c)+1e-6) ELSE 0 END AS snr "
    "FROM (SELECT d.tile, p1, p_hi, greatest(least(value::DOUBLE,p_hi),p1) AS c FROM fx_tile_dense d JOIN (SELECT tile, quantile_cont(value,0.01) AS p1, "
    "quantile_cont(value,0.999) AS p_hi FROM fx_tile_dense GROUP BY tile) q USING (tile)) GROUP BY tile, p1, p_hi",
)
QUALITY = (
    "quality",
    "SELECT s.*, ref, p_hi/(ref+1e-6) < {t} AS low_signal, snr < 2 AS noisy, greatest(0.1,least(1,p_hi/(ref+1e-6)))*greatest(0.1,least(1,snr/5)) AS weight "
    "FROM stats s CROSS JOIN (SELECT quantile_cont(p_hi,0.5) AS ref FROM stats)",
)
_BASE = "(CAST(value AS REAL)-CAST(p1 AS REAL))"
_CLIP = "CAST(floor(greatest(least({0},CAST(65535 AS REAL)),CAST(0 AS REAL))) AS BIGINT)"
NORMAL = (
    "CASE WHEN p_hi<=p1 THEN value WHEN low_signal AND noisy THEN value WHEN low_signal THEN "
    + _CLIP.format(f"{_BASE}/CAST(greatest(1,p_hi-p1) AS REAL)*CAST(least(65535,(p_hi-p1)*0.3) AS REAL)")
    + " ELSE " + _CLIP.format(f"{_BASE}/CAST(p_hi-p1 AS REAL)*CAST(65535 AS REAL)") + " END"
)


def quality_cte(threshold: float = 0.1):
    return (QUALITY[0], QUALITY[1].format(t=threshold))


def _placed(value: str) -> tuple[str, str]:
    return (
        "placed",
        f"SELECT tile, z+oz AS z, y+oy AS y, x+ox AS x, {value} AS value, weight*least(1,least(z,6-z)/16e0)*least(1,least(y,15-y)/16e0)*least(1,least(x,15-x)/16e0) AS w "
        "FROM fx_tile_dense JOIN quality USING (tile) JOIN fx_tiles USING (tile)",
    )


def tiles(spark, sf):
    return fx.tiles(spark, sf)


def voxels(spark, sf):
    return fx.tile_voxels(spark, sf)


@query(
    "tile_offsets",
    "WITH m AS (SELECT n_nationkey::BIGINT AS tile, (n_nationkey%5)*100e0+7 AS x, floor(n_nationkey/5)*90e0+3 AS y FROM nation) "
    "SELECT tile, round(x-(SELECT min(x) FROM m)+(dense_rank() OVER (ORDER BY x)-1)*0.95e0*2048,6) AS ox, "
    "round(y-(SELECT min(y) FROM m)+(dense_rank() OVER (ORDER BY y)-1)*0.95e0*2048,6) AS oy, 0e0 AS oz FROM m",
)
def tile_offsets(spark, sf):
    manifest = fx.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("tile"),
        ((F.col("n_nationkey") % 5) * 100.0 + 7).alias("x"),
        (F.floor(F.col("n_nationkey") / 5) * 90.0 + 3).alias("y"),
        F.lit(0.0).alias("z"),
    )
    return tl.tile_offsets(manifest).withColumns({c: F.round(c, 6) for c in ("ox", "oy")})


@query(
    "tile_overlap_pairs",
    with_views(
        "fx_tiles",
        "SELECT a.tile AS tile_a, b.tile AS tile_b, greatest(a.oy,b.oy) AS lo_y, greatest(a.ox,b.ox) AS lo_x, "
        "least(a.oy,b.oy)+16-greatest(a.oy,b.oy) AS n_y, least(a.ox,b.ox)+16-greatest(a.ox,b.ox) AS n_x FROM fx_tiles a JOIN fx_tiles b "
        "ON a.tile<b.tile AND least(a.oy,b.oy)+16-greatest(a.oy,b.oy)>=4 AND least(a.ox,b.ox)+16-greatest(a.ox,b.ox)>=4",
    ),
)
def tile_overlap_pairs(spark, sf):
    return tl.overlap_pairs(tiles(spark, sf), 4).select("tile_a", "tile_b", "lo_y", "lo_x", "n_y", "n_x")


@query(
    "tile_overlap_pairs_many",
    "WITH t AS (SELECT s_suppkey AS tile, CAST(floor(s_acctbal) AS BIGINT)%997 AS ox, (s_suppkey*37)%991 AS oy FROM supplier) "
    "SELECT a.tile AS tile_a, b.tile AS tile_b, least(a.oy,b.oy)+60-greatest(a.oy,b.oy) AS n_y, least(a.ox,b.ox)+80-greatest(a.ox,b.ox) AS n_x "
    "FROM t a JOIN t b ON a.tile<b.tile AND least(a.oy,b.oy)+60-greatest(a.oy,b.oy)>=5 AND least(a.ox,b.ox)+80-greatest(a.ox,b.ox)>=5",
)
def tile_overlap_pairs_many(spark, sf):
    scattered = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("tile"),
        (F.floor("s_acctbal").cast("bigint") % 997).alias("ox"),
        ((F.col("s_suppkey") * 37) % 991).alias("oy"),
        F.lit(0).cast("bigint").alias("oz"),
        *[F.lit(n).cast("bigint").alias(f"d{a}") for a, n in (("z", 10), ("y", 60), ("x", 80))],
    )
    return tl.overlap_pairs(scattered, 5).select("tile_a", "tile_b", "n_y", "n_x")


@query(
    "tile_filter_links",
    "SELECT vec AS tile_a, vec+1 AS tile_b, r, sx FROM (SELECT s_suppkey AS vec, round((s_suppkey%97)/97e0,6) AS r, (s_suppkey%11)::DOUBLE AS sx FROM supplier) "
    "WHERE r BETWEEN 0.2 AND 0.9 AND sx <= 8 AND sqrt(sx*sx+9) <= 7.5",
)
def tile_filter_links(spark, sf):
    links = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("tile_a"),
        (F.col("s_suppkey") + 1).alias("tile_b"),
        F.round((F.col("s_suppkey") % 97) / F.lit(97.0), 6).alias("r"),
        F.lit(0.0).alias("sz"),
        F.lit(3.0).alias("sy"),
        (F.col("s_suppkey") % 11).cast("double").alias("sx"),
    )
    return tl.filter_links(links, 0.2, 0.9, (0, 0, 8), 7.5).select("tile_a", "tile_b", "r", "sx")


@query(
    "tile_link_residuals",
    with_views(
        "fx_tiles",
        "SELECT a.tile AS tile_a, b.tile AS tile_b, round(sqrt(power(b.oy-a.oy-11,2)+power(b.ox-a.ox-2,2)),6) AS residual FROM fx_tiles a JOIN fx_tiles b ON b.tile=a.tile+5",
    ),
)
def tile_link_residuals(spark, sf):
    t = tiles(spark, sf)
    positions = t.select("tile", *[F.col(f"o{a}").cast("double").alias(f"p{a}") for a in "zyx"])
    links = t.select(
        F.col("tile").alias("tile_a"), (F.col("tile") + 5).alias("tile_b"),
        F.lit(0.0).alias("mz"), F.lit(11.0).alias("my"), F.lit(2.0).alias("mx"),
    )
    out = tl.link_residuals(positions, links)
    return out.select("tile_a", "tile_b", F.round("residual", 6).alias("residual"))


@query(
    "tile_stats",
    with_views(
        "fx_tile_dense",
        "SELECT tile, round(p1,4) AS p1, round(p_hi,4) AS p_hi, round(mean,4) AS mean, round(std,4) AS std, round(snr,4) AS snr FROM stats",
        [STATS],
    ),
)
def tile_stats(spark, sf):
    out = tl.tile_stats(voxels(spark, sf), tiles(spark, sf))
    return out.select("tile", *[F.round(c, 4).alias(c) for c in ("p1", "p_hi", "mean", "std", "snr")])


@query("tile_global_ref", with_views("fx_tile_dense", "SELECT round(quantile_cont(p_hi,0.5),4) AS ref FROM stats", [STATS]))
def tile_global_ref(spark, sf):
    ref = tl.global_reference(tl.tile_stats(voxels(spark, sf), tiles(spark, sf)))
    return ref.select(F.round("ref", 4).alias("ref"))


@query(
    "tile_normalize",
    with_views(
        "fx_tile_dense",
        f"SELECT tile, z, y, x, {NORMAL} AS value FROM fx_tile_voxels JOIN quality USING (tile)",
        [STATS, quality_cte()],
    ),
)
def tile_normalize(spark, sf):
    quality = tl.tile_quality(tl.tile_stats(voxels(spark, sf), tiles(spark, sf)))
    return tl.normalize_tiles(voxels(spark, sf), quality)


@query(
    "tile_normalize_low_signal",
    with_views(
        "fx_tile_dense",
        f"SELECT tile, z, y, x, {NORMAL} AS value FROM fx_tile_voxels JOIN quality USING (tile)",
        [STATS, quality_cte(1.0)],
    ),
)
def tile_normalize_low_signal(spark, sf):
    quality = tl.tile_quality(tl.tile_stats(voxels(spark, sf), tiles(spark, sf)), noise_threshold=1.0)
    return tl.normalize_tiles(voxels(spark, sf), quality)


@query(
    "tile_mosaic_extent",
    with_views(
        "fx_tiles",
        "SELECT min(oz)::DOUBLE AS min_z, 7::BIGINT AS nz, min(oy)::DOUBLE AS min_y, max(oy)+16-min(oy) AS ny, min(ox)::DOUBLE AS min_x, max(ox)+16-min(ox) AS nx FROM fx_tiles",
    ),
)
def tile_mosaic_extent(spark, sf):
    return tl.mosaic_extent(tiles(spark, sf))


@query(
    "tile_blend_max",
    with_views("fx_tile_dense", "SELECT z, y, x, max(value) AS value FROM (SELECT z+oz AS z, y+oy AS y, x+ox AS x, value FROM fx_tile_voxels JOIN fx_tiles USING (tile)) GROUP BY ALL"),
)
def tile_blend_max(spark, sf):
    return tl.blend(voxels(spark, sf), tiles(spark, sf), "max", normalize=False)


@query(
    "tile_blend_overwrite",
    with_views("fx_tile_dense", "SELECT z, y, x, arg_max(value, tile) AS value FROM placed GROUP BY ALL", [STATS, quality_cte(), _placed("value")]),
)
def tile_blend_overwrite(spark, sf):
    return tl.blend(voxels(spark, sf), tiles(spark, sf), "overwrite", normalize=False)


@query(
    "tile_blend_weighted",
    with_views(
        "fx_tile_dense",
        "SELECT z, y, x, CAST(round_even(round(greatest(least(coalesce(sum(w*value)/nullif(sum(w),0),0),65535),0),6),0) AS BIGINT) AS value FROM placed GROUP BY ALL",
        [STATS, quality_cte(), _placed(NORMAL)],
    ),
)
def tile_blend_weighted(spark, sf):
    return tl.blend(voxels(spark, sf), tiles(spark, sf), "weighted_average")


@query(
    "tile_blend_channels",
    with_views(
        "fx_tiles",
        "SELECT channel, z, y+oy AS y, x+ox AS x, max(value) AS value FROM (SELECT l_returnflag AS channel, l_suppkey AS tile, CAST(l_linenumber-1 AS BIGINT) AS z, "
        "l_orderkey % 16 AS y, l_partkey % 16 AS x, CAST(floor(l_extendedprice) AS BIGINT) % 65536 AS value FROM lineitem) JOIN fx_tiles USING (tile) GROUP BY ALL",
    ),
)
def tile_blend_channels(spark, sf):
    physical = tiles(spark, sf).withColumns({"ox": F.col("ox") * 0.5, "oy": F.col("oy") * 0.5})
    return tl.blend_by_channel(
        fx.tile_voxels(spark, sf, channel=True), tl.per_channel(physical, CHANNELS), (0.5, 0.5, 1.0),
        method="max", normalize=False,
    )
