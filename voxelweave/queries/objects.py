"""Object table and projection queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.functions.sizing import new_path
from voxelweave.operators import objects as ob
from voxelweave.operators import projections as pr
from voxelweave.queries.registry import Registry
from voxelweave.sources import fixtures as fx
from voxelweave.sources.fixtures import with_views
from voxelweave.sources.mip_store import materialize_mips, store_info

PAD = 2
CHANNELS = ["A", "N", "R"]
SETTINGS = {
    "A": {"color": "#ff0000", "opacity": 0.8},
    "N": {"color": "#00ff80", "opacity": 0.5, "auto_contrast": False, "min_value": 100.0, "max_value": 40000.0},
    "R": {"color": "#0080ff", "contrast_range": [5.0, 95.0]},
}

query = Registry()


def labels(spark, sf):
    return fx.labels(spark, sf)


def nuclei(spark, sf):
    return ob.region_props(fx.labels(spark, sf), fx.MIN_OBJECT_SIZE)


def padded(spark, sf):
    return ob.padded_bbox(nuclei(spark, sf), PAD, fx.volume_shape(spark, sf))


def reference_voxels(spark, sf):
    return fx.voxels(spark, sf).filter(F.col("round") == fx.REFERENCE_ROUND)


def masked(spark, sf):
    return pr.masked_voxels(labels(spark, sf), reference_voxels(spark, sf), nuclei(spark, sf))


def dense_mips(spark, sf):
    return pr.nucleus_mip(masked(spark, sf), pr.crop_pixels(padded(spark, sf), CHANNELS))


PADDED = (
    "fx_padded",
    f"SELECT n.*, greatest(min_y-{PAD},0) AS pmin_y, least(max_y+{PAD},side) AS pmax_y, "
    f"greatest(min_x-{PAD},0) AS pmin_x, least(max_x+{PAD},side) AS pmax_x FROM fx_nuclei n CROSS JOIN fx_dim",
)
MASKED = (
    "masked",
    "SELECT l.label, v.channel, l.z, l.y, l.x, v.value FROM fx_labels l JOIN fx_voxels v ON l.z=v.z AND l.y=v.y "
    "AND l.x=v.x WHERE v.round='O' AND l.label IN (SELECT label FROM fx_nuclei)",
)
CROPS = (
    "crops",
    "SELECT p.label, c.channel, y.y, x.x FROM fx_padded p, (VALUES ('A'),('N'),('R')) c(channel), "
    "range((SELECT side FROM fx_dim)) y(y), range((SELECT side FROM fx_dim)) x(x) "
    "WHERE y.y >= p.pmin_y AND y.y < p.pmax_y AND x.x >= p.pmin_x AND x.x < p.pmax_x",
)
MIPS = (
    "mips",
    "SELECT c.label, c.channel, c.y, c.x, coalesce(m.value,0) AS value FROM crops c LEFT JOIN "
    "(SELECT label, channel, y, x, max(value) AS value FROM masked GROUP BY ALL) m USING (label, channel, y, x)",
)
# Grey levels for the three display settings above, in float32 like the operator.
GRAY = (
    "lit",
    "SELECT m.label, m.channel, m.y, m.x, CASE WHEN hi>lo THEN CAST(floor(greatest(least((CAST(value AS REAL)-CAST(lo AS REAL))"
    "/CAST(hi-lo AS REAL),CAST(1 AS REAL)),CAST(0 AS REAL))*CAST(255 AS REAL)) AS BIGINT) ELSE 0 END AS gray FROM mips m "
    "JOIN (SELECT label, channel, CASE channel WHEN 'A' THEN quantile_cont(value,0.01) WHEN 'N' THEN 100.0 ELSE quantile_cont(value,0.05) END::DOUBLE AS lo, "
    "CASE channel WHEN 'A' THEN quantile_cont(value,0.999) WHEN 'N' THEN 40000.0 ELSE quantile_cont(value,0.95) END::DOUBLE AS hi "
    "FROM mips GROUP BY label, channel) q USING (label, channel)",
)
ALL_MIPS = [PADDED, MASKED, CROPS, MIPS]


@query(
    "obj_region_props",
    with_views(
        "fx_labels",
        "SELECT label, count(*) AS area, min(z) AS min_z, min(y) AS min_y, min(x) AS min_x, max(z)+1 AS max_z, "
        "max(y)+1 AS max_y, max(x)+1 AS max_x, round(avg(z),6) AS cz, round(avg(y),6) AS cy, round(avg(x),6) AS cx "
        "FROM fx_labels WHERE label>0 GROUP BY label",
    ),
)
def obj_region_props(spark, sf):
    props = ob.region_props(labels(spark, sf))
    return props.withColumns({c: F.round(c, 6) for c in ("cz", "cy", "cx")})


@query("obj_min_size", with_views("fx_nuclei", "SELECT label, area FROM fx_nuclei"))
def obj_min_size(spark, sf):
    return nuclei(spark, sf).select("label", "area")


@query("obj_count", with_views("fx_nuclei", "SELECT count(*) AS num_objects FROM fx_nuclei"))
def obj_count(spark, sf):
    return ob.object_count(nuclei(spark, sf))


@query(
    "obj_padded_bbox",
    with_views(
        "fx_nuclei",
        "SELECT label, min_z AS pmin_z, max_z AS pmax_z, pmin_y, pmax_y, pmin_x, pmax_x FROM fx_padded",
        [PADDED],
    ),
)
def obj_padded_bbox(spark, sf):
    return padded(spark, sf).select("label", "pmin_z", "pmax_z", "pmin_y", "pmax_y", "pmin_x", "pmax_x")


@query(
    "obj_by_label",
    with_views(
        "fx_nuclei",
        "SELECT label, area, min_z, max_z FROM fx_nuclei WHERE label = (SELECT max(s_suppkey) FROM supplier)",
    ),
)
def obj_by_label(spark, sf):
    top = fx.table(spark, sf, "supplier").agg(F.max("s_suppkey")).first()[0]
    return ob.nucleus_by_label(nuclei(spark, sf), top).select("label", "area", "min_z", "max_z")


@query(
    "obj_page",
    with_views(
        "fx_nuclei",
        "SELECT label, area, total_nuclei, CAST(ceil(total_nuclei/7.0) AS BIGINT) AS total_pages, CAST(1 AS BIGINT) AS page, "
        "ceil(total_nuclei/7.0) > 2 AS has_next, TRUE AS has_previous FROM (SELECT *, row_number() OVER (ORDER BY label) - 1 AS rn, "
        "count(*) OVER () AS total_nuclei FROM fx_nuclei) WHERE rn >= 7 AND rn < 14",
    ),
)
def obj_page(spark, sf):
    page = ob.nuclei_page(nuclei(spark, sf), page=1, page_size=7)
    return page.select("label", "area", "total_nuclei", "total_pages", "page", "has_next", "has_previous")


@query("obj_total_pages", with_views("fx_nuclei", "SELECT CAST(ceil(count(*)/10.0) AS BIGINT) AS total_pages FROM fx_nuclei"))
def obj_total_pages(spark, sf):
    return ob.total_pages(nuclei(spark, sf))


@query(
    "obj_stats",
    with_views(
        "fx_nuclei",
        "SELECT count(*) AS total_nuclei, min(area) AS area_min, max(area) AS area_max, round(avg(area),6) AS area_mean, "
        "list_sort(list(area))[count(*)//2+1] AS area_median, round(min(cz),6) AS cz_min, round(max(cz),6) AS cz_max, "
        "round(min(cy),6) AS cy_min, round(max(cy),6) AS cy_max, round(min(cx),6) AS cx_min, round(max(cx),6) AS cx_max FROM fx_nuclei",
    ),
)
def obj_stats(spark, sf):
    stats = ob.nuclei_stats(nuclei(spark, sf))
    return stats.withColumns({c: F.round(c, 6) for c in stats.columns if c[0] == "c" or c == "area_mean"})


@query("mip_sparse", with_views("fx_nuclei fx_voxels", "SELECT label, channel, y, x, max(value) AS value FROM masked GROUP BY ALL", [MASKED]))
def mip_sparse(spark, sf):
    return pr.nucleus_mip(masked(spark, sf))


@query("mip_dense", with_views("fx_nuclei fx_voxels", "SELECT label, channel, y, x, value FROM mips", ALL_MIPS))
def mip_dense(spark, sf):
    return dense_mips(spark, sf)


@query(
    "mip_channel_stats",
    with_views(
        "fx_nuclei fx_voxels",
        "SELECT n.label, c.channel, coalesce(min(value),0)::DOUBLE AS min, coalesce(max(value),0)::DOUBLE AS max, "
        "round(coalesce(avg(value),0),4) AS mean, round(coalesce(stddev_pop(value),0),4) AS std, count(value) AS nonzero_voxels "
        "FROM fx_nuclei n CROSS JOIN (VALUES ('A'),('N'),('R')) c(channel) LEFT JOIN (SELECT * FROM masked WHERE value>0) m "
        "ON m.label=n.label AND m.channel=c.channel GROUP BY n.label, c.channel",
        [MASKED],
    ),
)
def mip_channel_stats(spark, sf):
    stats = pr.channel_stats(masked(spark, sf), nuclei(spark, sf), CHANNELS)
    return stats.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(
    "mip_channel_selection",
    with_views(
        "fx_nuclei fx_voxels",
        "SELECT label, channel, y, x, max(value) AS value FROM masked WHERE channel IN ('N','R') GROUP BY ALL",
        [MASKED],
    ),
)
def mip_channel_selection(spark, sf):
    vox = reference_voxels(spark, sf)
    usable, _ = pr.resolve_channels(vox, ["N", "R", "absent"])
    return pr.nucleus_mip(
        pr.masked_voxels(labels(spark, sf), vox.filter(F.col("channel").isin(usable)), nuclei(spark, sf))
    )


@query(
    "mip_batch",
    with_views(
        "fx_nuclei",
        "SELECT count(*) FILTER (WHERE label IN (SELECT label FROM fx_nuclei)) AS processed_nuclei, "
        "count(*) FILTER (WHERE label NOT IN (SELECT label FROM fx_nuclei)) AS failed_nuclei FROM (SELECT s_suppkey+5 AS label FROM supplier)",
    ),
)
def mip_batch(spark, sf):
    requested = fx.table(spark, sf, "supplier").select((F.col("s_suppkey") + 5).alias("label"))
    return pr.batch_outcome(requested, nuclei(spark, sf))


@query(
    "mip_metadata",
    with_views(
        "fx_nuclei",
        "SELECT label, area, round(cz,6) AS cz, round(cy,6) AS cy, round(cx,6) AS cx, max_z-min_z AS crop_z, pmax_y-pmin_y AS crop_y, "
        f"pmax_x-pmin_x AS crop_x, pmax_y-pmin_y AS mip_h, pmax_x-pmin_x AS mip_w, CAST({PAD} AS BIGINT) AS pad_xy FROM fx_padded",
        [PADDED],
    ),
)
def mip_metadata(spark, sf):
    meta = pr.mip_metadata(padded(spark, sf), PAD)
    return meta.withColumns({c: F.round(c, 6) for c in ("cz", "cy", "cx")})


@query(
    "mip_missing",
    with_views(
        "fx_nuclei",
        "SELECT n.label, c.channel FROM fx_nuclei n CROSS JOIN (VALUES ('A'),('N'),('R')) c(channel) "
        "WHERE NOT (c.channel = 'A' OR (c.channel = 'N' AND n.area > 20))",
    ),
)
def mip_missing(spark, sf):
    objs = nuclei(spark, sf)
    existing = objs.select("label", F.lit("A").alias("channel")).unionByName(
        objs.filter("area > 20").select("label", F.lit("N").alias("channel"))
    )
    return pr.missing_mips(objs, CHANNELS, existing)


@query("mip_store", with_views("fx_nuclei fx_voxels", "SELECT label, channel, y, x, value FROM mips", ALL_MIPS))
def mip_store(spark, sf):
    """Two increments (one channel, then all) and a forced rewrite give the full table."""
    path = new_path(spark, "mips")
    args = (path, labels(spark, sf), reference_voxels(spark, sf), padded(spark, sf))
    materialize_mips(*args, ["A"])
    materialize_mips(*args, CHANNELS)
    return materialize_mips(*args, ["N"], force=True)


@query(
    "mip_store_info",
    with_views("fx_nuclei", "SELECT c.channel, count(*) AS stored_objects FROM fx_nuclei, (VALUES ('A'),('N'),('R')) c(channel) GROUP BY 1"),
)
def mip_store_info(spark, sf):
    return store_info(dense_mips(spark, sf))


@query(
    "mip_contrast",
    with_views(
        "fx_nuclei fx_voxels",
        "SELECT m.label, m.channel, y, x, value, CASE WHEN hi>lo THEN CAST(floor(greatest(least((CAST(value AS REAL)-CAST(lo AS REAL))/CAST(hi-lo AS REAL),"
        "CAST(1 AS REAL)),CAST(0 AS REAL))*CAST(255 AS REAL)) AS BIGINT) ELSE 0 END AS gray FROM mips m JOIN (SELECT label, channel, "
        "quantile_cont(value,0.01) AS lo, quantile_cont(value,0.999) AS hi FROM mips GROUP BY ALL) q USING (label, channel)",
        ALL_MIPS,
    ),
)
def mip_contrast(spark, sf):
    return pr.contrast(dense_mips(spark, sf), ["label", "channel"])


@query(
    "mip_manual_scale",
    with_views(
        "fx_nuclei fx_voxels",
        "SELECT m.label, m.channel, y, x, value, CASE WHEN hi>500 THEN CAST(floor(greatest(least((CAST(value AS REAL)-CAST(500 AS REAL))/CAST(hi-500 AS REAL),"
        "CAST(1 AS REAL)),CAST(0 AS REAL))*CAST(255 AS REAL)) AS BIGINT) ELSE 0 END AS gray FROM mips m JOIN (SELECT label, channel, "
        "max(value)::DOUBLE AS hi FROM mips GROUP BY ALL) q USING (label, channel)",
        ALL_MIPS,
    ),
)
def mip_manual_scale(spark, sf):
    return pr.manual_scale(dense_mips(spark, sf), ["label", "channel"], lo=500.0)


def _sum(channel: str, *colors: float) -> str:
    # red/green/blue contribution of channels A, N, R with their opacities
    terms = [
        f"(CASE channel WHEN '{c}' THEN CAST(gray AS DOUBLE)/255e0*{o}e0*({v}e0/255e0) ELSE 0 END)"
        for c, o, v in zip("ANR", (0.8, 0.5, 0.8), colors)
    ]
    return f"CAST(floor(round(least(round(sum({' + '.join(terms)}),9),1)*255,6)) AS BIGINT) AS {channel}"


@query(
    "mip_composite",
    with_views(
        "fx_nuclei fx_voxels",
        f"SELECT label, y, x, {_sum('red', 255, 0, 0)}, {_sum('green', 0, 255, 128)}, {_sum('blue', 0, 128, 255)} FROM lit GROUP BY label, y, x",
        [*ALL_MIPS, GRAY],
    ),
)
def mip_composite(spark, sf):
    return pr.composite(dense_mips(spark, sf), pr.settings_table(spark, SETTINGS))


def _layer(channel: str, a: float, n: float, r: float) -> str:
    return f"round(({a}e0*ga*0.8e0*0.5e0*0.2e0 + {n}e0*gn*0.5e0*0.2e0 + {r}e0*gr*0.8e0)/255e0,4) AS {channel}"


@query(
    "mip_tint_layers",
    with_views(
        "fx_nuclei fx_voxels",
        f"SELECT label, y, x, {_layer('red', 255, 0, 0)}, {_layer('green', 0, 255, 128)}, {_layer('blue', 0, 128, 255)} FROM "
        "(SELECT label, y, x, sum(CASE channel WHEN 'A' THEN gray ELSE 0 END)::DOUBLE AS ga, sum(CASE channel WHEN 'N' THEN gray ELSE 0 END)::DOUBLE AS gn, "
        "sum(CASE channel WHEN 'R' THEN gray ELSE 0 END)::DOUBLE AS gr FROM lit GROUP BY label, y, x)",
        [*ALL_MIPS, GRAY],
    ),
)
def mip_tint_layers(spark, sf):
    out = pr.tint_layers(dense_mips(spark, sf), pr.settings_table(spark, SETTINGS))
    return out.withColumns({c: F.round(c, 4) for c in ("red", "green", "blue")})


@query(
    "mip_summary",
    with_views(
        "fx_nuclei fx_voxels",
        "SELECT n.label, n.area, i.available_channels, i.mip_h, i.mip_w, i.label IS NOT NULL AS has_cached_mip FROM fx_nuclei n LEFT JOIN "
        "(SELECT label, array_to_string(list_sort(list(DISTINCT channel)),',') AS available_channels, max(y)-min(y)+1 AS mip_h, "
        "max(x)-min(x)+1 AS mip_w FROM masked WHERE value > 20000 GROUP BY label) i ON n.label=i.label",
        [MASKED],
    ),
)
def mip_summary(spark, sf):
    stored = pr.nucleus_mip(masked(spark, sf).filter("value > 20000"))
    return pr.nucleus_summary(nuclei(spark, sf), stored).select(
        "label", "area", "available_channels", "mip_h", "mip_w", "has_cached_mip"
    )
