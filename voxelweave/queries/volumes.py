"""Storage, block-form, segmentation and sink queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.functions.sizing import new_path
from voxelweave.model import Shape
from voxelweave.operators import blocks as bl
from voxelweave.operators import components as cc
from voxelweave.operators import objects as ob
from voxelweave.queries.objects import SETTINGS, dense_mips
from voxelweave.operators import projections as pr
from voxelweave.queries.registry import Registry
from voxelweave.sources import fixtures as fx
from voxelweave.sources import render, reports, synth, tile_manifest, volumes
from voxelweave.sources.fixtures import with_views

query = Registry()

BLOCK = Shape(4, 16, 16)
OTHER = Shape(3, 8, 20)


def shape(spark, sf):
    return fx.volume_shape(spark, sf)


def one_volume(spark, sf):
    vox = fx.voxels(spark, sf)
    return vox.filter((F.col("round") == fx.REFERENCE_ROUND) & (F.col("channel") == "A"))


def as_blocks(spark, sf, block=BLOCK):
    return bl.to_blocks(fx.voxels(spark, sf), shape(spark, sf), block)


DENSE = (
    "dense",
    "SELECT g.z, g.y, g.x, coalesce(v.value,0)::DOUBLE AS v FROM fx_grid g LEFT JOIN (SELECT * FROM fx_voxels WHERE round='O' AND channel='A') v USING (z, y, x)",
)


def mirrored(index: str, n: str) -> str:
    m = f"((({index}) % (2*{n})) + 2*{n}) % (2*{n})"
    return f"CASE WHEN {m} < {n} THEN {m} ELSE 2*{n}-1-({m}) END"


def gaussian_ctes(sigma: float, source: str = "dense", tag: str = "g") -> list[tuple[str, str]]:
    radius = int(4.0 * sigma + 0.5)
    out = [
        (
            f"{tag}_taps",
            f"SELECT k, exp(-0.5*power(k/{sigma}e0,2))/sum(exp(-0.5*power(k/{sigma}e0,2))) OVER () AS w FROM range({-radius},{radius + 1}) t(k)",
        )
    ]
    previous = source
    for axis, n in (("z", "7"), ("y", "side"), ("x", "side")):
        on = " AND ".join(
            f"d.{a} = " + (mirrored(f"g.{a}+t.k", n) if a == axis else f"g.{a}") for a in ("z", "y", "x")
        )
        out.append(
            (
                f"{tag}_{axis}",
                f"SELECT g.z, g.y, g.x, sum(t.w*d.v) AS v FROM fx_grid g CROSS JOIN fx_dim CROSS JOIN {tag}_taps t JOIN {previous} d ON {on} GROUP BY ALL",
            )
        )
        previous = f"{tag}_{axis}"
    return out


def component_ctes(mask: str) -> list[tuple[str, str]]:
    """26-connected components of ``mask(z, y, x)`` by minimum-label propagation."""
    return [
        ("px", f"SELECT (z*side+y)*side+x AS id, z, y, x FROM {mask} CROSS JOIN fx_dim"),
        (
            "nb",
            "SELECT a.id AS a, b.id AS b FROM (SELECT px.*, z+dz.k AS tz, y+dy.k AS ty, x+dx.k AS tx FROM px, range(-1,2) dz(k), range(-1,2) dy(k), range(-1,2) dx(k)) a "
            "JOIN px b ON b.z=a.tz AND b.y=a.ty AND b.x=a.tx",
        ),
        (
            "cc(node, comp) USING KEY (node)",
            "SELECT id, id FROM px UNION SELECT nb.a, min(cc.comp) FROM cc JOIN nb ON nb.b=cc.node JOIN recurring.cc r ON r.node=nb.a WHERE cc.comp<r.comp GROUP BY nb.a",
        ),
    ]


LABELLED = "SELECT dense_rank() OVER (ORDER BY comp) AS label, z, y, x FROM cc JOIN px ON px.id=cc.node"


def with_using_key(views: str, body: str, extra) -> str:
    return with_views(views, body, extra, recursive=True)


# ---------------------------------------------------------------- storage and layout


@query(
    "vol_ingest_all_rounds",
    with_views("fx_voxels", "SELECT round, channel, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM fx_voxels WHERE value>0 GROUP BY 1, 2"),
)
def vol_ingest_all_rounds(spark, sf):
    """Raw slabs of all rounds are written, ingested by byte ranges, stored partitioned and read back."""
    path = new_path(spark, "rounds")
    volumes.write_volume(ingested(spark, sf), path)
    vox = bl.to_voxels(volumes.read_volume(spark, path))
    return vox.groupBy("round", "channel").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def ingested(spark, sf):
    """Blocks ingested from raw slabs of three slices, which do not line up with the blocks."""
    ext, folder = shape(spark, sf), new_path(spark, "slabs")
    listed = volumes.write_raw_slabs(as_blocks(spark, sf, OTHER), ext, folder, 3, strip_rows=10)
    rounds: dict[str, dict[str, str]] = {}
    for r, c in listed.select("round", "channel").distinct().collect():
        rounds.setdefault(r, {})[c] = f"{folder}/{r}/{c}"
    return volumes.ingest_all_rounds(spark, rounds, ext, BLOCK)


@query(
    "vol_ingest_range",
    with_views("fx_voxels", "SELECT round, channel, z, y, x, value FROM fx_voxels WHERE value>0 AND round='F' AND channel IN ('A','R') AND z>=4"),
)
def vol_ingest_range(spark, sf):
    """Filters on volume and place choose the byte ranges that are read."""
    chosen = ingested(spark, sf).filter("round = 'F' AND channel IN ('A', 'R') AND z0 >= 4")
    return bl.to_voxels(chosen)


@query(
    "vol_read_pruned",
    with_views("fx_voxels", "SELECT z, y, x, value FROM fx_voxels WHERE round='F' AND channel='R'"),
)
def vol_read_pruned(spark, sf):
    path = new_path(spark, "keyed")
    volumes.write_volume(fx.voxels(spark, sf), path, key="raw")
    return volumes.read_volume(spark, path, "F", "R", key="raw").select("z", "y", "x", "value")


@query(
    "vol_export_slices",
    with_views(
        "fx_voxels fx_grid",
        "SELECT v.round, v.channel, g.z, CAST(floor(g.y/10)*10 AS BIGINT) AS y0, CAST(sum(coalesce(x.value,0)) AS BIGINT) AS total, count(*)*2 AS bytes "
        "FROM (SELECT DISTINCT round, channel FROM fx_voxels) v CROSS JOIN fx_grid g LEFT JOIN fx_voxels x ON x.round=v.round AND x.channel=v.channel AND x.z=g.z AND x.y=g.y AND x.x=g.x "
        "GROUP BY v.round, v.channel, g.z, floor(g.y/10)",
    ),
)
def vol_export_slices(spark, sf):
    ext = shape(spark, sf)
    strips = volumes.export_slices(as_blocks(spark, sf), ext, strip_rows=10)
    # Decode strips as one-slice blocks to total their pixels.
    as_block = strips.select(
        "round", "channel", F.col("z").cast("int").alias("bz"), F.lit(0).alias("by"), F.lit(0).alias("bx"),
        F.col("z").alias("z0"), "y0", F.lit(0).cast("bigint").alias("x0"), F.lit(1).alias("nz"), F.col("h").alias("ny"),
        F.col("w").alias("nx"), F.lit("uint16").alias("dtype"), "data",
    )
    totals = (
        bl.to_voxels(as_block)
        .withColumn("y0", F.floor(F.col("y") / 10) * 10)
        .groupBy("round", "channel", "z", "y0")
        .agg(F.sum("value").alias("total"))
    )
    sizes = strips.select("round", "channel", "z", "y0", F.length("data").cast("bigint").alias("bytes"))
    joined = sizes.join(totals, ["round", "channel", "z", "y0"], "left")
    return joined.withColumn("total", F.coalesce("total", F.lit(0).cast("bigint")))


@query(
    "vol_tile_manifest",
    "SELECT n_nationkey::BIGINT AS tile, CASE WHEN n_nationkey%4=3 THEN 0 ELSE n_nationkey+0.25 END::DOUBLE AS x, (n_nationkey*2)::DOUBLE AS y, 0e0 AS z FROM nation",
)
def vol_tile_manifest(spark, sf):
    nation = fx.table(spark, sf, "nation")
    chars = nation.select(
        F.col("n_nationkey").cast("bigint").alias("tile"),
        F.when(F.col("n_nationkey") % 4 != 3, F.split((F.col("n_nationkey") + 0.25).cast("string"), "")).alias("x_chars"),
        F.split((F.col("n_nationkey") * 2).cast("string"), "").alias("y_chars"),
    )
    return tile_manifest.tile_manifest(chars)


@query(
    "vol_tile_views",
    with_views(
        "fx_tiles",
        "SELECT tile, channel, ox::DOUBLE AS tx, oy::DOUBLE AS ty, oz::DOUBLE AS tz, 1e0 AS m00, 0e0 AS m01, 'tile ' || tile || ' translation' AS name FROM fx_tiles, range(2) c(channel)",
    ),
)
def vol_tile_views(spark, sf):
    views = tile_manifest.tile_views(fx.tiles(spark, sf), 2)
    m = F.col("affine")
    return views.select(
        "tile", F.col("channel").cast("bigint").alias("channel"), m[0][3].alias("tx"), m[1][3].alias("ty"), m[2][3].alias("tz"),
        m[0][0].alias("m00"), m[0][1].alias("m01"), "name",
    )


@query(
    "vol_catalog",
    with_views("fx_voxels", "SELECT DISTINCT round, channel, 7::BIGINT AS size_z, side AS size_y, side AS size_x, 'uint16' AS dtype FROM fx_voxels CROSS JOIN fx_dim"),
)
def vol_catalog(spark, sf):
    return volumes.catalog(as_blocks(spark, sf, BLOCK)).drop("blocks")


@query(
    "vol_configured_channels",
    with_views(
        "fx_voxels",
        "SELECT c.channel, CASE c.channel WHEN 'A' THEN 'dapi' ELSE 'epitope' END AS type, CASE c.channel WHEN 'A' THEN '#0080ff' WHEN 'N' THEN '#00ff00' ELSE '#ffffff' END AS color, "
        "s.channel IS NOT NULL AS exists, s.size_x FROM (VALUES ('A'),('N'),('R'),('Q')) c(channel) LEFT JOIN (SELECT channel, max(x)+1 AS size_x FROM fx_voxels WHERE round='O' GROUP BY 1) s USING (channel)",
    ),
)
def vol_configured_channels(spark, sf):
    configured = spark.createDataFrame([("A", None), ("N", "#00ff00"), ("R", None), ("Q", None)], "channel string, color string")
    stored = volumes.voxel_catalog(fx.voxels(spark, sf).filter("round = 'O'"))
    return volumes.configured_channels(configured, stored, stain="A").select("channel", "type", "color", "exists", "size_x")


@query(
    "vol_common_shape",
    with_views("fx_voxels", "SELECT min(z) AS size_z, min(y) AS size_y, min(x) AS size_x FROM (SELECT max(z)+1 AS z, max(y)+1 AS y, max(x)+1 AS x FROM fx_voxels GROUP BY round, channel)"),
)
def vol_common_shape(spark, sf):
    return volumes.common_shape(volumes.voxel_catalog(fx.voxels(spark, sf)))


@query(
    "vol_crop_common",
    with_views("fx_voxels", "SELECT round, channel, z, y, x, value FROM fx_voxels CROSS JOIN fx_dim WHERE z<5 AND y<side-3 AND x<side"),
)
def vol_crop_common(spark, sf):
    ext = shape(spark, sf)
    return volumes.crop(fx.voxels(spark, sf), ext.common(Shape(5, ext.ny - 3, ext.nx + 9)))


def _block_sums(block: Shape, halo: int = 0) -> str:
    def span(a, b, n):
        return f"v.{a} >= k{a}*{b}-{halo} AND v.{a} < (k{a}+1)*{b}+{halo}"

    return (
        "SELECT round, channel, kz AS bz, ky AS by, kx AS bx, CAST(sum(value) AS BIGINT) AS total FROM fx_voxels v, fx_dim, "
        f"range(7//{block.nz}+1) a(kz), range((SELECT side FROM fx_dim)//{block.ny}+1) b(ky), range((SELECT side FROM fx_dim)//{block.nx}+1) c(kx) "
        f"WHERE kz*{block.nz}<7 AND ky*{block.ny}<side AND kx*{block.nx}<side AND {span('z', block.nz, 7)} AND {span('y', block.ny, 0)} AND {span('x', block.nx, 0)} "
        "GROUP BY ALL HAVING sum(value) > 0"
    )


def _totals(spark, blocks):
    """Sum of the pixels of each block, keeping the block key."""
    keyed = blocks.withColumn("channel", F.concat_ws("|", "channel", "bz", "by", "bx"))
    parts = F.split("channel", r"\|")
    sums = bl.to_voxels(keyed).groupBy("round", "channel").agg(F.sum("value").alias("total"))
    return sums.select(
        "round", parts[0].alias("channel"), *[parts[i + 1].cast("bigint").alias(k) for i, k in enumerate(("bz", "by", "bx"))], "total"
    )


@query("vol_reblock", with_views("fx_voxels", _block_sums(OTHER)))
def vol_reblock(spark, sf):
    return _totals(spark, bl.reblock(as_blocks(spark, sf), shape(spark, sf), OTHER))


@query("vol_halo", with_views("fx_voxels", _block_sums(BLOCK, 3)))
def vol_halo(spark, sf):
    return _totals(spark, bl.halo_blocks(as_blocks(spark, sf, OTHER), shape(spark, sf), BLOCK, Shape(3, 3, 3)))


@query("vol_round_trip", with_views("fx_voxels", "SELECT round, channel, z, y, x, value FROM fx_voxels WHERE value > 0"))
def vol_round_trip(spark, sf):
    return bl.to_voxels(as_blocks(spark, sf))


# ---------------------------------------------------------------- smoothing, segmentation, components


@query("pix_gaussian", with_views("fx_voxels fx_grid", "SELECT z, y, x, round(v,4) AS value FROM g_x", [DENSE, *gaussian_ctes(2.0)]))
def pix_gaussian(spark, sf):
    ext = shape(spark, sf)
    blocks = bl.to_blocks(one_volume(spark, sf), ext, BLOCK)
    values = bl.block_values(bl.gaussian_smooth(blocks, ext, BLOCK, 2.0))
    return values.select("z", "y", "x", F.round("value", 4).alias("value"))


OTSU = [
    ("rng", "SELECT min(v) AS lo, max(v) AS hi, (max(v)-min(v))/256e0 AS width FROM {src}"),
    ("hist", "SELECT least(CAST(floor((v-lo)/width) AS INT),255) AS bin, count(*) AS n, any_value(lo)+(least(CAST(floor((v-lo)/width) AS INT),255)+0.5e0)*any_value(width) AS centre FROM {src} CROSS JOIN rng GROUP BY 1"),
    (
        "curve",
        "SELECT bin, centre, sum(n) OVER b AS n0, sum(n) OVER a AS n1, sum(n*centre) OVER b AS s0, sum(n*centre) OVER a AS s1 FROM hist "
        "WINDOW b AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)",
    ),
    ("otsu", "SELECT centre AS threshold FROM curve WHERE n1 IS NOT NULL ORDER BY round(n0::DOUBLE*n1*(s0/n0-s1/n1)*(s0/n0-s1/n1),2) DESC, bin LIMIT 1"),
]


def otsu_ctes(src: str) -> list[tuple[str, str]]:
    return [(name, sql.replace("{src}", src)) for name, sql in OTSU]


@query("obj_otsu", with_views("fx_voxels fx_grid", "SELECT round(threshold,4) AS threshold FROM otsu", [DENSE, *otsu_ctes("dense")]))
def obj_otsu(spark, sf):
    ext = shape(spark, sf)
    found = cc.otsu_threshold(one_volume(spark, sf), ext.size)
    return found.select(F.round("threshold", 4).alias("threshold"))


@query(
    "obj_components",
    with_using_key("fx_voxels", LABELLED, [("mask", "SELECT z, y, x FROM fx_voxels WHERE round='O' AND channel='A' AND value > 30000"), *component_ctes("mask")]),
)
def obj_components(spark, sf):
    ext = shape(spark, sf)
    mask = one_volume(spark, sf).filter("value > 30000").withColumn("value", F.lit(1))
    return cc.label_components(bl.to_blocks(mask, ext, BLOCK, "uint8"), ext, BLOCK)


_EDGES = (
    "SELECT o_orderkey AS a, 1000000000 + o_custkey AS b FROM orders UNION ALL "
    "SELECT 1000000000 + c_custkey, 1000000000 + c_custkey - c_custkey % 7 FROM customer"
)


@query(
    "obj_connected_components",
    "WITH RECURSIVE e AS (SELECT a, b FROM (" + _EDGES + ") UNION SELECT b, a FROM (" + _EDGES + ")), "
    "cc(node, root) USING KEY (node) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.a, min(cc.root) FROM cc JOIN e ON e.b=cc.node "
    "JOIN recurring.cc r ON r.node=e.a WHERE cc.root<r.root GROUP BY e.a) SELECT node, root FROM cc",
)
def obj_connected_components(spark, sf):
    base = 1000000000
    cust = fx.table(spark, sf, "customer")
    edges = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"), (F.col("o_custkey") + base).alias("b"))
    chain = cust.select((F.col("c_custkey") + base).alias("a"), (F.col("c_custkey") - F.col("c_custkey") % 7 + base).alias("b"))
    return cc.connected_components(edges.unionByName(chain))


@query(
    "obj_segment",
    with_using_key(
        "fx_voxels fx_grid",
        "SELECT label, count(*) AS area, min(z) AS min_z, min(y) AS min_y, min(x) AS min_x FROM (" + LABELLED + ") GROUP BY label",
        [DENSE, *gaussian_ctes(1.0), *otsu_ctes("g_x"), ("mask", "SELECT z, y, x FROM g_x CROSS JOIN otsu WHERE v > threshold"), *component_ctes("mask")],
    ),
)
def obj_segment(spark, sf):
    ext = shape(spark, sf)
    found = cc.segment_blocks(bl.to_blocks(one_volume(spark, sf), ext, BLOCK), ext, BLOCK, sigma=1.0)
    return ob.region_props(found).select("label", "area", "min_z", "min_y", "min_x")


@query(
    "obj_relabel_binary",
    with_using_key(
        "fx_labels fx_dim",
        "SELECT label, count(*) AS area FROM (" + LABELLED + ") GROUP BY label",
        [("mask", "SELECT z, y, x FROM fx_labels"), *component_ctes("mask")],
    ),
)
def obj_relabel_binary(spark, sf):
    binary = fx.labels(spark, sf).withColumn("label", F.lit(1).cast("bigint"))
    found = cc.relabel_if_binary(binary, shape(spark, sf), BLOCK)
    return ob.region_props(found).select("label", "area")


# ---------------------------------------------------------------- sinks and synthetic data


@query("out_png")
def out_png(spark, sf):
    gray = pr.contrast(dense_mips(spark, sf), ["label", "channel"])
    return render.render_png(gray, ["label", "channel"], ["gray"])


@query("out_png_composite")
def out_png_composite(spark, sf):
    rgb = pr.composite(dense_mips(spark, sf), pr.settings_table(spark, SETTINGS))
    return render.render_png(rgb, ["label"], ["red", "green", "blue"])


@query(
    "out_summary",
    with_views(
        "fx_voxels",
        "SELECT 'two_stage_affine_deformation' AS kind, 'O/A' AS fixed_path, 'F/A' AS moving_path, max(x) FILTER (WHERE round='O')+1 AS fixed_x, "
        "max(x) FILTER (WHERE round='F')+1 AS moving_x, 2e0 AS m03 FROM fx_voxels WHERE channel='A'",
    ),
)
def out_summary(spark, sf):
    cat = volumes.voxel_catalog(fx.voxels(spark, sf).filter("channel = 'A'"))
    fixed, moving = cat.filter("round = 'O'"), cat.filter("round = 'F'")
    matrix = [[1, 0, 0, 2], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    doc = reports.registration_summary(fixed, moving, fixed, matrix, "affine.txt", "field")
    path = new_path(spark, "summary")
    reports.write_json(doc, path)

    def field(p):
        return F.get_json_object("value", p)

    return spark.read.text(path).select(
        field("$.registration_type").alias("kind"), field("$.input_volumes.fixed.path").alias("fixed_path"),
        field("$.input_volumes.moving.path").alias("moving_path"),
        field("$.input_volumes.fixed.shape[2]").cast("bigint").alias("fixed_x"),
        field("$.input_volumes.moving.shape[2]").cast("bigint").alias("moving_x"),
        field("$.transformations.affine_matrix[0][3]").cast("double").alias("m03"),
    )


@query(
    "out_report",
    "SELECT count(*) FILTER (WHERE n_regionkey=0) AS rounds, count(*) FILTER (WHERE n_regionkey=1) AS registrations, "
    "count(*) FILTER (WHERE n_regionkey=2) AS segmentations, min(n_name) FILTER (WHERE n_regionkey=0) AS first_round FROM nation",
)
def out_report(spark, sf):
    kind = F.element_at(F.create_map(F.lit(0), F.lit("round"), F.lit(1), F.lit("registration"), F.lit(2), F.lit("segmentation")), F.col("n_regionkey"))
    runs = fx.table(spark, sf, "nation").filter("n_regionkey < 3").select(
        kind.alias("kind"), F.col("n_name").alias("name"), F.lit("ok").alias("detail")
    )
    doc = reports.processing_report(runs, '{"k": 1}')

    def field(p):
        return F.get_json_object("value", p)

    return doc.select(
        field("$.pipeline_summary.total_rounds_processed").cast("bigint").alias("rounds"),
        field("$.pipeline_summary.total_registrations").cast("bigint").alias("registrations"),
        field("$.pipeline_summary.total_segmentations").cast("bigint").alias("segmentations"),
        field("$.rounds_processed[0].name").alias("first_round"),
    )


_SEEDS = (
    "SELECT s_suppkey+1 AS label, s_suppkey%7 AS cz, (s_suppkey*13)%side AS cy, (s_suppkey*29)%side AS cx, 2+s_suppkey%6 AS radius, "
    "greatest(2, CAST(floor((2+s_suppkey%6)/2) AS BIGINT)) AS rz FROM supplier CROSS JOIN fx_dim"
)


def _seeds(spark, sf):
    side = shape(spark, sf).nx
    k = F.col("s_suppkey")
    return fx.table(spark, sf, "supplier").select(
        (k + 1).alias("label"), (k % 7).alias("cz"), ((k * 13) % side).alias("cy"), ((k * 29) % side).alias("cx"),
        (k % 6 + 2).alias("radius"),
    )


@query(
    "vol_synth_labels",
    with_views(
        "fx_grid",
        "SELECT z, y, x, max(label) AS label FROM fx_grid g JOIN (" + _SEEDS + ") s ON power((z-cz)/rz::DOUBLE,2)+power((y-cy)/radius::DOUBLE,2)+power((x-cx)/radius::DOUBLE,2) <= 1 GROUP BY z, y, x",
    ),
)
def vol_synth_labels(spark, sf):
    return synth.synth_labels(_seeds(spark, sf), shape(spark, sf), dropout=0.0)


@query("vol_synth_stain")
def vol_synth_stain(spark, sf):
    return synth.synth_stain(synth.synth_labels(_seeds(spark, sf), shape(spark, sf)))


@query("vol_synth_epitope")
def vol_synth_epitope(spark, sf):
    ext = shape(spark, sf)
    return synth.synth_epitope(synth.synth_labels(_seeds(spark, sf), ext), ext)
