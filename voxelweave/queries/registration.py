"""Transform-estimation and stitching queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.model import Shape
from voxelweave.operators import blocks as bl
from voxelweave.operators import matching as mt
from voxelweave.operators import registration as rg
from voxelweave.operators import stitching as sg
from voxelweave.operators import tiles as tl
from voxelweave.operators import transform as tf
from voxelweave.queries.registry import Registry
from voxelweave.queries.volumes import BLOCK, DENSE, gaussian_ctes, one_volume
from voxelweave.sources import fixtures as fx
from voxelweave.sources.fixtures import with_views

query = Registry()

SIZES = (2.0, 4.0)
SIGMAS = mt.blob_sigmas(SIZES)
SEARCH = (1, 2, 2)
PLANTED = ((1.02, 0.05, -0.01, 3.0), (-0.04, 0.97, 0.02, -2.0), (0.01, -0.03, 1.01, 5.5))


def shape(spark, sf):
    return fx.volume_shape(spark, sf)


@query(
    "reg_blobs",
    with_views(
        "fx_voxels fx_grid",
        "SELECT z, y, x, dog AS response FROM dog d WHERE dog > 100 AND NOT EXISTS (SELECT 1 FROM dog n WHERE n.z BETWEEN d.z-1 AND d.z+1 AND n.y BETWEEN d.y-1 AND d.y+1 "
        "AND n.x BETWEEN d.x-1 AND d.x+1 AND (n.z<>d.z OR n.y<>d.y OR n.x<>d.x) AND n.dog >= d.dog)",
        [
            DENSE, *gaussian_ctes(SIGMAS[0], tag="n"), *gaussian_ctes(SIGMAS[1], tag="w"),
            ("dog", "SELECT n_x.z, n_x.y, n_x.x, round(n_x.v-w_x.v,4) AS dog FROM n_x JOIN w_x USING (z, y, x)"),
        ],
    ),
)
def reg_blobs(spark, sf):
    ext = shape(spark, sf)
    blocks = bl.to_blocks(one_volume(spark, sf), ext, BLOCK)
    return mt.detect_blobs(blocks, ext, BLOCK, SIZES, threshold=100.0).select("z", "y", "x", F.round("response", 4).alias("response"))


_VEC = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 2 = {0}"
_MUTUAL = (
    "SELECT a.id_a, a.id_b, round(a.d,6) AS distance FROM (SELECT id_a, id_b, d FROM d QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY d, id_b)=1) a JOIN "
    "(SELECT id_a, id_b FROM d QUALIFY row_number() OVER (PARTITION BY id_b ORDER BY d, id_a)=1) b ON a.id_a=b.id_a AND a.id_b=b.id_b"
)


@query(
    "reg_match_features",
    f"WITH a AS ({_VEC.format(0)}), b AS ({_VEC.format(1)}), d AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_distance(a.v,b.v),9) AS d FROM a CROSS JOIN b) " + _MUTUAL,
)
def reg_match_features(spark, sf):
    rows = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    out = mt.match_features(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), chunk_rows=100)
    return out.withColumn("distance", F.round("distance", 6))


@query(
    "reg_match_features_radius",
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, vec_id//2%7 AS z, vec_id//2%31 AS y, vec_id//2%37 AS x FROM embeddings), "
    "d AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_distance(a.v,b.v),9) AS d FROM e a JOIN e b ON a.vec_id%2=0 AND b.vec_id%2=1 "
    "AND power(a.z-b.z,2)+power(a.y-b.y,2)+power(a.x-b.x,2) <= 36) " + _MUTUAL,
)
def reg_match_features_radius(spark, sf):
    half = F.floor(F.col("vec_id") / 2).cast("bigint")
    rows = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
        (half % 7).alias("z"), (half % 31).alias("y"), (half % 37).alias("x"),
    )
    out = mt.match_features(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), radius=6.0)
    return out.withColumn("distance", F.round("distance", 6))


def _matches(spark, sf, outliers: bool = False):
    pts = fx.points(spark, sf).select("pid", *[F.col(a).alias(f"p{a}") for a in "zyx"])
    q = {
        f"q{a}": sum((F.col(f"p{b}") * row[j] for j, b in enumerate("zyx")), F.lit(row[3])) for a, row in zip("zyx", PLANTED)
    }
    moved = pts.withColumns(q)
    if outliers:
        bad = F.col("pid") % 5 == 0
        moved = moved.withColumns({c: F.when(bad, F.col(c) + 40 + F.col("pid") % 17).otherwise(F.col(c)) for c in q})
    return moved


def _planted(a: int) -> str:
    return "+".join(f"{c}*{PLANTED[a][j]}e0" for j, c in enumerate("zyx")) + f"+{PLANTED[a][3]}e0"


@query(
    "reg_normal_sums",
    with_views(
        "fx_points",
        "SELECT round(sum(z*z),2) AS a00, round(sum(z*y),2) AS a01, round(sum(z),2) AS a03, count(*)::DOUBLE AS a33, "
        "round(sum(z*qz),2) AS b00, round(sum(y*qx),2) AS b12, round(sum(qy),2) AS b31 FROM "
        f"(SELECT z, y, x, {_planted(0)} AS qz, {_planted(1)} AS qy, {_planted(2)} AS qx FROM fx_points)",
    ),
)
def reg_normal_sums(spark, sf):
    sums = mt.normal_sums(_matches(spark, sf))
    return sums.select(*[F.round(c, 2).alias(c) for c in ("a00", "a01", "a03", "a33", "b00", "b12", "b31")])


def _matrix_sql() -> str:
    rows = ", ".join(f"({i}::BIGINT, {', '.join(f'{v}e0' for v in row)}, n)" for i, row in enumerate(PLANTED))
    return f"SELECT t.* FROM (SELECT count(*) AS n FROM customer) c, LATERAL (VALUES {rows}) t(axis, m0, m1, m2, m3, points)"


def _matrix_rows(spark, matrix, points):
    rows = [(i, *[round(float(v), 6) + 0.0 for v in matrix[i]], points) for i in range(3)]
    return spark.createDataFrame(rows, "axis bigint, m0 double, m1 double, m2 double, m3 double, points bigint")


@query("reg_fit_affine", _matrix_sql())
def reg_fit_affine(spark, sf):
    """Least squares recovers the affine planted on the customer points."""
    matches = _matches(spark, sf)
    return _matrix_rows(spark, mt.fit_affine_lsq(matches), matches.count())


@query("reg_ransac", _matrix_sql().replace("count(*) AS n", "count(*) FILTER (WHERE c_custkey % 5 <> 0) AS n"))
def reg_ransac(spark, sf):
    """The robust fit recovers it with a fifth of the matches moved away."""
    matrix, inliers = mt.ransac_affine(_matches(spark, sf, outliers=True), n_iter=200, tolerance=1.0)
    return _matrix_rows(spark, matrix, inliers)


def _fixed_moving(spark, sf):
    """A textured volume (smoothed intensities) and the same displaced by (0, 1, -2)."""
    ext = shape(spark, sf)
    source = bl.to_blocks(one_volume(spark, sf), ext, BLOCK)
    fixed = bl.block_values(bl.gaussian_smooth(source, ext, BLOCK, 1.0)).withColumn("value", F.round("value").cast("bigint"))
    moved = fixed.withColumns({"y": F.col("y") + 1, "x": F.col("x") - 2})
    inside = (F.col("y") < ext.ny) & (F.col("x") >= 0)
    return fixed.filter("value > 0"), moved.filter(inside & (F.col("value") > 0)), ext


def _spans(block: Shape, overlap: float = 0.3):
    return dict(zip("zyx", ((b, int(overlap * b)) for b in block)))


def _shift_sql() -> str:
    spans = _spans(BLOCK)
    near = " AND ".join(f"f.{a} >= k{a}*{b}-{h} AND f.{a} < (k{a}+1)*{b}+{h}" for a, (b, h) in spans.items())
    ks = ", ".join(f"range((CASE '{a}' WHEN 'z' THEN 7 ELSE (SELECT side FROM fx_dim) END-1)//{b}+1) t{a}(k{a})" for a, (b, h) in spans.items())
    return with_views(
        "fx_voxels fx_grid",
        "SELECT kz::INT::BIGINT AS bz, ky::BIGINT AS by, kx::BIGINT AS bx, dz::DOUBLE AS dz, dy::DOUBLE AS dy, dx::DOUBLE AS dx, ncc FROM scored "
        "QUALIFY row_number() OVER (PARTITION BY kz, ky, kx ORDER BY ncc DESC, dz*dz+dy*dy+dx*dx, dz, dy, dx)=1",
        [
            ("fx", "SELECT z, y, x, coalesce(value,0)::DOUBLE AS f FROM fx_grid LEFT JOIN (SELECT * FROM fx_voxels WHERE round='O' AND channel='A') v USING (z, y, x)"),
            ("mx", "SELECT z, y, x, value::DOUBLE AS m FROM fx_voxels WHERE round='F' AND channel='A'"),
            (
                "scored",
                f"SELECT kz, ky, kx, dz, dy, dx, round(corr(f, coalesce(m,0)),6) AS ncc FROM (SELECT f.*, kz, ky, kx, dz, dy, dx FROM fx f, {ks}, range(-1,2) sz(dz), range(-2,3) sy(dy), range(-2,3) sx(dx) WHERE {near}) f "
                "LEFT JOIN mx ON mx.z=f.z+dz AND mx.y=f.y+dy AND mx.x=f.x+dx GROUP BY ALL HAVING isfinite(corr(f, coalesce(m,0)))",
            ),
        ],
    )


def _round_pair(spark, sf):
    ext = shape(spark, sf)
    vox = fx.voxels(spark, sf).filter("channel = 'A'")
    return [bl.to_blocks(vox.filter(F.col("round") == r), ext, BLOCK) for r in ("O", "F")], ext


@query("reg_block_shifts", _shift_sql())
def reg_block_shifts(spark, sf):
    (fixed, mov), ext = _round_pair(spark, sf)
    out = rg.block_shifts(fixed, mov, ext, BLOCK, search=SEARCH, min_ncc=-1.0)
    return out.select(*[F.col(k).cast("bigint").alias(k) for k in ("bz", "by", "bx")], "dz", "dy", "dx", F.round("ncc", 6).alias("ncc"))


PYRAMID, PLANTED_SHIFT = Shape(7, 8, 8), (0, 3, -3)  # more than a third of a block


def _planted_sql() -> str:
    """Blocks whose displaced window lies inside the volume, each with the displacement planted."""
    h = [int(0.3 * b) for b in PYRAMID]
    side = "(SELECT side FROM fx_dim)"
    return with_views(
        "fx_dim",
        f'SELECT 0::BIGINT AS bz, "by", bx, 0.0::DOUBLE AS dz, {PLANTED_SHIFT[1]}.0::DOUBLE AS dy, {PLANTED_SHIFT[2]}.0::DOUBLE AS dx FROM '
        f'range(({side}-1)//{PYRAMID.ny}+1) b("by"), range(({side}-1)//{PYRAMID.nx}+1) c(bx) WHERE least(("by"+1)*{PYRAMID.ny}+{h[1]}, {side})+{PLANTED_SHIFT[1]} <= {side} '
        f"AND greatest(bx*{PYRAMID.nx}-{h[2]}, 0)+({PLANTED_SHIFT[2]}) >= 0",
    )


@query("reg_pyramid_shifts", _planted_sql())
def reg_pyramid_shifts(spark, sf):
    """A displaced copy by pyramid matching; every block that sees all of its displaced window finds the displacement."""
    ext = shape(spark, sf)
    fixed = bl.block_values(bl.gaussian_smooth(bl.to_blocks(one_volume(spark, sf), ext, BLOCK), ext, BLOCK, 1.0))
    fixed = fixed.withColumn("value", F.round("value").cast("bigint"))
    moved = fixed.withColumns({"y": F.col("y") + PLANTED_SHIFT[1], "x": F.col("x") + PLANTED_SHIFT[2]})
    moved = moved.filter((F.col("y") < ext.ny) & (F.col("x") >= 0))
    pair = [bl.to_blocks(v.filter("value > 0"), ext, PYRAMID) for v in (fixed, moved)]
    halo = Shape(*(int(0.3 * b) for b in PYRAMID))
    high = F.least((F.col("by") + 1) * PYRAMID.ny + halo.ny, F.lit(ext.ny)) + PLANTED_SHIFT[1]
    low = F.greatest(F.col("bx") * PYRAMID.nx - halo.nx, F.lit(0)) + PLANTED_SHIFT[2]
    found = rg.block_shifts(*pair, ext, PYRAMID).filter((high <= ext.ny) & (low >= 0))
    return found.select(*[F.col(k).cast("bigint").alias(k) for k in ("bz", "by", "bx")], "dz", "dy", "dx")


_CONTROL_KEEP = "(bz+by+bx) % 3 <> 1"


@query(
    "reg_field_blend",
    with_views(
        "fx_grid",
        "SELECT z, y, x, round(sum(w*dz)/sum(w)*0.5e0,6) AS dz, round(sum(w*dy)/sum(w),6) AS dy, round(sum(w*dx)/sum(w),6) AS dx FROM ("
        f"SELECT g.z, g.y, g.x, c.*, greatest(0,1-abs((g.z-{(BLOCK.nz - 1) / 2}e0)/{BLOCK.nz}-bz))*greatest(0,1-abs((g.y-{(BLOCK.ny - 1) / 2}e0)/{BLOCK.ny}-\"by\"))"
        f"*greatest(0,1-abs((g.x-{(BLOCK.nx - 1) / 2}e0)/{BLOCK.nx}-bx)) AS w FROM fx_grid g, ctl c) WHERE w > 0 GROUP BY z, y, x",
        [
            (
                "ctl",
                f'SELECT bz, "by", bx, (bz+1)::DOUBLE AS dz, ("by"*2-1)::DOUBLE AS dy, (bx+0.5)::DOUBLE AS dx FROM fx_dim, range(6//{BLOCK.nz}+1) a(bz), '
                f"range(((SELECT side FROM fx_dim)-1)//{BLOCK.ny}+1) b(\"by\"), range(((SELECT side FROM fx_dim)-1)//{BLOCK.nx}+1) c(bx) WHERE " + _CONTROL_KEEP.replace("by", '"by"'),
            )
        ],
    ),
)
def reg_field_blend(spark, sf):
    """Blend with a third of the control blocks missing."""
    ext = shape(spark, sf)
    grid = bl.block_count(ext, BLOCK)
    cells = tf.grid_points(spark, grid, (1.0, 1.0, 1.0)).select(*[F.col(o).cast("int").alias(k) for o, k in zip(tf.OUT, ("bz", "by", "bx"))])
    controls = cells.filter(_CONTROL_KEEP).select(
        "bz", "by", "bx", (F.col("bz") + 1.0).alias("dz"), (F.col("by") * 2.0 - 1).alias("dy"), (F.col("bx") + 0.5).alias("dx")
    )
    rows = rg.field_rows(rg.field_blocks(controls, ext, BLOCK, (0.5, 1.0, 1.0)))
    return rows.select("z", "y", "x", *[F.round(c, 6).alias(c) for c in tf.FIELD])


@query("reg_deformation")
def reg_deformation(spark, sf):
    """Deformable registration of a displaced copy; correlation before and after."""
    fixed, moved, ext = _fixed_moving(spark, sf)
    blocks = [bl.to_blocks(v, ext, BLOCK) for v in (fixed, moved)]
    _, aligned = rg.register_deformation(*blocks, ext, BLOCK, matrix=None)
    quality = tf.registration_quality(fixed, moved, bl.to_voxels(aligned), ext)
    return quality.select("stage", F.round("ncc", 6).alias("ncc"), F.round("mi", 6).alias("mi"))


@query("reg_chunk_alignment")
def reg_chunk_alignment(spark, sf):
    fixed, moved, ext = _fixed_moving(spark, sf)
    return rg.chunk_alignment(fixed, moved, ext, BLOCK, factors=(1, 2, 2))


@query("reg_affine")
def reg_affine(spark, sf):
    """Affine estimation of the displaced copy: features, robust fit, mutual-information search over all levels until none improves."""
    fixed, moved, ext = _fixed_moving(spark, sf)
    steps = [("ransac", {"blob_sizes": SIZES, "patch": 2, "n_iter": 300, "tolerance": 1.5}), ("affine", {})]
    matrix = rg.register_affine(fixed, moved, ext, factors=(1, 1, 1), steps=steps, block=BLOCK)
    return _matrix_rows(spark, matrix, ext.size)


@query("tile_phase_correlation")
def tile_phase_correlation(spark, sf):
    tiles = fx.tiles(spark, sf)
    return sg.phase_correlation(tl.overlap_pairs(tiles, 4), fx.tile_voxels(spark, sf), min_overlap=3)


@query(
    "tile_planted_shifts",
    "SELECT DISTINCT l_suppkey::BIGINT AS supplier, 0::BIGINT AS sz, (l_suppkey%5-2)::BIGINT AS sy, (l_suppkey%3-1)::BIGINT AS sx, 1e0 AS r FROM lineitem",
)
def tile_planted_shifts(spark, sf):
    """Every supplier's tile against a copy moved by a known shift, from windows half as long as the tile."""
    place = fx.tiles(spark, sf).select((2 * F.col("tile")).alias("tile"), *[F.lit(0).cast("bigint").alias(f"o{a}") for a in "zy"], (F.col("tile") * 40).alias("ox"), "dz", "dy", "dx")
    tiles = place.unionByName(place.withColumn("tile", F.col("tile") + 1))
    own = fx.tile_voxels(spark, sf)
    moved = own.select(
        (2 * F.col("tile") + 1).alias("tile"), "z", (F.col("y") - F.col("tile") % 5 + 2).alias("y"), (F.col("x") - F.col("tile") % 3 + 1).alias("x"), "value"
    ).filter("y between 0 and 15 and x between 0 and 15")
    found = sg.phase_correlation(tl.overlap_pairs(tiles, 4), own.withColumn("tile", 2 * F.col("tile")).unionByName(moved), window=8)
    return found.select(
        F.floor(F.col("tile_a") / 2).alias("supplier"), *[F.rint(f"s{a}").cast("bigint").alias(f"s{a}") for a in "zyx"], F.round("r", 6).alias("r")
    )


_TRUE = {"oz": 0, "oy": 1, "ox": -2}


@query(
    "tile_optimize_positions",
    with_views(
        "fx_nation_tiles",
        "SELECT tile, oz::DOUBLE AS pz, round(oy+0.5e0*(tile%3),4) AS py, round(ox-0.25e0*floor(tile/3),4) AS px FROM fx_nation_tiles",
    ),
)
def tile_optimize_positions(spark, sf):
    """Links measured from displaced tiles, one of them wrong: the wrong one is dropped."""
    tiles = fx.nation_tiles(spark, sf)
    true = tiles.select(
        "tile", (F.col("oy") + 0.5 * (F.col("tile") % 3)).alias("ty"), (F.col("ox") - 0.25 * F.floor(F.col("tile") / 3)).alias("tx")
    )
    pairs = tl.overlap_pairs(tiles, 4).select("tile_a", "tile_b")
    sides = [true.select(*[F.col(c).alias(f"{c}_{s}") for c in true.columns]) for s in "ab"]
    links = pairs.join(sides[0], "tile_a").join(sides[1], "tile_b")
    wrong = F.when((F.col("tile_a") == 4) & (F.col("tile_b") == 8), 30.0).otherwise(0.0)
    links = links.select(
        "tile_a", "tile_b", F.lit(0.0).alias("mz"), (F.col("ty_b") - F.col("ty_a") + wrong).alias("my"), (F.col("tx_b") - F.col("tx_a")).alias("mx")
    )
    positions, _ = sg.optimize_positions(tiles, links)
    return positions.select("tile", *[(F.round(f"p{a}", 4) + 0.0).alias(f"p{a}") for a in "zyx"])
