"""Resampling and transform queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelweave.model import Shape
from voxelweave.operators import blocks as bl
from voxelweave.operators import resample as rs
from voxelweave.operators import transform as tf
from voxelweave.queries.registry import Registry
from voxelweave.queries.volumes import BLOCK, OTHER
from voxelweave.sources import fixtures as fx
from voxelweave.sources.fixtures import with_views

query = Registry()

FACTORS = (2, 3, 3)
MATRIX = [[1.0, 0.0, 0.0, 0.4], [0.0, 0.98, 0.03, 1.5], [0.0, -0.03, 0.98, 2.25]]
SPACING = (0.4, 0.2, 0.2)


def shape(spark, sf):
    return fx.volume_shape(spark, sf)


def moving(spark, sf):
    return fx.voxels(spark, sf).filter(F.col("round") == fx.MOVING_ROUND)


def field(spark, sf, ext):
    """A smooth displacement field over the whole grid, in physical units."""
    points = tf.grid_points(spark, ext, (1.0, 1.0, 1.0))
    return points.select(
        *[F.col(o).alias(a) for a, o in zip("zyx", tf.OUT)],
        F.lit(0.1).alias("dz"),
        (F.col("px") % 5 * 0.06).alias("dy"),
        (F.col("py") % 3 * 0.1 - 0.1).alias("dx"),
    )


_FIELD = "0.1e0 AS dz, (x % 5)*0.06e0 AS dy, (y % 3)*0.1e0-0.1e0 AS dx"


def _linear(points: str, source: str) -> list[tuple[str, str]]:
    """Sample ``source(round, channel, z, y, x, value)`` at ``points(z, y, x, qz, qy, qx)`` by eight corners."""
    weights = "*".join(f"(CASE d{a}.k WHEN 0 THEN 1-(q{a}-floor(q{a})) ELSE q{a}-floor(q{a}) END)" for a in "zyx")
    cells = ", ".join(f"CAST(floor(q{a}) AS BIGINT)+d{a}.k AS c{a}" for a in "zyx")
    return [
        ("corner", f"SELECT p.z, p.y, p.x, {cells}, {weights} AS w FROM {points} p, range(2) dz(k), range(2) dy(k), range(2) dx(k)"),
        (
            "sampled",
            f"SELECT round, channel, c.z, c.y, c.x, sum(c.w*s.value) AS v FROM corner c JOIN {source} s ON s.z=c.cz AND s.y=c.cy AND s.x=c.cx WHERE c.w>1e-9 GROUP BY ALL",
        ),
    ]


def _half_up(table: str = "sampled") -> str:
    return (
        "SELECT round, channel, z, y, x, value FROM (SELECT *, CAST(floor(round(v,6)+0.5) AS BIGINT) AS value FROM " + table + ") WHERE value > 0"
    )


MOVING = ("mv", "SELECT * FROM fx_voxels WHERE round='F'")
_INT = "CAST(floor({0}/{1}) AS BIGINT)"


def _small(z: int, y: int, x: int) -> tuple[str, str]:
    return (
        "small",
        f"SELECT z, y, x, z*(7-1)/(7//{z}-1)::DOUBLE AS qz, y*(side-1)/(side//{y}-1)::DOUBLE AS qy, x*(side-1)/(side//{x}-1)::DOUBLE AS qx "
        f"FROM fx_dim, range(7//{z}) a(z), range((SELECT side FROM fx_dim)//{y}) b(y), range((SELECT side FROM fx_dim)//{x}) c(x)",
    )


@query("rs_downsample", with_views("fx_voxels", _half_up(), [_small(*FACTORS), *_linear("small", "fx_voxels")]))
def rs_downsample(spark, sf):
    return rs.downsample(fx.voxels(spark, sf), shape(spark, sf), FACTORS)


def _nearest(target_y: str, target_x: str) -> str:
    def src(a, n, m):
        return f"CAST(floor({a}*({n}-1)/({m}-1)::DOUBLE+0.5) AS BIGINT)"

    return (
        f"SELECT l.label, g.z, g.y, g.x FROM (SELECT z, y, x, {src('z', 7, 14)} AS sz, {src('y', 'side', target_y)} AS sy, {src('x', 'side', target_x)} AS sx "
        f"FROM fx_dim, range(14) a(z), range((SELECT {target_y} FROM fx_dim)) b(y), range((SELECT {target_x} FROM fx_dim)) c(x)) g "
        "JOIN fx_labels l ON l.z=g.sz AND l.y=g.sy AND l.x=g.sx"
    )


@query("rs_upsample_labels", with_views("fx_labels", _nearest("side*3", "side*3")))
def rs_upsample_labels(spark, sf):
    return rs.upsample_labels(fx.labels(spark, sf), shape(spark, sf), (2, 3, 3))


@query("rs_upsample_labels_target", with_views("fx_labels", _nearest("(side*2+1)", "(side*3-2)")))
def rs_upsample_labels_target(spark, sf):
    ext = shape(spark, sf)
    return rs.upsample_labels(fx.labels(spark, sf), ext, target=Shape(14, ext.ny * 2 + 1, ext.nx * 3 - 2))


@query(
    "rs_resample_spacing",
    with_views(
        "fx_voxels",
        "SELECT round, channel, z, y, x, CAST(floor(round(v,6)) AS BIGINT) AS value FROM sampled WHERE floor(round(v,6)) >= 1",
        [
            (
                "pts",
                "SELECT z, y, x, least(z*1.5,6)::DOUBLE AS qz, least(y*0.7e0,side-1)::DOUBLE AS qy, least(x*1.25,side-1)::DOUBLE AS qx FROM fx_dim, range(CAST(round_even(7/1.5,0) AS BIGINT)) a(z), "
                "range(CAST(round_even((SELECT side FROM fx_dim)/0.7e0,0) AS BIGINT)) b(y), range(CAST(round_even((SELECT side FROM fx_dim)/1.25e0,0) AS BIGINT)) c(x) "
                "WHERE z*1.5<6.5 AND y*0.7e0<side-0.5 AND x*1.25<side-0.5",
            ),
            *_linear("pts", "fx_voxels"),
        ],
    ),
)
def rs_resample_spacing(spark, sf):
    return rs.resample_spacing(fx.voxels(spark, sf), shape(spark, sf), (1.0, 1.0, 1.0), (1.25, 0.7, 1.5))


def _coarse(spark, sf):
    """A coarse displacement field whose vectors come from the volume's own intensities."""
    ext = shape(spark, sf)
    vox = fx.voxels(spark, sf).filter("round = 'O' AND channel = 'A'")
    vec = vox.select("z", "y", "x", (F.col("value") / 1000.0).alias("dz"), (F.col("value") / 500.0).alias("dy"), (-F.col("value") / 797.0).alias("dx"))
    return vec, ext


_COARSE = (
    "coarse",
    "SELECT 'O' AS round, c.channel, z, y, x, CASE c.channel WHEN 'dz' THEN value/1000e0 WHEN 'dy' THEN value/500e0 ELSE -value/797e0 END AS value "
    "FROM fx_voxels v, (VALUES ('dz'),('dy'),('dx')) c(channel) WHERE v.round='O' AND v.channel='A'",
)
_PIVOT = (
    "SELECT z, y, x, round(sum(CASE channel WHEN 'dz' THEN v END),6) AS dz, round(sum(CASE channel WHEN 'dy' THEN v END),6) AS dy, "
    "round(sum(CASE channel WHEN 'dx' THEN v END),6) AS dx FROM sampled GROUP BY z, y, x"
)


@query(
    "rs_upsample_field",
    with_views(
        "fx_voxels",
        _PIVOT,
        [
            _COARSE,
            (
                "pts",
                "SELECT z, y, x, least(z/1e0,6)::DOUBLE AS qz, least(y/2e0,side-1)::DOUBLE AS qy, least(x/2e0,side-1)::DOUBLE AS qx FROM fx_dim, range(7) a(z), "
                "range((SELECT side FROM fx_dim)*2) b(y), range((SELECT side FROM fx_dim)*2) c(x) WHERE y/2e0<side-0.5 AND x/2e0<side-0.5",
            ),
            *_linear("pts", "coarse"),
        ],
    ),
)
def rs_upsample_field(spark, sf):
    vec, ext = _coarse(spark, sf)
    out = rs.upsample_field(vec, ext, Shape(ext.nz, ext.ny * 2, ext.nx * 2), (1, 2, 2), "linear")
    return out.select("z", "y", "x", *[F.round(c, 6).alias(c) for c in tf.FIELD])


def _eta(t: str) -> str:
    terms = []
    for j in (-1, 0, 1, 2):
        k, d = f"(floor({t})+{j})", f"abs({t}-(floor({t})+{j}))"
        terms.append(
            f"sqrt(3e0)*power(sqrt(3e0)-2,abs({k}))*(CASE WHEN {d}<1 THEN 2e0/3-{d}*{d}+{d}*{d}*{d}/2 WHEN {d}<2 THEN power(2-{d},3)/6 ELSE 0 END)"
        )
    return " + ".join(terms)


def _spline_sql() -> list[tuple[str, str]]:
    out, previous = [], "coarse_dense"
    for axis, n, factor in (("z", "7", 1), ("y", "side", 2), ("x", "side", 2)):
        mirror = f"((p % (2*({n}-1))) + 2*({n}-1)) % (2*({n}-1))"
        out.append(
            (
                f"w_{axis}",
                f"SELECT o, CASE WHEN {mirror} < {n} THEN {mirror} ELSE 2*({n}-1)-({mirror}) END AS s, sum({_eta(f'(o/{factor}e0-p)')}) AS w FROM "
                f"(SELECT o, CAST(ceil(o/{factor}e0) AS BIGINT)+k AS p, side FROM fx_dim, range((SELECT {n}*{factor} FROM fx_dim)) a(o), range(-13,14) b(k)) "
                f"WHERE abs(o/{factor}e0-p) <= 12 AND o/{factor}e0 < {n}-0.5 GROUP BY 1, 2",
            )
        )
        cols = ", ".join(f"w.o AS {a}" if a == axis else f"f.{a}" for a in "zyx")
        sums = ", ".join(f"sum(w.w*f.{c}) AS {c}" for c in ("dz", "dy", "dx"))
        out.append((f"s_{axis}", f"SELECT {cols}, {sums} FROM {previous} f JOIN w_{axis} w ON w.s=f.{axis} GROUP BY 1, 2, 3"))
        previous = f"s_{axis}"
    return out


@query(
    "rs_upsample_field_bspline",
    with_views(
        "fx_voxels",
        "SELECT count(*) AS n, round(sum(dz),2) AS dz, round(sum(dy*y),1) AS dy, round(sum(dx*x),1) AS dx FROM s_x",
        [
            ("coarse_dense", "SELECT z, y, x, value/1000e0 AS dz, value/500e0 AS dy, -value/797e0 AS dx FROM fx_voxels WHERE round='O' AND channel='A'"),
            *_spline_sql(),
        ],
    ),
)
def rs_upsample_field_bspline(spark, sf):
    vec, ext = _coarse(spark, sf)
    out = rs.upsample_field(vec, ext, Shape(ext.nz, ext.ny * 2, ext.nx * 2), (1, 2, 2), "bspline")
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("dz"), 2).alias("dz"), F.round(F.sum(F.col("dy") * F.col("y")), 1).alias("dy"),
        F.round(F.sum(F.col("dx") * F.col("x")), 1).alias("dx"),
    )


def _affine_points(z: str, y: str, x: str, source: str = "fx_grid") -> str:
    """Index coordinates after the matrix for physical point expressions."""
    s = dict(zip("zyx", SPACING))
    rows = dict(zip("zyx", MATRIX))
    p = {"z": z, "y": y, "x": x}
    q = {a: "+".join(f"({p[b]})*{rows[a][j]}e0" for j, b in enumerate("zyx")) + f"+{rows[a][3]}e0" for a in "zyx"}
    return "SELECT z, y, x, " + ", ".join(f"round(({q[a]})/{s[a]}e0,9) AS q{a}" for a in "zyx") + f" FROM {source}"


_POINTS = tuple(f"{a}*{s}e0" for a, s in zip("zyx", SPACING))
_WITH_FIELD = ("fielded", f"SELECT z, y, x, {_FIELD} FROM fx_grid")
_INSIDE = ("mv", "SELECT * FROM fx_voxels WHERE round='F'")


@query("tf_affine", with_views("fx_voxels fx_grid", _half_up(), [_INSIDE, ("pts", _affine_points(*_POINTS)), *_linear("pts", "mv")]))
def tf_affine(spark, sf):
    return tf.apply_affine(moving(spark, sf), MATRIX, shape(spark, sf), SPACING)


@query(
    "tf_field",
    with_views(
        "fx_voxels fx_grid",
        _half_up(),
        [
            _INSIDE,
            ("pts", f"SELECT z, y, x, round((z*{SPACING[0]}e0+dz)/{SPACING[0]}e0,9) AS qz, round((y*{SPACING[1]}e0+dy)/{SPACING[1]}e0,9) AS qy, "
                    f"round((x*{SPACING[2]}e0+dx)/{SPACING[2]}e0,9) AS qx FROM (SELECT z, y, x, {_FIELD} FROM fx_grid)"),
            *_linear("pts", "mv"),
        ],
    ),
)
def tf_field(spark, sf):
    ext = shape(spark, sf)
    return tf.apply_field(moving(spark, sf), field(spark, sf, ext), ext, SPACING)


_COMPOSITE = with_views(
    "fx_voxels fx_grid",
    _half_up(),
    [_INSIDE, _WITH_FIELD, ("pts", _affine_points(*(f"{p}+d{a}" for p, a in zip(_POINTS, "zyx")), source="fielded")), *_linear("pts", "mv")],
)


@query("tf_composite", _COMPOSITE)
def tf_composite(spark, sf):
    """[matrix, field]: the field moves the point first; every channel in one job."""
    ext = shape(spark, sf)
    return tf.apply_transforms(moving(spark, sf), [MATRIX, field(spark, sf, ext)], ext, SPACING)


def _blocks(spark, sf, with_field: bool):
    ext = shape(spark, sf)
    source = bl.to_blocks(moving(spark, sf), ext, OTHER)
    fields = None
    if with_field:
        rows = field(spark, sf, ext)
        rows = rows.select("z", "y", "x", F.explode(F.create_map(*[v for d in tf.FIELD for v in (F.lit(d), F.col(d))])).alias("channel", "value"))
        fields = bl.to_blocks(rows.withColumn("round", F.lit("field")), ext, BLOCK, "float64")
    out = tf.apply_transforms_blocks(source, MATRIX, ext, BLOCK, ext, SPACING, fields)
    return bl.to_voxels(out)


@query("tf_affine_blocks", with_views("fx_voxels fx_grid", _half_up(), [_INSIDE, ("pts", _affine_points(*_POINTS)), *_linear("pts", "mv")]))
def tf_affine_blocks(spark, sf):
    return _blocks(spark, sf, with_field=False)


@query("tf_composite_blocks", _COMPOSITE)
def tf_composite_blocks(spark, sf):
    return _blocks(spark, sf, with_field=True)


_PAIRS = (
    "pairs",
    "SELECT g.z, g.y, g.x, coalesce(f.value,0) AS f, coalesce(m.value,0) AS m FROM fx_grid g LEFT JOIN (SELECT * FROM fx_voxels WHERE round='O' AND channel='A') f USING (z,y,x) "
    "LEFT JOIN (SELECT * FROM fx_voxels WHERE round='F' AND channel='A') m USING (z,y,x)",
)


def _pair(spark, sf):
    vox = fx.voxels(spark, sf).filter("channel = 'A'")
    return vox.filter("round = 'O'"), vox.filter("round = 'F'")


_MI = (
    "(WITH j AS (SELECT least(f*32//65536,31) AS bf, least(m*32//65536,31) AS bm, count(*) AS n FROM {p} GROUP BY 1, 2), t AS (SELECT sum(n) AS total FROM j) "
    "SELECT sum(n/total*ln(n*total/(nf*nm))) FROM (SELECT n::DOUBLE AS n, sum(n) OVER (PARTITION BY bf)::DOUBLE AS nf, sum(n) OVER (PARTITION BY bm)::DOUBLE AS nm FROM j) CROSS JOIN (SELECT total::DOUBLE AS total FROM t))"
)


@query("reg_mutual_information", with_views("fx_voxels fx_grid", f"SELECT round({_MI.format(p='pairs')},6) AS mi", [_PAIRS]))
def reg_mutual_information(spark, sf):
    fixed, mov = _pair(spark, sf)
    mi = tf.mutual_information(tf.paired_values(fixed, mov), shape(spark, sf).size)
    return mi.select(F.round("mi", 6).alias("mi"))


@query(
    "reg_quality",
    with_views(
        "fx_voxels fx_grid",
        f"SELECT 'before' AS stage, round((SELECT corr(f,m) FROM pairs),6) AS ncc, round({_MI.format(p='pairs')},6) AS mi UNION ALL "
        f"SELECT 'after', round((SELECT corr(f,m) FROM same),6), round({_MI.format(p='same')},6)",
        [_PAIRS, ("same", "SELECT z, y, x, f, f AS m FROM pairs")],
    ),
)
def reg_quality(spark, sf):
    fixed, mov = _pair(spark, sf)
    out = tf.registration_quality(fixed, mov, fixed, shape(spark, sf))
    return out.select("stage", F.round("ncc", 6).alias("ncc"), F.round("mi", 6).alias("mi"))
