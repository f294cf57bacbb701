"""Image-like tables derived from the star-schema test tables.

Each function is the DataFrame form of the SQL view of the same name in ``VIEWS``; the SQL
text is used by the oracle queries, so both engines start from the same definition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelweave.model import Shape

DEPTH = 7
TILE_SHAPE = Shape(7, 16, 16)
REFERENCE_ROUND = "O"
MOVING_ROUND = "F"
MIN_OBJECT_SIZE = 18

VIEWS = {
    "fx_dim": ((), "SELECT CAST(floor(sqrt(count(*))) AS BIGINT) AS side FROM part"),
    "fx_digits": ((), "SELECT CAST(n_nationkey AS BIGINT) AS i FROM nation WHERE n_nationkey < 7"),
    "fx_voxels": (
        ("fx_dim",),
        "SELECT l_linestatus AS round, l_returnflag AS channel, CAST(l_linenumber-1 AS BIGINT) AS z, "
        "l_orderkey % side AS y, l_partkey % side AS x, "
        "CAST(max(CAST(floor(l_extendedprice) AS BIGINT) % 65536) AS BIGINT) AS value "
        "FROM lineitem CROSS JOIN fx_dim "
        "GROUP BY l_linestatus, l_returnflag, l_linenumber, l_orderkey % side, l_partkey % side",
    ),
    "fx_grid": (
        ("fx_dim",),
        "SELECT z, y, x FROM fx_dim, range(7) a(z), range((SELECT side FROM fx_dim)) b(y), "
        "range((SELECT side FROM fx_dim)) c(x)",
    ),
    "fx_lat": (
        ("fx_dim",),
        "SELECT side, g, CAST(floor(side / g) AS BIGINT) AS cell FROM (SELECT side, "
        "CAST(ceil(sqrt(n)) AS BIGINT) AS g FROM fx_dim CROSS JOIN (SELECT count(*) AS n FROM supplier) s) t",
    ),
    "fx_seeds": (
        ("fx_lat",),
        "SELECT s_suppkey+1 AS label, 3-(s_suppkey % 3) AS z0, 4+(s_suppkey % 2) AS z1, "
        "CAST(floor(s_suppkey / g) AS BIGINT)*cell AS y0, CAST(floor(s_suppkey / g) AS BIGINT)*cell+3 AS y1, "
        "(s_suppkey % g)*cell AS x0, (s_suppkey % g)*cell+3 AS x1 FROM supplier CROSS JOIN fx_lat",
    ),
    "fx_labels": (
        ("fx_seeds", "fx_digits"),
        "SELECT s.label, dz.i AS z, s.y0+dy.i AS y, s.x0+dx.i AS x FROM fx_seeds s CROSS JOIN fx_digits dz "
        "CROSS JOIN fx_digits dy CROSS JOIN fx_digits dx "
        "WHERE dz.i >= s.z0 AND dz.i < s.z1 AND dy.i < 3 AND dx.i < 3",
    ),
    "fx_nuclei": (
        ("fx_labels",),
        "SELECT label, min(z) AS min_z, min(y) AS min_y, min(x) AS min_x, max(z)+1 AS max_z, max(y)+1 AS max_y, "
        "max(x)+1 AS max_x, count(*) AS area, avg(z) AS cz, avg(y) AS cy, avg(x) AS cx FROM fx_labels "
        "GROUP BY label HAVING count(*) >= 18",
    ),
    "fx_tiles": (
        (),
        "SELECT CAST(s_suppkey AS BIGINT) AS tile, CAST(s_suppkey % 5 AS BIGINT)*12 AS ox, "
        "CAST(floor(s_suppkey / 5) AS BIGINT)*12 AS oy, CAST(0 AS BIGINT) AS oz FROM supplier",
    ),
    "fx_nation_tiles": (
        (),
        "SELECT CAST(n_nationkey AS BIGINT) AS tile, CAST(n_nationkey % 5 AS BIGINT)*12 AS ox, "
        "CAST(floor(n_nationkey / 5) AS BIGINT)*12 AS oy, CAST(0 AS BIGINT) AS oz FROM nation",
    ),
    "fx_tile_voxels": (
        (),
        "SELECT CAST(l_suppkey AS BIGINT) AS tile, CAST(l_linenumber-1 AS BIGINT) AS z, l_orderkey % 16 AS y, "
        "l_partkey % 16 AS x, CAST(max(CAST(floor(l_extendedprice) AS BIGINT) % 65536) AS BIGINT) AS value "
        "FROM lineitem GROUP BY l_suppkey, l_linenumber, l_orderkey % 16, l_partkey % 16",
    ),
    "fx_tile_dense": (
        ("fx_tiles", "fx_tile_voxels"),
        "SELECT g.tile, g.z, g.y, g.x, coalesce(v.value, 0) AS value FROM (SELECT tile, z, y, x FROM fx_tiles, "
        "range(7) a(z), range(16) b(y), range(16) c(x)) g LEFT JOIN fx_tile_voxels v USING (tile, z, y, x)",
    ),
    "fx_ledger": (
        (),
        "SELECT event_id, ts, concat('step_', CAST(user_id AS VARCHAR(20))) AS step_id, CASE event_type "
        "WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'completed' "
        "WHEN 'error' THEN 'failed' END AS status FROM events",
    ),
    "fx_points": (
        (),
        "SELECT c_custkey AS pid, CAST(c_custkey % 50 AS DOUBLE) AS z, CAST(c_nationkey AS DOUBLE) AS y, "
        "CAST(floor(c_acctbal/100) AS DOUBLE) AS x FROM customer",
    ),
}


def with_views(names: str, body: str, extra: list[tuple[str, str]] = (), recursive: bool = False) -> str:
    """DuckDB text: the named views (and what they need) as CTEs in front of ``body``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for dep in VIEWS[name][0]:
            add(dep)
        ordered.append(name)

    for name in names.split():
        add(name)
    ctes = [f"{name} AS ({VIEWS[name][1]})" for name in ordered]
    ctes += [f"{head} AS ({sql})" for head, sql in extra]
    if not ctes:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def volume_shape(spark: SparkSession, sf_dir: str) -> Shape:
    """Catalog lookup of the volume extent (a count answered from Parquet footers)."""
    side = math.isqrt(table(spark, sf_dir, "part").count())
    return Shape(DEPTH, side, side)


def voxels(spark: SparkSession, sf_dir: str, shape: Shape | None = None) -> DataFrame:
    side = (shape or volume_shape(spark, sf_dir)).nx
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_linestatus").alias("round"),
            F.col("l_returnflag").alias("channel"),
            (F.col("l_linenumber") - 1).cast("bigint").alias("z"),
            (F.col("l_orderkey") % side).alias("y"),
            (F.col("l_partkey") % side).alias("x"),
            (F.floor("l_extendedprice").cast("bigint") % 65536).alias("value"),
        )
        .groupBy("round", "channel", "z", "y", "x")
        .agg(F.max("value").alias("value"))
    )


def seeds(spark: SparkSession, sf_dir: str, shape: Shape | None = None) -> DataFrame:
    side = (shape or volume_shape(spark, sf_dir)).nx
    supplier = table(spark, sf_dir, "supplier")
    g = math.ceil(math.sqrt(supplier.count()))
    cell = side // g
    row = F.floor(F.col("s_suppkey") / g).cast("bigint") * cell
    col = (F.col("s_suppkey") % g) * cell
    return supplier.select(
        (F.col("s_suppkey") + 1).alias("label"),
        (3 - F.col("s_suppkey") % 3).alias("z0"),
        (4 + F.col("s_suppkey") % 2).alias("z1"),
        row.alias("y0"),
        (row + 3).alias("y1"),
        col.alias("x0"),
        (col + 3).alias("x1"),
    )


def labels(spark: SparkSession, sf_dir: str, shape: Shape | None = None) -> DataFrame:
    out = seeds(spark, sf_dir, shape)
    for axis in ("z", "y", "x"):
        out = out.withColumn(axis, F.explode(F.sequence(F.col(f"{axis}0"), F.col(f"{axis}1") - 1)))
    return out.select("label", "z", "y", "x")


def _grid(rows: DataFrame, key: str) -> DataFrame:
    """Overlapping tiles in rows of five."""
    return rows.select(
        F.col(key).cast("bigint").alias("tile"),
        ((F.col(key) % 5) * 12).cast("bigint").alias("ox"),
        (F.floor(F.col(key) / 5) * 12).cast("bigint").alias("oy"),
        F.lit(0).cast("bigint").alias("oz"),
        *[F.lit(n).cast("bigint").alias(f"d{a}") for a, n in zip("zyx", TILE_SHAPE)],
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile per supplier; its voxels are the line items of that supplier."""
    return _grid(table(spark, sf_dir, "supplier"), "s_suppkey")


def nation_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile per nation, for placement."""
    return _grid(table(spark, sf_dir, "nation"), "n_nationkey")


def tile_voxels(spark: SparkSession, sf_dir: str, channel: bool = False) -> DataFrame:
    keys = ["tile", "z", "y", "x"]
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("bigint").alias("tile"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("z"),
        (F.col("l_orderkey") % 16).alias("y"),
        (F.col("l_partkey") % 16).alias("x"),
        (F.floor("l_extendedprice").cast("bigint") % 65536).alias("value"),
        *([F.col("l_returnflag").alias("channel")] if channel else []),
    )
    return li.groupBy(*(["channel"] if channel else []), *keys).agg(F.max("value").alias("value"))


def event_status() -> Column:
    """Status of a step that an event of the test tables stands for."""
    kind = F.col("event_type")
    return (
        F.when(kind.isin("signup", "view"), "pending")
        .when(kind == "click", "in_progress")
        .when(kind == "purchase", "completed")
        .when(kind == "error", "failed")
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(table(spark, sf_dir, "events"))


def log_rows(events: DataFrame) -> DataFrame:
    step = F.concat(F.lit("step_"), F.col("user_id"))
    return events.select("event_id", "ts", step.alias("step_id"), event_status().alias("status"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pid"),
        (F.col("c_custkey") % 50).cast("double").alias("z"),
        F.col("c_nationkey").cast("double").alias("y"),
        F.floor(F.col("c_acctbal") / 100).cast("double").alias("x"),
    )
