"""Synthetic volumes for trials: ellipsoid nuclei, a nuclear stain and epitope channels.

Randomness is a hash of the voxel position, object and seed, so values do not depend on
partitioning or retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.model import AXES, Shape

# Fixed values of the synthetic intensity model.
DROPOUT = 0.3
STAIN_LEVEL, STAIN_SPREAD, STAIN_NOISE = (8000.0, 16000.0), (0.7, 1.3), 200.0
EPITOPE_LEVEL, EPITOPE_SPREAD, EPITOPE_NOISE = (6000.0, 14000.0), (0.5, 1.5), 300.0
EPITOPE_REACH = 3


def unit_hash(seed: int, *cols) -> Column:
    """Uniform value in [0, 1) derived from the given columns."""
    bits = F.xxhash64(F.lit(seed), *cols)
    return F.pmod(bits, F.lit(1 << 52)) / F.lit(float(1 << 52))


def _uniform(bounds: tuple[float, float], u: Column) -> Column:
    return F.lit(bounds[0]) + (F.lit(bounds[1]) - F.lit(bounds[0])) * u


def synth_labels(seeds: DataFrame, shape: Shape, dropout: float = DROPOUT, seed: int = 0) -> DataFrame:
    """Label voxels of ellipsoids ``label, cz, cy, cx, radius``; the largest label wins overlaps.

    Each ellipsoid is expanded from its own clipped box (radius is bounded), never compared
    with the whole grid.
    """
    flat = F.greatest(F.lit(2), F.floor(F.col("radius") / 2)).cast("bigint")
    radii = {"z": flat, "y": F.col("radius"), "x": F.col("radius")}
    out = seeds.withColumn("rz", flat)
    for a, n in zip(AXES, shape):
        lo = F.greatest(F.col(f"c{a}") - radii[a], F.lit(0).cast("bigint"))
        hi = F.least(F.col(f"c{a}") + radii[a], F.lit(n - 1).cast("bigint"))
        out = out.withColumn(a, F.explode(F.sequence(lo, hi)))
    inside = sum((F.pow((F.col(a) - F.col(f"c{a}")) / (F.col("rz") if a == "z" else F.col("radius")), 2) for a in AXES), F.lit(0.0))
    out = out.filter(inside <= 1)
    if dropout > 0:
        out = out.filter(unit_hash(seed, "label", *AXES) >= dropout)
    return out.groupBy(*AXES).agg(F.max("label").alias("label"))


def synth_stain(labels: DataFrame, seed: int = 0) -> DataFrame:
    """Nuclear stain: object level times voxel variation plus noise, clipped to uint16."""
    level = _uniform(STAIN_LEVEL, unit_hash(seed + 1, "label")) * _uniform(STAIN_SPREAD, unit_hash(seed + 2, *AXES))
    value = level + F.lit(STAIN_NOISE) * unit_hash(seed + 3, *AXES)
    return labels.select(*AXES, F.floor(F.least(value, F.lit(65535.0))).cast("bigint").alias("value"))


def synth_epitope(labels: DataFrame, shape: Shape, positive: float = 0.3, strength: float = 0.8, seed: int = 0) -> DataFrame:
    """Epitope channel: positive objects, widened by three voxels in y and x, largest label on top."""
    chosen = labels.filter(unit_hash(seed + 4, "label") < positive)
    reach = F.explode(F.sequence(F.lit(-EPITOPE_REACH).cast("bigint"), F.lit(EPITOPE_REACH).cast("bigint")))
    wide = (
        chosen.withColumn("sy", reach).withColumn("sx", F.explode(F.sequence(F.lit(-EPITOPE_REACH).cast("bigint"), F.lit(EPITOPE_REACH).cast("bigint"))))
        .select("z", (F.col("y") + F.col("sy")).alias("y"), (F.col("x") + F.col("sx")).alias("x"), "label")
        .filter((F.col("y") >= 0) & (F.col("y") < shape.ny) & (F.col("x") >= 0) & (F.col("x") < shape.nx))
        .groupBy(*AXES).agg(F.max("label").alias("label"))
    )
    level = _uniform(EPITOPE_LEVEL, unit_hash(seed + 5, "label")) * strength * _uniform(EPITOPE_SPREAD, unit_hash(seed + 6, *AXES))
    value = level + F.lit(EPITOPE_NOISE) * unit_hash(seed + 7, *AXES)
    return wide.select(*AXES, F.floor(F.least(value, F.lit(65535.0))).cast("bigint").alias("value"))
