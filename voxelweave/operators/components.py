"""Connected components and block-wise segmentation with cross-block label stitching."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelweave.functions.columns import linear_index
from voxelweave.functions.kernels import local_components
from voxelweave.functions.ranking import global_rank
from voxelweave.functions.sizing import cut_lineage, written
from voxelweave.model import AXES, Shape
from voxelweave.operators.blocks import block_count, block_values, gaussian_smooth, neighbourhood, to_blocks

OTSU_BINS = 256
_INTERIOR, _RIM, _HALO = 0, 1, 2


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for an undirected edge list ``a, b``; the root is the smallest node reached.

    Alternating large-star / small-star contraction: every round joins each edge with the
    minimum of its neighbourhood, which is computed with partial aggregation. Rounds grow
    with the logarithm of the component size; each ends in a reliable checkpoint.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = cut_lineage(links)
    nodes = links.select(F.col("u").alias("node")).union(links.select("v")).distinct()
    state = _fingerprint(links)
    for _ in range(max_rounds):
        links = cut_lineage(_small_star(_large_star(links)))
        previous, state = state, _fingerprint(links)
        if state == previous:
            break
    else:
        raise RuntimeError("connected components did not converge")
    roots = links.filter("u <> v").select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u")).toDF("u", "v")
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    pointed = links.join(smallest, "u")
    own = smallest.select("u", F.col("m").alias("v"))
    others = pointed.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.union(others).filter("u <> v").distinct()


def label_blocks(
    blocks: DataFrame, shape: Shape, block: Shape, halo: int, fn: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """Label one volume block by block and stitch the labels: ``label, z, y, x``.

    ``fn`` maps a block widened by ``halo`` (0 beyond the volume) to integer labels. Labels of
    neighbouring blocks are the same object when they meet on a voxel that is core to one and
    halo to the other, so only rim voxels are joined. Final labels count 1..n in raster order
    of each object's first voxel.
    """
    grid = block_count(shape, block)

    def kernel(key, array, core):
        extent = [n - 2 * halo for n in array.shape]
        for axis, (c, e, n) in enumerate(zip(core, extent, shape)):
            keep = np.arange(c - halo, c + e + halo)
            shaped = [1, 1, 1]
            shaped[axis] = -1
            array = np.where(((keep >= 0) & (keep < n)).reshape(shaped), array, 0)
        labels = np.asarray(fn(array))
        where = np.nonzero(labels)
        inner = [np.minimum(w - halo, halo + e - 1 - w) for w, e in zip(where, extent)]
        depth = np.minimum.reduce(inner)
        ordinal = (int(key[2]) * grid.ny + int(key[3])) * grid.nx + int(key[4])
        frame = pd.DataFrame({a: w.astype(np.int64) - halo + c for a, w, c in zip(AXES, where, core)})
        frame["part"] = (ordinal << 32) + labels[where].astype(np.int64)
        frame["zone"] = np.where(depth < 0, _HALO, np.where(depth < halo, _RIM, _INTERIOR)).astype(np.int32)
        return frame

    rows = neighbourhood(
        blocks, shape, block, Shape(halo, halo, halo), kernel, "z bigint, y bigint, x bigint, part bigint, zone int"
    )
    rows = written(rows, "labelled-blocks")
    halo_rows = rows.filter(F.col("zone") == _HALO).withColumnRenamed("part", "a")
    rim_rows = rows.filter(F.col("zone") == _RIM).withColumnRenamed("part", "b")
    edges = halo_rows.join(rim_rows, list(AXES)).select("a", "b").distinct()
    roots = connected_components(edges)
    core = rows.filter(F.col("zone") != _HALO)
    firsts = core.groupBy("part").agg(F.min(linear_index(shape)).alias("first"))
    parts = firsts.join(roots, firsts["part"] == roots["node"], "left").select(
        "part", F.coalesce("root", "part").alias("root"), "first"
    )
    objects = global_rank(parts.groupBy("root").agg(F.min("first").alias("first")), "first", "label")
    mapping = parts.select("part", "root").join(objects.select("root", "label"), "root").select("part", "label")
    return core.join(mapping, "part").select("label", *AXES)


def label_components(mask: DataFrame, shape: Shape, block: Shape) -> DataFrame:
    """26-connected components of a binary mask volume (blocks)."""
    return label_blocks(mask, shape, block, 1, lambda array: local_components(array > 0))


def otsu_threshold(values: DataFrame, dense_size: int | None = None, bins: int = OTSU_BINS) -> DataFrame:
    """One row ``threshold``: centre of the histogram bin with the largest between-class variance.

    One aggregation to ``bins`` rows; the cumulative windows run over those rows only. With
    ``dense_size``, voxels without a row count as background 0.
    """
    lo, hi, stored = values.agg(F.min("value"), F.max("value"), F.count(F.lit(1))).first()
    absent = (dense_size or stored) - stored
    lo, hi = float(lo or 0), float(hi or 0)
    if absent > 0:
        lo, hi = min(lo, 0.0), max(hi, 0.0)
    width = F.lit((hi - lo) / bins)
    filled = values.select(F.col("value").cast("double").alias("value"), F.lit(1).cast("bigint").alias("n")).unionByName(
        values.sparkSession.createDataFrame([(0.0, absent)], "value double, n bigint").filter("n > 0")
    )
    index = F.least(F.floor(F.try_divide(F.col("value") - lo, width)).cast("int"), F.lit(bins - 1))
    hist = filled.groupBy(index.alias("bin")).agg(F.sum("n").alias("n"))
    lo = F.lit(lo)
    hist = hist.withColumn("centre", lo + (F.col("bin") + 0.5) * width)
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    mass = F.col("n") * F.col("centre")
    curve = hist.select(
        "bin", "centre",
        F.sum("n").over(below).alias("n0"), F.sum("n").over(above).alias("n1"),
        F.sum(mass).over(below).alias("s0"), F.sum(mass).over(above).alias("s1"),
    )
    gap = F.col("s0") / F.col("n0") - F.col("s1") / F.col("n1")
    scored = curve.withColumn("score", F.round(F.col("n0") * F.col("n1") * gap * gap, 2))
    best = F.max_by("centre", F.struct(F.coalesce("score", F.lit(-1.0)), -F.col("bin")))
    return scored.agg(best.alias("threshold"))


def segment_blocks(
    blocks: DataFrame, shape: Shape, block: Shape, sigma: float = 2.0, halo: int = 4,
    fn: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Segment one volume: smooth, label each block with ``fn``, stitch; ``label, z, y, x``.

    The default segmenter thresholds at the global Otsu level and takes connected components.
    """
    smoothed = gaussian_smooth(blocks, shape, block, sigma) if sigma else blocks
    if fn is None:
        smoothed = written(smoothed, "smoothed-blocks")
        level = otsu_threshold(block_values(smoothed), shape.size).first()[0]
        halo = max(1, halo)

        def fn(array, level=level):
            return local_components(array > level)

    return label_blocks(smoothed, shape, block, halo, fn)


def relabel_if_binary(labels: DataFrame, shape: Shape, block: Shape) -> DataFrame:
    """A mask whose largest label is 1 is split into its connected components."""
    top = labels.agg(F.max("label")).first()[0]
    if top is None or top > 1:
        return labels
    volume = labels.filter("label > 0").select(
        F.lit("mask").alias("round"), F.lit("mask").alias("channel"), *AXES, F.lit(1).alias("value")
    )
    return label_components(to_blocks(volume, shape, block, "uint8"), shape, block)
