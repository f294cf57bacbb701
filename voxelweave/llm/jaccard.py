"""Groups of texts whose sets of word shingles have a Jaccard likeness of at least a bound.

Candidates come from two sources, and each pair counts by its exact likeness only. Fingerprints (:mod:`simhash`, over the same shingles) at
four or fewer differing bits make components, and all texts of a component meet under its key. Four bits miss part of the pairs at
0.8, so texts also meet under ``BANDS`` keys of ``ROWS`` minima each; a pair at 0.8 meets in none with probability 1e-7. Each
text is first compared with the lowest of its component and with one other: of the lowest texts of its bands, the one that most of
them have. So a large group of copies makes one pair a text, or two where the sources differ. Then the keys of both kinds whose
texts are not yet in one group are scanned twice. The first scan marks the texts that have a partner of another group whose size and minima leave 0.8 possible (the
minima of a pair at 0.8 agree in less than ``LEAST`` of their places with probability 1e-6). The second gets the sets of those,
once per key and not per pair, and compares all such pairs exactly; of a run it gives out the links of a spanning forest only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import written
from voxelweave.llm.graph import connected_components
from voxelweave.llm.passages import word_hashes
from voxelweave.llm.simhash import near_duplicates

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 5
LEAST = 0.66  # share of equal minima below which a pair is not compared; 0.8 less five deviations of BANDS * ROWS draws
RUN_LIMIT = 4_096
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = np.random.default_rng(6).integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all ``width`` neighbouring words; of all words where there are fewer; 0 without words."""
    hashes = word_hashes(text)
    if not len(hashes):
        return np.zeros(1, np.uint64)
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    mixed = hashes[:n].copy()
    for i in range(1, width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def minima(found: np.ndarray) -> np.ndarray:
    """Least values of a set under ``BANDS * ROWS`` hash functions."""
    lowest = np.full((BANDS * ROWS, 1), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        part = (found[at : at + 4096] ^ _OFFSETS) * _FACTORS
        lowest = np.minimum(lowest, part.min(1, keepdims=True))
    return lowest


def band_keys(lowest: np.ndarray) -> np.ndarray:
    """Keys of minima, ``ROWS`` at a time."""
    lowest = lowest.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = (keys ^ (keys >> np.uint64(29))) * _MIX + lowest[:, i]
    return keys.view(np.int64)


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of each set, a byte of each of its minima, and its keys."""
    for batch in batches:
        sizes, sketches, keys = [], [], []
        for text in batch.column(1):
            found = shingles(text.as_py())
            lowest = minima(found)
            sizes.append(len(found))
            sketches.append(((lowest * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes())
            keys.append(band_keys(lowest))
        arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["node", "size", "sketch", "keys"])


def _near(sizes: np.ndarray, sketches: np.ndarray, roots: np.ndarray, i: int, similarity: float) -> np.ndarray:
    """Rows after ``i`` of other roots that may be as similar to it as asked, by size and equal minima."""
    small, large = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
    near = i + 1 + np.flatnonzero((small >= similarity * large - 1e-9) & (roots[i + 1 :] != roots[i]))
    # Two different minima have the same byte once in 256.
    least = (LEAST - 0.8 + similarity) * (1 - 1 / 256) * BANDS * ROWS
    return near[(sketches[near] == sketches[i]).sum(1) >= least]


def _run(rows: pa.Table) -> tuple[np.ndarray, ...]:
    nodes, roots, sizes = (rows[c].to_numpy() for c in ("node", "root", "size"))
    return nodes, roots, sizes, np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(len(nodes), -1)


def _marked(rows: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Key and node of the rows of a run that have a possible partner."""
    nodes, roots, sizes, sketches = _run(rows)
    found = np.zeros(len(nodes), bool)
    for i in range(len(nodes) - 1):
        near = _near(sizes, sketches, roots, i, similarity)
        found[near] = True
        found[i] |= len(near) > 0
    return rows["key"].to_numpy()[found], nodes[found]


def _linked(rows: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a run that join its roots as far as any pair at the bound does."""
    nodes, roots, sizes, sketches = _run(rows)
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows["found"]]
    above = {r: r for r in roots.tolist()}
    links = []

    def top(root: int) -> int:
        while above[root] != root:
            above[root] = root = above[above[root]]
        return root

    for i in range(len(nodes) - 1):
        for j in _near(sizes, sketches, roots, i, similarity).tolist():
            a, b = top(int(roots[i])), top(int(roots[j]))
            if a != b and _alike_sets(sets[i], sets[j], similarity):
                above[a] = b
                links.append((nodes[i], nodes[j]))
    return tuple(np.array([x[k] for x in links], np.int64) for k in (0, 1))


def _scan_task(scan, names: tuple[str, str], similarity: float):
    """What ``scan`` finds in the runs of equal keys of sorted rows; a run is at most about ``RUN_LIMIT`` rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _and_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not len(held):
                continue
            keys = held["key"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
            ends = [*starts[1:], len(keys)]
            if batch is not None:  # the last run may go on in the next batch
                starts, ends = starts[:-1], ends[:-1]
            found = [scan(held.slice(s, e - s), similarity) for s, e in zip(starts, ends)]
            held = held.slice(ends[-1]) if ends else held
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names=list(names))

    return task


def _and_end(batches):
    yield from batches
    yield None


def _set_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["node", "found"])


def _alike_sets(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


def _like_task(similarity: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column(2), batch.column(3)):
                alike.append(_alike_sets(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), similarity))
            kept = batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))
            yield kept

    return task


def _alike(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs (a, b)`` at or above ``similarity``."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = written(texts.join(ends, "node").mapInArrow(_set_task, "node long, found binary"), "shingles")
    for end in "ab":
        pairs = pairs.join(sets.toDF(end, f"{end}_found"), end)
    rows = pairs.select("a", "b", "a_found", "b_found")
    return written(rows.mapInArrow(_like_task(similarity), "a long, b long"), "alike")


def _sharing(sketched: DataFrame) -> DataFrame:
    """``(key, node, hub)`` of the keys that several nodes have; the hub is the lowest of them."""
    bands = sketched.select("node", F.explode("keys").alias("key"))
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    return bands.join(written(hubs.select("key", "hub"), "band-hubs"), "key")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows ``(key, node, root, ...)`` with runs beyond ``RUN_LIMIT`` dealt as pairs of blocks under new keys."""
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / (RUN_LIMIT // 2)).alias("blocks"))
    sizes = sizes.where("blocks > 2")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    wide = rows.join(written(sizes, "long-runs"), "key", "left")
    small = wide.where("blocks is null").drop("blocks")
    large = wide.where("blocks is not null").select("*", block.alias("block")).select("*", other)
    key = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key")
    return small.unionByName(large.select(*(c for c in small.columns if c != "key"), key))


def _marked_alike(texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of the lowest text of each component of near fingerprints with every other one of it."""
    marked = near_duplicates(texts, "node", "text", WIDTH).where("component_id < doc_id")
    return marked.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))


def _components(marked: DataFrame) -> DataFrame:
    """``(key, node)`` of all texts of each component in ``marked (a, b)``, its lowest one with it."""
    key = F.xxhash64(F.lit("component"), "a").alias("key")
    return marked.select(key, F.col("b").alias("node")).union(marked.select(key, "a").distinct())


def groups(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(node, root)`` of every node of ``texts (node, text)`` (distinct nodes) that is linked to another.

    Texts without words are like each other. An empty table gives an empty result.
    """
    sketched = texts.mapInArrow(_sketch_task, "node long, size long, sketch binary, keys array<long>")
    sketched = written(sketched, "sketches")
    shared = written(_sharing(sketched), "shared-bands")
    seen = shared.where("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    marked = written(_marked_alike(texts).select("a", "b"), "near-fingerprints")
    best = seen.groupBy("node").agg(F.max(F.struct("n", (-F.col("hub")).alias("low"))).alias("best"))
    first = best.select((-F.col("best.low")).alias("a"), F.col("node").alias("b")).union(marked).distinct()
    links = _alike(texts, written(first, "first-pairs"), similarity)
    roots = written(connected_components(links), "first-roots")
    root = F.coalesce("root", "node").alias("root")
    met = shared.select("key", "node").unionByName(_components(marked))
    placed = met.join(roots, "node", "left").select("key", "node", root)
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    apart = written(placed.join(written(mixed.select("key"), "mixed-keys"), "key"), "mixed-bands")
    dealt = written(_dealt(apart).select("key", "node", "root"), "dealt-bands")

    def scanned(rows: DataFrame, scan, names: tuple[str, str]) -> DataFrame:
        runs = rows.repartition("key").sortWithinPartitions("key", "node")
        return runs.mapInArrow(_scan_task(scan, names, similarity), ", ".join(f"{n} long" for n in names))

    sketches = sketched.select("node", "size", "sketch")
    marked = written(scanned(dealt.join(sketches, "node"), _marked, ("key", "node")), "open-bands")
    wanted = marked.select("node").distinct()
    sets = written(texts.join(wanted, "node").mapInArrow(_set_task, "node long, found binary"), "open-shingles")
    open_rows = dealt.join(marked, ["key", "node"]).join(sketches.join(sets, "node"), "node")
    return connected_components(links.union(scanned(open_rows, _linked, ("a", "b"))))
