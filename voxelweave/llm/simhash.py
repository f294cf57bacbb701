"""Near-duplicate documents by SimHash fingerprints and a byte-position inverted index.

Fingerprints within ``max_bits`` differing bits agree in at least ``8 - max_bits`` of their 8 bytes, as each
differing bit spoils one byte. The index therefore lists every fingerprint under each set of that many positions with
its bytes there; a pair that meets in any list has reached the guaranteed count of shared positional bytes, every pair
within the distance meets in at least one, and each pair that meets is verified bit by bit. (Lists of single positional
bytes would each hold a 256th of all fingerprints; sets of four hold about one in 2^32.)

Only distinct fingerprints enter the index, so copies cost nothing there. A list is scanned as one sorted run; from a run of
close fingerprints only a spanning forest is given out, never all pairs. A run longer than ``RUN_LIMIT`` is dealt as
pairs of blocks to further tasks, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import texts_of, written
from voxelweave.llm.graph import connected_components

RUN_LIMIT = 20_000
SEED = 42
_COLUMN = (np.arange(8) * 256).astype(np.int64)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, width: int = 4) -> int:
    """Majority bits of the 64-bit hashes of all word shingles; 0 without words."""
    words = text.encode().lower().split()  # on bytes both know ASCII only: A-Z, and 0x20, 0x09-0x0D
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: len(words) - width].tolist()]
        shingles = [line[s:e] for s, e in zip(starts, (ends[width - 1 :] - 1).tolist())]
    n = len(shingles)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    tally = np.bincount((hashes.view(np.uint8).reshape(n, 8) + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(tally * 2 > n, axis=1, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """``(doc_id, fp)`` of every row; one map over whole texts, null text as empty."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), width) for text in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return texts_of(docs, id_col, text_col).mapInArrow(task, "doc_id long, fp long")


def _differing(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one run: breadth first, each member compared with the unreached only."""
    links, left = [], np.unique(fps)
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = _differing(left, at) <= max_bits
            if near.any():
                frontier += list(left[near])
                links += [(at, other) for other in left[near]]
                left = left[~near]
    return links


def _links_in_runs(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Links inside the runs of equal keys (sorted), as an ``(n, 2)`` array."""
    found = []
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    small = np.repeat(sizes <= 8, sizes)
    k, f = keys[small], fps[small]
    for lag in range(1, 8):
        same = k[lag:] == k[:-lag]
        if not same.any():
            break
        a, b = f[:-lag][same], f[lag:][same]
        near = (_differing(a, b) <= max_bits) & (a != b)
        found.append(np.stack([a[near], b[near]], 1))
    for s, n in zip(starts[sizes > 8], sizes[sizes > 8]):
        found.append(np.array(_forest(fps[s : s + n], max_bits), np.int64).reshape(-1, 2))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _scan(max_bits: int, limit: int | None):
    """Task over rows ``(key, fp)`` sorted by key: links, and rows of runs beyond ``limit`` marked as deferred."""

    def out(deferred: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        mark = pa.array(np.full(len(a), deferred))
        return pa.RecordBatch.from_arrays([mark, pa.array(a), pa.array(b)], names=["deferred", "a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.empty(0, np.int64)
        passing = None  # key of the run that is being deferred
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if passing is not None:
                n = int(np.searchsorted(keys != passing, True))
                yield out(True, keys[:n], fps[:n])
                keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    continue
                passing = None
            cut = int(np.searchsorted(keys == keys[-1], True))  # keys are sorted: the last run stays open
            if cut:
                links = _links_in_runs(keys[:cut], fps[:cut], max_bits)
                yield out(False, links[:, 0], links[:, 1])
                keys, fps = keys[cut:], fps[cut:]
            if limit and len(keys) > limit:
                yield out(True, keys, fps)
                passing, keys, fps = keys[0], keys[:0], fps[:0]
        if len(keys):
            links = _links_in_runs(keys, fps, max_bits)
            yield out(False, links[:, 0], links[:, 1])

    return task


def near_links(fps: DataFrame, max_bits: int = 4, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that join the fingerprints ``fp`` (distinct) into their components at ``max_bits``."""
    positions = combinations(range(8), 8 - max_bits)
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in positions]
    signed = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m) for m in masks))
    listed = fps.select("fp", F.posexplode(signed).alias("set", "mask")).select(
        F.xxhash64("set", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp"
    )
    schema = "deferred boolean, a long, b long"
    found = listed.repartition("key").sortWithinPartitions("key").mapInArrow(_scan(max_bits, run_limit), schema)
    found = written(found, "byte-index")
    large = found.where("deferred")
    blocks = large.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / run_limit).alias("blocks"))
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block")
    dealt = large.join(blocks, "a").select("a", "b", block, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    pair = F.xxhash64("a", F.least("block", "o"), F.greatest("block", "o")).alias("key")
    more = dealt.select(pair, F.col("b").alias("fp")).repartition("key").sortWithinPartitions("key")
    links = found.where("not deferred").union(more.mapInArrow(_scan(max_bits, None), schema))
    return links.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that links of at most ``max_bits`` differing bits reach. Null and empty
    texts, and texts of white space, have fingerprint zero and link like any other. Rows with a null id get a
    component but never name one (null where no other id is in it). Repeated rows repeat; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = written(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(near_links(distinct.select("fp"), max_bits))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = written(placed.select("fp", "first", F.coalesce("root", "fp").alias("root")), "placed")
    # Written, so that the join shuffles both sides and a very large component can be split.
    ids = written(placed.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = written(placed.join(ids, "root").select("fp", "component_id"), "components")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", hexed, "component_id")
