"""Benchmark decontamination: exact containment of item windows in documents by a prefix-filtered join of shingles.

An item is cut into windows of ``WINDOW`` neighbouring words (a shorter item is one window of its size), a window into shingles
of ``SHINGLE`` words. The corpus is read once to count the shingles that occur in windows; by these counts the shingles of a
window are ordered by rarity. A window is contained in a document only if all its shingles are, so the necessary prefix is
the rarest one: a window with a shingle that never occurs is out, and only occurrences of rarest shingles are joined. Positional
bound: the shingle's place in the window fixes where the window begins in the document; length bound: the document has the words
before and after. What passes is verified word by word.

Documents are read twice by maps that emit little; nothing but two bit filters of ``FILTER_BITS`` bits is sent to every task, at
any size of either table (a fuller filter lets more rows into the exact join). Equal texts are joined and verified once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelweave.llm.common import texts_of, written
from voxelweave.llm.words import Words, slices

WINDOW, SHINGLE = 10, 5
FILTER_BITS = 1 << 24
_MASK = np.uint64(FILTER_BITS - 1)
NO_ITEMS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = hashes.view(np.uint64)
    return (wide >> np.uint64(8)) & _MASK, (wide >> np.uint64(36)) & _MASK


def bit_filter(shingles: DataFrame) -> np.ndarray:
    """Bits of all values of the column ``shingle``, combined in tasks; ``FILTER_BITS`` bits whatever the rows are."""
    span = f"{FILTER_BITS - 1}L"
    places = F.expr(f"explode(array(shiftrightunsigned(shingle, 8) & {span}, shiftrightunsigned(shingle, 36) & {span}))")
    bits = shingles.select(places.alias("place")).selectExpr("shiftright(place, 6) AS cell", "place & 63 AS bit")
    found = bits.groupBy("cell").agg(F.expr("bit_or(shiftleft(1L, CAST(bit AS INT)))").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    first, second = _places(hashes)
    at = np.flatnonzero(bits[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8) & 1)
    second = second[at]
    return at[(bits[second >> np.uint64(3)] >> (second & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]


def _window_task(window: int, shingle: int):
    """Windows of items: their words, their number, and the hashes of their shingles in order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for lo, hi, words in slices(batch.column(1)):
                hashed = {}
                for k in range(1, shingle + 1):
                    at, values = words.shingles(k)
                    hashed[k] = dict(zip(at.tolist(), values.tolist()))
                for i, (first, n) in enumerate(zip(words.firsts.tolist(), words.counts().tolist())):
                    size = min(window, n)
                    k = min(shingle, size)
                    for at in range(first, first + n - size + 1 if n else first):
                        text = words.text(at, at + size).decode()
                        out.append((ids[lo + i], text, size, k, [hashed[k][x] for x in range(at, at + size - k + 1)]))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            columns = list(zip(*out)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "window", "size", "width", "shingles"])

    return task


def _count_task(bits, widths: list[int]):
    """Counts of the shingles that the filter lets pass, per batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for _, _, words in slices(batch.column(1)):
                for width in widths:
                    _, hashes = words.shingles(width)
                    found.append(hashes[_passes(bits.value, hashes)])
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["shingle", "n"])

    return task


SPOT = pa.list_(pa.struct([("shingle", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("words", pa.string())]))


def _spots(words: Words, bits: np.ndarray, widths: list[int], window: int, shingle: int) -> dict[int, list[dict]]:
    """Occurrences of rarest shingles by text: hash, word position, and the words around that a window could take."""
    out: dict[int, list[dict]] = {}
    for width in widths:
        at, hashes = words.shingles(width)
        kept = _passes(bits, hashes)
        at, hashes = at[kept], hashes[kept]
        rows = np.searchsorted(words.firsts, at, "right") - 1
        more = window - shingle if width == shingle else 0
        lows, highs = np.maximum(words.firsts[rows], at - more), np.minimum(words.firsts[rows + 1], at + width + more)
        for row, spot, key, lo, hi in zip(rows.tolist(), at.tolist(), hashes.tolist(), lows.tolist(), highs.tolist()):
            spot_words = words.text(lo, hi).decode()
            found = {"shingle": key, "pos": spot - int(words.firsts[row]), "before": spot - lo, "words": spot_words}
            out.setdefault(row, []).append(found)
    return out


def _spot_task(bits, widths: list[int], window: int, shingle: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [xxhash.xxh3_128_digest(text.as_buffer()) for text in batch.column(1)]
            counts, spots = np.empty(batch.num_rows, np.int64), [None] * batch.num_rows
            for lo, hi, words in slices(batch.column(1)):
                counts[lo:hi] = words.counts()
                for row, found in _spots(words, bits.value, widths, window, shingle).items():
                    spots[lo + row] = found
            arrays = [batch.column(0), pa.array(keys, pa.binary()), pa.array(counts), pa.array(spots, SPOT)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "node", "n_words", "spots"])

    return task


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``item_id, window, size, width, shingles`` of every window of every item; items without words have none."""
    rows = texts_of(items, id_col, text_col)
    schema = "item_id long, window string, size int, width int, shingles array<long>"
    return rows.mapInArrow(_window_task(window, min(SHINGLE, window)), schema)


def find_windows(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """All documents as ``(doc_id, node, n_words)`` and the occurrences of windows as ``(node, start, size, window)``.

    ``node`` is a 128-bit hash of the text.
    """
    spark, shingle = docs.sparkSession, min(SHINGLE, window)
    rows = texts_of(docs, id_col, text_col)
    once = windows.groupBy("window").agg(*(F.any_value(c).alias(c) for c in ("size", "width", "shingles")))
    once = written(once, "windows")
    parts = once.select("window", "size", F.posexplode("shingles").alias("offset", "shingle"))
    widths = sorted(r["width"] for r in once.select("width").distinct().collect())
    every = spark.sparkContext.broadcast(bit_filter(parts))
    counts = rows.mapInArrow(_count_task(every, widths), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    # Documents may hold a shingle very often; the counts are one row per shingle of the items.
    counts = written(counts.join(parts.select("shingle").distinct(), "shingle", "left_semi"), "shingle-counts")
    ranked = parts.join(counts, "shingle", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("low")
    prefix = ranked.groupBy("window", "size").agg(rarest).where("low.n > 0").select("window", "size", "low.shingle", "low.offset")
    prefix = written(prefix, "prefixes")

    chosen = spark.sparkContext.broadcast(bit_filter(prefix))
    schema = "doc_id long, node binary, n_words long, spots array<struct<shingle: long, pos: int, before: int, words: string>>"
    scanned = written(rows.mapInArrow(_spot_task(chosen, widths, window, shingle), schema), "spots")
    spots = scanned.where("spots is not null").select("node", "n_words", F.explode("spots").alias("spot"))
    spots = spots.select("node", "n_words", "spot.*").dropDuplicates(["node", "pos", "shingle"])
    # Both sides are written, so that the join of a very common shingle can be split.
    met = written(spots, "distinct-spots").join(prefix, "shingle")
    fits = (F.col("before") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("size") <= F.col("n_words"))
    begin = F.greatest(F.col("before") - F.col("offset"), F.lit(0)) + 1
    same = F.array_join(F.slice(F.split("words", " "), begin, F.col("size")), " ") == F.col("window")
    start = (F.col("pos") - F.col("offset")).cast("long").alias("start")
    found = met.where(fits).where(same).select("node", start, F.col("size").cast("long").alias("size"), "window").distinct()
    return scanned.select("doc_id", "node", "n_words"), written(found, "found-windows")


def _items_of(found: DataFrame, windows: DataFrame) -> DataFrame:
    """``(node, n_items, items_sha256)``: items with windows in a text.

    Windows of the same items are one class, and texts with the same classes are worked out once, so that a window that
    many items and many texts share does not make their product.
    """
    held = found.select("node", "window").distinct()
    used = windows.where("item_id is not null").join(found.select("window").distinct(), "window", "left_semi")
    items = F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    listed = used.groupBy("window").agg(items).withColumn("class", F.sha2(F.array_join("items", ","), 256))
    listed = written(listed, "window-items")
    classes = F.array_sort(F.collect_set("class")).alias("classes")
    texts = written(held.join(listed.select("window", "class"), "window").groupBy("node").agg(classes), "text-classes")
    sets = listed.groupBy("class").agg(F.any_value("items").alias("items"))
    groups = texts.select("classes").distinct().select("classes", F.explode("classes").alias("class")).join(sets, "class")
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    named = groups.groupBy("classes").agg(merged).select("classes", F.size("items").cast("long").alias("n_items"), digest)
    return texts.join(written(named, "item-lists"), "classes").select("node", "n_items", "items_sha256")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it lies in any occurrence of a window of any item; ``n_items`` counts the items (distinct ids) with such
    windows and ``items_sha256`` digests their ids, sorted as strings and joined by commas (of nothing: the digest of an empty
    text). ``contaminated``: ``n_hit > 0``. Null and empty texts have no words. Rows with a null document id stay; an item without
    an id marks words and is not listed. Repeated rows repeat; items of one id are one item. No documents: an empty
    result; no items: no hits. Other columns of either table are ignored.
    """
    windows = written(item_windows(items, item_col, item_text_col, window), "item-windows")
    scanned, found = find_windows(docs, windows, id_col, text_col, window)
    end = F.col("start") + F.col("size")
    before = Window.partitionBy("node").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = F.greatest(F.lit(0), end - F.greatest("start", reached)).alias("fresh")
    spans = found.select("node", "start", "size").distinct().select("node", fresh)
    hits = written(spans.groupBy("node").agg(F.sum("fresh").alias("n_hit")), "hit-words")
    result = scanned.join(hits, "node", "left").join(written(_items_of(found, windows), "hit-items"), "node", "left")
    return result.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.lit(NO_ITEMS)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


#: The same over whole tables in plain SQL, every window against every run of as many words.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
bp AS (SELECT item_id, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS p FROM bs),
bw AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS win FROM bp),
ds AS (SELECT d.rid, d.w, s.size FROM d JOIN (SELECT DISTINCT size FROM bw) s ON len(d.w) >= s.size),
dp AS (SELECT rid, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS p FROM ds),
dw AS (SELECT rid, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS win FROM dp),
hit AS (SELECT DISTINCT rid, p, size, win FROM dw WHERE win IN (SELECT win FROM bw)),
spot AS (SELECT DISTINCT rid, unnest(range(p, CAST(p + size AS BIGINT))) AS p FROM hit),
n AS (SELECT rid, count(*) AS n_hit FROM spot GROUP BY rid),
i AS (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit JOIN bw ON hit.win = bw.win AND hit.size = bw.size WHERE item_id IS NOT NULL),
l AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM i GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN l USING (rid)
"""
