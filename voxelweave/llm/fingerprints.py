"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

Every distinct paragraph digest is added to one cell of each of three subtables: a count, the XOR of the digests and the
sum of their check hashes. The sketches of two versions subtract cell by cell, so common paragraphs cancel; cells left
with a single digest are peeled, round by round, until all differing digests are recovered or no cell yields one. On
failure the comparison is retried with sketches ``GROWTH`` times larger. The likeness of two versions is the share of common
digests in all their digests (Jaccard), from the number of recovered ones.

A paragraph is a line, a long line being cut at sentence ends after 120 characters, and after 600 at the latest.

Only built-in functions are used. Text is shuffled once, by ranges of ids, for each document to meet its successor;
the ranges come from quantiles, and the first document of each range is added to the range that precedes it. All later steps
work on digests, dealt once per attempt by row: cell sums and peeling rounds need no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelweave.llm.common import shuffle_parts, written

CELLS = 18  # of the fingerprint itself, in three subtables
GROWTH = 16
PEEL_ROUNDS = 6
PARAGRAPH = r"[^\n]{120,600}?[.!?]+(?=\s)|[^\n]{1,600}"
_LEAST = -(1 << 63)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _cells(key: Column, cells: int, sign) -> Column:
    """The three signed cell entries of one digest."""
    third = cells // 3
    return F.array(
        *(
            F.struct(
                (F.pmod(F.xxhash64(key, F.lit(j), F.lit(cells)), F.lit(third)) + j * third).cast("int").alias("cell"),
                (sign + F.lit(0)).cast("long").alias("n"),
                key.alias("key"),
                (sign * _check(key)).cast("long").alias("chk"),
            )
            for j in range(3)
        )
    )


def _summed(entries: DataFrame, *keys: str) -> DataFrame:
    sums = (F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.sum("chk").alias("chk"))
    return entries.groupBy(*keys, "cell").agg(*sums)


def peel(cells: DataFrame, rounds: int, size: int) -> DataFrame:
    """``(row, which, found, left)``: digests recovered and cells that stay non-empty, from summed difference cells.

    A row of ``cell`` -1 carries the number found so far in ``n``.
    """
    entry = F.struct("cell", "n", "key", "chk")
    for _ in range(rounds):
        state = cells.groupBy("row", "which").agg(F.collect_list(entry).alias("cells"))

        def pure(sign: int) -> Column:
            single = F.filter(
                "cells", lambda c: (c["cell"] >= 0) & (c["n"] == sign) & (c["chk"] == sign * _check(c["key"]))
            )
            return F.array_distinct(F.transform(single, lambda c: c["key"]))

        state = state.select("row", "which", "cells", pure(1).alias("plus"), pure(-1).alias("minus"))
        tally = F.struct(
            F.lit(-1).alias("cell"),
            (F.size("plus") + F.size("minus")).cast("long").alias("n"),
            F.lit(0).cast("long").alias("key"),
            F.lit(0).cast("long").alias("chk"),
        )
        taken = [
            F.flatten(F.transform("plus", lambda k: _cells(k, size, F.lit(-1)))),
            F.flatten(F.transform("minus", lambda k: _cells(k, size, F.lit(1)))),
        ]
        entries = state.select("row", "which", F.inline(F.concat("cells", F.array(tally), *taken)))
        empty = (F.col("n") == 0) & (F.col("key") == 0) & (F.col("chk") == 0)
        cells = _summed(entries, "row", "which").where((F.col("cell") == -1) | ~empty)
    found = F.sum(F.when(F.col("cell") == -1, F.col("n")).otherwise(0)).alias("found")
    return cells.groupBy("row", "which").agg(found, F.sum((F.col("cell") >= 0).cast("int")).alias("left"))


def _tagged(which: str, sign: int):
    return lambda key: F.struct(F.lit(which).alias("which"), key.alias("k"), F.lit(sign).alias("s"))


def _difference(rows: DataFrame, size: int) -> DataFrame:
    """Summed cells of the two comparisons of each row: edited and next."""
    parts = []
    for which, other in (("edited", "d_edited"), ("next", "d_next")):
        for column, sign in (("d_own", 1), (other, -1)):
            wanted = F.when(F.array_contains("open", which), F.col(column)).otherwise(F.array().cast("array<long>"))
            parts.append(F.transform(wanted, _tagged(which, sign)))
    exploded = rows.select("row", F.inline(F.concat(*parts)))
    entries = exploded.select("row", "which", F.inline(_cells(F.col("k"), size, F.col("s"))))
    return _summed(entries, "row", "which")


def successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text, own, next_text, next_own)``: each document with the next in descending id, the last with the first.

    Null ids count as the lowest. Rows of one id are ordered by their text.
    """
    parts = 2 * shuffle_parts(docs.sparkSession)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), key.alias("key")
    )
    shares = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("key", shares, 100 * parts).alias("b")).first()["b"] or []
    rows = rows.withColumn("range", _range_of(F.col("key"), sorted(set(bounds))))
    # One row per range reaches the driver; the number of ranges follows the number of shuffle partitions.
    heads = {r["range"]: r["head"] for r in rows.groupBy("range").agg(F.max("key").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    before = {heads[b]: a for a, b in zip([order[-1], *order[:-1]], order)} if order else {}
    moved = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else F.lit(None)
    added = rows.where(F.col("key").isin(list(before))).withColumn("range", F.element_at(moved, F.col("key")) if before else F.lit(0))
    own = digests(F.col("text")).alias("own")
    dealt = rows.select("*", F.lit(0).alias("added"), own).union(added.select("*", F.lit(1).alias("added"), own))
    down = Window.partitionBy("range").orderBy("added", F.desc("key"), F.xxhash64("text"), "text")
    following = dealt.select(
        "doc_id", "text", "own", "added", F.lead("text").over(down).alias("next_text"), F.lead("own").over(down).alias("next_own")
    )
    return following.where("added = 0").drop("added")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` at or below ``key``, found in two short steps."""
    if not bounds:
        return F.lit(0)
    chunks = [bounds[i : i + 64] for i in range(0, len(bounds), 64)]
    outer = F.size(F.filter(F.array(*(F.lit(c[0]) for c in chunks)), lambda b: b <= key))
    inner = F.element_at(F.array(*(F.array(*(F.lit(b) for b in c)) for c in chunks)), outer)
    return F.when(outer == 0, 0).otherwise((outer - 1) * 64 + F.size(F.filter(inner, lambda b: b <= key)))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has the last half of the characters (rounded down) replaced by as many (or all) of the next document's
    first. A fingerprint is the sketch of ``cells`` cells as hex digits: count (4), XOR (16), checks (16) of each. Likenesses
    are 1 for equal sets of paragraphs (two empty ones included) and 0 without a common one. A null text counts as
    empty; null ids come last in the order; repeated rows each give a row; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    rows = successors(docs, id_col, text_col).withColumn("edited", edited)
    rows = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            size.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            F.col("own").alias("d_own"),
            digests(F.col("edited")).alias("d_edited"),
            F.col("next_own").alias("d_next"),
        ),
        "versions",
    )
    parts = 2 * shuffle_parts(spark)
    prints = _fingerprint_rows(rows.repartition(parts, "row"), cells)
    done, attempt = [], cells
    pending = rows.select("row", "d_own", "d_edited", "d_next", F.array(F.lit("edited"), F.lit("next")).alias("open"))
    while True:
        outcome = peel(_difference(pending.repartition(parts, "row"), attempt), PEEL_ROUNDS, attempt)
        outcome = written(outcome, "peeled")
        done.append(outcome.where("left = 0").select("row", "which", "found"))
        failed = outcome.where("left > 0").groupBy("row").agg(F.collect_list("which").alias("open"))
        if failed.isEmpty():
            break
        attempt *= GROWTH
        pending = rows.select("row", "d_own", "d_edited", "d_next").join(failed, "row")
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    found = found.groupBy("row").agg(
        *(F.max(F.when(F.col("which") == w, F.col("found"))).alias(w) for w in ("edited", "next"))
    )

    def likeness(other: str, differing: str) -> Column:
        both = F.size("d_own") + F.size(other)
        # Comparisons without any digest have no cells and hence no outcome.
        return F.when(both == 0, 1.0).otherwise((both - F.coalesce(differing, F.lit(0))) / (both + F.coalesce(differing, F.lit(0))))

    joined = rows.join(prints, "row").join(found, "row", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("d_edited", "edited").alias("near_edited"),
        likeness("d_next", "next").alias("near_next"),
    )


def _fingerprint_rows(rows: DataFrame, cells: int) -> DataFrame:
    """``(row, fingerprint, edited_fingerprint)``; rows are dealt by ``row`` already."""
    versions = F.concat(
        F.transform("d_own", lambda k: F.struct(F.lit(0).alias("v"), k.alias("k"))),
        F.transform("d_edited", lambda k: F.struct(F.lit(1).alias("v"), k.alias("k"))),
    )
    entries = rows.select("row", F.inline_outer(versions)).select(
        "row", "v", F.inline_outer(F.when(F.col("v").isNotNull(), _cells(F.col("k"), cells, F.lit(1))))
    )
    summed = _summed(entries, "row", "v")
    text = F.concat(F.lpad(F.hex(F.pmod("n", F.lit(65536))), 4, "0"), F.lpad(F.hex("key"), 16, "0"), F.lpad(F.hex("chk"), 16, "0"))
    blank = F.lit("0" * 36)
    lists = summed.groupBy("row").agg(
        *(
            F.map_from_entries(F.collect_list(F.when(F.col("v") == v, F.struct("cell", text.alias("t"))))).alias(f"m{v}")
            for v in (0, 1)
        )
    )

    def joined(column: str) -> Column:
        slots = F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda c: F.coalesce(F.element_at(F.col(column), c), blank))
        return F.lower(F.array_join(slots, ""))

    return lists.select("row", joined("m0").alias("fingerprint"), joined("m1").alias("edited_fingerprint"))
