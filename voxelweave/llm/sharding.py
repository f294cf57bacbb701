"""Shards of near-equal bytes that keep linked documents together: balanced label propagation.

Linked documents start on shards by hash. In each round every node counts its neighbours' shards through a join, and half of
the nodes (a new half each round, so that two neighbours do not swap) ask to move to the shard that most neighbours
are on, if that leaves fewer links cut. A shard admits movers up to its quota: the bytes still missing to an equal share.
Documents without links have nothing to keep together; they fill up what is missing on each shard, large ones first,
so that the small ones at the end level the sizes.

Only built-in DataFrame functions are used. Text is read once, for its size and hashes; everything after works on narrow rows. Running
totals are taken inside hashed buckets and carried by a table of bucket sums, so no shard or size class is one task's work.
A group of copies beyond half a share is split into chunks that are linked and placed each on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelweave.llm.common import written

BUCKET_ROWS = 100_000
MIN_BUCKETS = 64
ROUNDS = 12
CLASS_BYTES = (16_384, 4_096, 1_024, 256)  # documents without links are placed class by class


def running_total(df: DataFrame, key: str, weight: str, name: str, buckets: int) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the same ``key`` that come before (by bucket, then row)."""
    df = df.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit("bucket")), F.lit(buckets)))
    before = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(key, "bucket").agg(F.sum(weight).alias("total"))
    bases = sums.select(key, "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(key, "bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    counted = df.withColumn("inside", F.sum(weight).over(inside) - F.col(weight))
    joined = counted.join(bases, [key, "bucket"])
    return joined.withColumn(name, F.col("base") + F.col("inside")).drop("bucket", "base", "inside")


def _pick(values: list, index: str) -> F.Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col(index) + 1)


def _loads(placed: DataFrame, shards: int) -> list[int]:
    """Bytes per shard; as many rows as shards reach the driver."""
    found = {r["shard"]: r["total"] for r in placed.groupBy("shard").agg(F.sum("size").alias("total")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def propagate(nodes: DataFrame, links: DataFrame, shards: int, share: float, rounds: int, buckets: int) -> DataFrame:
    """``(row, size, shard)`` of the linked ``nodes (row, size)`` after balanced label propagation over ``links (a, b)``.

    ``share`` is the byte quota of a shard.
    """
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    placed = written(nodes.select("row", "size", start), "shard-labels")
    both = links.select("a", "b").union(links.select("b", "a"))
    for turn in range(rounds):
        seen = both.join(placed.select(F.col("row").alias("b"), "shard"), "b")
        votes = seen.groupBy("a", "shard").agg(F.count(F.lit(1)).alias("n")).withColumnsRenamed({"a": "row", "shard": "to"})
        asked = votes.groupBy("row").agg(
            F.max(F.struct("n", (-F.col("to")).alias("minus_to"))).alias("best"),
            F.map_from_entries(F.collect_list(F.struct("to", "n"))).alias("counts"),
        )
        gain = F.col("best.n") - F.coalesce(F.element_at("counts", F.col("shard")), F.lit(0))
        wishes = placed.join(asked, "row").where(gain > 0)
        wishes = written(wishes.select("row", "size", (-F.col("best.minus_to")).alias("to")), "shard-wishes")
        if wishes.isEmpty():
            break
        movers = wishes.where(F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(2)) == 0)
        quota = [max(0, int(share) - load) for load in _loads(placed, shards)]
        ranked = running_total(movers, "to", "size", "before", buckets)
        admitted = ranked.where(F.col("before") + F.col("size") <= _pick(quota, "to")).select("row", "to")
        moved = placed.join(admitted, "row", "left")
        placed = written(moved.select("row", "size", F.coalesce("to", "shard").alias("shard")), "shard-labels")
    return placed


def _levels(loads: list[int], amount: int) -> list[float]:
    """How much of ``amount`` each shard gets so that the lowest loads rise to one level."""
    order = sorted(loads)
    level, left = float(order[0]), float(amount)
    for n, load in enumerate(order[1:], 1):
        step = min(left, (load - level) * n)
        level, left = level + step / n, left - step
    level += left / len(loads)
    return [max(0.0, level - load) for load in loads]


def fill(placed: DataFrame, free: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Place the unlinked rows ``free (row, size)`` so that bytes level out; ``placed`` and these as ``(row, shard)``."""
    kind = F.lit(len(CLASS_BYTES))
    for i, least in reversed(list(enumerate(CLASS_BYTES))):
        kind = F.when(F.col("size") >= least, i).otherwise(kind)
    classed = running_total(free.withColumn("class", kind), "class", "size", "before", buckets)
    classed = written(classed.select("row", "size", "class", "before"), "shard-classes")
    loads = _loads(placed, shards)
    amounts = {r["class"]: r["total"] for r in classed.groupBy("class").agg(F.sum("size").alias("total")).collect()}
    done = placed.select("row", "shard")
    for number, amount in sorted(amounts.items()):
        ends, upto = [], 0.0
        for part in _levels(loads, amount):
            upto += part
            ends.append(upto)
        middle = F.col("before") + F.col("size") / 2
        # The shard whose stretch of the class holds the middle of the document.
        passed = sum((middle >= F.lit(end)).cast("int") for end in ends[:-1])
        chosen = classed.where(F.col("class") == number).select("row", "size", passed.alias("shard"))
        done = done.union(chosen.select("row", "shard"))
        loads = [a + b for a, b in zip(loads, _loads(chosen, shards))]
    return done


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Equal texts are linked, each to the first of its group. ``law`` is ``bytes``: shards have near-equal sizes, a
    document counting its UTF-8 bytes plus 8. ``slot`` numbers a shard's rows from 0 without gaps; ``grown_shard`` is null.
    A null text has no bytes and links with empty ones; null ids and repeated rows are placed like others; an empty table
    gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(7), text).alias("h2"),
    )
    base = written(base, "shard-rows")
    total = base.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    share = (total["bytes"] or 0) / shards
    buckets = max(MIN_BUCKETS, -(-total["n"] // (BUCKET_ROWS * shards)))

    keys = ["h1", "h2"]
    groups = base.groupBy(*keys).agg(F.sum("size").alias("group_size"), F.count(F.lit(1)).alias("n"), F.min("row").alias("hub"))
    # Written, so that the join shuffles both sides and adaptive execution can split a large group.
    groups = written(groups.where("n > 1").select(*keys, "group_size", "hub"), "shard-groups")
    linked = written(base.select("row", "size", *keys).join(groups, keys).drop(*keys), "shard-linked")
    limit = F.lit(max(share / 2, 1.0))
    large = running_total(linked.where(F.col("group_size") > limit), "hub", "size", "before", buckets)
    chunk = F.floor(F.col("before") / limit)
    large = large.select("row", "size", "hub", chunk.alias("chunk"))
    whole = linked.where(F.col("group_size") <= limit).select("row", "size", "hub", F.lit(0).cast("long").alias("chunk"))
    nodes = written(whole.union(large), "shard-nodes")
    heads = nodes.groupBy("hub", "chunk").agg(F.min("row").alias("head"))
    links = nodes.join(heads, ["hub", "chunk"]).where("row <> head").select(F.col("row").alias("a"), F.col("head").alias("b"))
    links = written(links, "shard-links")

    placed = propagate(nodes.select("row", "size"), links, shards, share, rounds, buckets)
    free = base.select("row", "size").join(nodes.select("row"), "row", "left_anti")
    at = written(fill(placed, free, shards, buckets), "shard-placed")
    out = running_total(base.drop(*keys).join(at, "row").withColumn("one", F.lit(1)), "shard", "one", "slot", buckets)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
