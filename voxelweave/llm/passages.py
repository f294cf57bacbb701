"""Passages that repeat across documents, exactly or nearly: collinear chaining of shared k-mer seeds.

Seeds are hashes of ``K`` words; of every ``WINDOW`` neighbouring ones the smallest is kept, so documents that share a run
of ``WINDOW + K - 1`` words share a seed in it. A seed found in several documents joins each occurrence with the one in the
lowest document id, so the number of matches is linear in the text however many documents share a passage. For each pair of
documents the matches are chained: a Fenwick tree over target positions gives each match its best predecessor under linear gap
costs. Chains are then aligned word by word, along the diagonal and by longest common subsequence where it shifts,
and stretches of at least ``min_words`` words that agree in ``similarity`` or more are passages. As the lowest holders of single
seeds may each have a part of a run only, runs of ``min_words`` words that are still uncovered are then looked up as a whole, and
pairs of seeds that no passage covers meet the lowest document that has both, so near passages are chained with that one as well.

Seeds shared by very many documents are combined before the shuffle, and joins meet one row per seed, which adaptive
execution can split. Text is shuffled once, to cut out the words around chains; the same cut for many pairs is made once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import scratch, unused, written

K, WINDOW = 5, 10
MIN_WORDS, SIMILARITY = 50, 0.8
GAP_COST = 0.03  # per word skipped on either side; a match is worth its K words
MARGIN = 40  # words looked at beyond the ends of a chain
REACH = WINDOW + K - 1  # a run of so many words shares a seed
FAR = int(K / GAP_COST) + K + 1  # neighbours in a chain are less words apart
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PASSAGE = "doc_id long, start_word long, end_word long, source_id long, source_start long, source_end long, similarity double"
PASSAGE_NAMES = [c.split()[0] for c in _PASSAGE.split(", ")]
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z in lower case."""
    words = text.encode().lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def seeds_of(hashes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds kept, their word positions, and the position of the last equal one that directly follows.

    Those that follow are left out themselves (monotonous text).
    """
    n = len(hashes) - k + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    mixed = hashes[:n].copy()
    for i in range(1, k):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    width = min(window, n)
    lowest = np.lib.stride_tricks.sliding_window_view(mixed, width).argmin(1)
    at = np.unique(lowest + np.arange(len(lowest)))
    kept = mixed[at]
    fresh = np.concatenate([[True], kept[1:] != kept[:-1]])
    upto = at[np.append(fresh[1:], True)]
    return kept[fresh].view(np.int64), at[fresh].astype(np.int32), upto.astype(np.int32)


def _seed_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = batch.column(0).to_numpy(), []
        for text in batch.column(1):
            hashes = word_hashes(text.as_py())
            found.append((*seeds_of(hashes), len(hashes)))
        counts = [len(s) for s, *_ in found]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([s for s, *_ in found])),
                    pa.array(np.repeat(ids, counts)),
                    pa.array(np.concatenate([p for _, p, _, _ in found])),
                    pa.array(np.concatenate([np.minimum(u + REACH, n).astype(np.int32) for *_, u, n in found])),
                ],
                names=["seed", "doc", "pos", "reach"],
            )


def chain(pos: np.ndarray, target: np.ndarray, k: int = K, gap_cost: float = GAP_COST) -> list[np.ndarray]:
    """Chains (index arrays) of matches sorted by ``pos`` then ``target``, best first; both positions rise in a chain."""
    n = len(pos)
    gaps = np.maximum(np.diff(pos) - k, 0) + np.maximum(np.diff(target) - k, 0)
    if n > 1 and (np.diff(target) > 0).all() and (np.diff(pos) > 0).all() and (gap_cost * gaps < k).all():
        return [np.arange(n)]  # one chain of all is best: every match adds more than its gap costs
    places = np.unique(target)
    rank = np.searchsorted(places, target) + 1
    size = len(places)
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)  # best prefix value and who has it
    score, before = [0.0] * n, [-1] * n
    reach = gap_cost * (pos + target)
    p, r, c = pos.tolist(), rank.tolist(), reach.tolist()
    waiting: list[int] = []
    for i in range(n):
        if waiting and p[waiting[0]] < p[i]:  # matches at one position cannot follow each other
            for j in waiting:
                value, at = (score[j] + c[j], j), r[j]
                while at <= size:
                    if value > tree[at]:
                        tree[at] = value
                    at += at & -at
            waiting.clear()
        best, at = (-np.inf, -1), r[i] - 1
        while at:
            if tree[at] > best:
                best = tree[at]
            at -= at & -at
        gain = best[0] - c[i] + 2 * gap_cost * k
        # Overlapping matches have no gap to pay for.
        linked = min(gain, score[best[1]]) if best[1] >= 0 else 0.0
        score[i], before[i] = (k + linked, best[1]) if linked > 0 else (float(k), -1)
        waiting.append(i)
    used, chains = [False] * n, []
    for end in sorted(range(n), key=lambda i: (-score[i], i)):
        path, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            path.append(at)
            at = before[at]
        if path:
            chains.append(np.array(path[::-1]))
    return chains


def _chain_task(least_span: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 2 + [np.empty(0, np.int32)] * 2
        for batch in _and_end(batches):
            if batch is not None:
                held = [np.concatenate([a, c.to_numpy()]) for a, c in zip(held, batch.columns)]
            doc, source, pos, target = held
            if not len(doc):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])]))
            ends = np.append(starts[1:], len(doc))
            if batch is not None:  # the last pair may go on in the next batch
                starts, ends = starts[:-1], ends[:-1]
            out = []
            for s, e in zip(starts, ends):
                if e - s < 2:
                    continue
                for c in chain(pos[s:e], target[s:e]):
                    p, t = pos[s:e][c], target[s:e][c]
                    if len(c) > 1 and p[-1] - p[0] + K >= least_span:
                        out.append((int(doc[s]), int(source[s]), p, t))
            cut = ends[-1] if len(ends) else 0
            held = [a[cut:] for a in held]
            if out:
                d, f, p, t = zip(*out)
                lists = pa.list_(pa.int32())
                arrays = [pa.array(d, pa.int64()), pa.array(f, pa.int64()), pa.array(p, lists), pa.array(t, lists)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "source", "pos", "target"])

    return task


def _and_end(batches):
    yield from batches
    yield None


def _cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes ``[lo, hi)`` of a text, for each wanted cut."""
    last, hashes = None, np.empty(0, np.uint32)
    for batch in batches:
        cuts = []
        for text, lo, hi in zip(batch.column(3), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = text.as_py()
            if text != last:
                last, hashes = text, word_hashes(text).astype(np.uint32)
            cuts.append(hashes[lo:hi].tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cuts, pa.binary())], names=["doc", "lo", "hi", "words"])


def _common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence of two short stretches."""
    same = a[:, None] == b[None, :]
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        row = np.maximum(best[i + 1, :-1], np.where(same[i], best[i + 1, 1:] + 1, 0))
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b) and best[i, j]:
        if same[i, j] and best[i, j] == best[i + 1, j + 1] + 1:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(a: np.ndarray, b: np.ndarray, pos: np.ndarray, target: np.ndarray, k: int = K) -> tuple[np.ndarray, ...]:
    """Columns of an alignment through a chain: word of ``a`` or -1, word of ``b`` or -1, and whether they match."""
    left, right = [], []

    def diagonal(i: int, j: int, n: int) -> None:
        left.append(np.arange(i, i + n))
        right.append(np.arange(j, j + n))

    reach = int(min(pos[0], target[0]))
    diagonal(int(pos[0]) - reach, int(target[0]) - reach, reach)
    i, j = int(pos[0]), int(target[0])
    for p, t in zip([*pos.tolist(), None], [*target.tolist(), None]):
        if p is None:
            n = min(len(a) - i, len(b) - j)
            diagonal(i, j, n)
            break
        if p < i or t < j:  # overlaps what is aligned: go on from there if on the same diagonal
            if p - i != t - j:
                continue
        elif p - i == t - j:
            diagonal(i, j, p - i)
            i, j = p, t
        else:
            shared = _common(a[i:p], b[j:t])
            for x, y in [*((i + x, j + y) for x, y in shared), (p, t)]:
                only_a, only_b = np.arange(i, x), np.arange(j, y)
                left.extend((only_a, np.full(len(only_b), -1)))
                right.extend((np.full(len(only_a), -1), only_b))
                if x < p:
                    diagonal(x, y, 1)
                    i, j = x + 1, y + 1
                else:
                    i, j = x, y
        end = p + k
        if end > i:
            diagonal(i, j, end - i)
            i, j = end, t + k
    left, right = np.concatenate(left), np.concatenate(right)
    both = (left >= 0) & (right >= 0)
    match = np.zeros(len(left), bool)
    match[both] = a[left[both]] == b[right[both]]
    return left, right, match


def stretches(match: np.ndarray, similarity: float, least: int) -> list[tuple[int, int]]:
    """Separate column ranges of the highest scores, a mismatch weighing as many matches as ``similarity`` allows."""
    weight = np.where(match, 1.0, -similarity / (1 - similarity))
    found, todo = [], [(0, len(match))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < least:
            continue
        total = np.concatenate([[0.0], np.cumsum(weight[lo:hi])])
        rise = total - np.minimum.accumulate(total)
        end = int(rise.argmax())
        if rise[end] <= 0:
            continue
        start = int(np.flatnonzero(total[: end + 1] == total[: end + 1].min())[-1])
        if end - start >= least:
            found.append((lo + start, lo + end))
        todo += [(lo, lo + start), (lo + end, hi)]
    return found


def _align_task(similarity: float, min_words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                a, b = np.frombuffer(r["a_words"], np.uint32), np.frombuffer(r["b_words"], np.uint32)
                pos, target = np.array(r["pos"]) - r["a_lo"], np.array(r["target"]) - r["b_lo"]
                left, right, match = align(a, b, pos, target)
                for s, e in stretches(match, similarity, min_words):
                    x, y = left[s:e][left[s:e] >= 0], right[s:e][right[s:e] >= 0]
                    longest = max(len(x), len(y))
                    share = float(match[s:e].sum()) / longest
                    if min(len(x), len(y)) >= min_words and share >= similarity:
                        at, to = r["a_lo"], r["b_lo"]
                        spans = (int(x[0]) + at, int(x[-1]) + 1 + at, r["source"], int(y[0]) + to, int(y[-1]) + 1 + to)
                        out.append((r["doc"], *spans, share))
            if out:
                kinds = [pa.int64()] * 6 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=PASSAGE_NAMES)

    return task


def shared_stretches(spots: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Word ranges of ``least`` words or more without ``REACH`` words that lack a seed, from seeds ``(pos, reach)``.

    Every run that another document has lies in one, as each ``REACH`` words of it hold a shared seed.
    """
    out: list[list[int]] = []
    for pos, reach in sorted(spots):
        if out and pos + K - 1 <= out[-1][1]:
            out[-1][1] = max(out[-1][1], reach)
        else:
            out.append([max(0, pos - WINDOW + 1), reach])
    return [(lo, hi) for lo, hi in out if hi - lo >= least]


def _open_task(min_words: int):
    """Seeds of the shared stretches that reach beyond the passages ``spans`` of a document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                spots = [(s["pos"], s["reach"]) for s in r["spots"]]
                spans = sorted((s["start"], s["end"]) for s in r["spans"] or [])
                wide = []
                for lo, hi in shared_stretches(spots, min_words):
                    done = lo
                    for start, end in spans:
                        if start > done:
                            break
                        done = max(done, end)
                    if done < hi:
                        wide.append((lo, hi))
                out += {s["seed"] for s in r["spots"] if any(lo <= s["pos"] < hi for lo, hi in wide)}
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["seed"])

    return task


SPANS = "array<struct<start: long, end: long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _stretch_task(min_words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                found = shared_stretches([(s["pos"], s["reach"]) for s in r["spots"]], min_words)
                for lo, hi in found:
                    spans = [s for s in r["spans"] or [] if s["start"] < hi and s["end"] > lo]
                    out.append((r["doc"], lo, hi, spans))
            columns = list(zip(*out)) or [[]] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), _SPANS))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "lo", "hi", "spans"])

    return task


def _gram_task(min_words: int):
    """128-bit hashes of all ``min_words`` neighbouring words of the stretches ``[lo, hi)``, each once, with its first place and
    the places that no span covers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hashes = None, np.empty(0, np.uint64)
        for batch in batches:
            for doc, lo, hi, spans, text in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4)):
                text = text.as_py()
                if text != last:
                    last, hashes = text, word_hashes(text)
                data = hashes[lo:hi].tobytes()
                n = len(data) // 8 - min_words + 1
                if n > 0:
                    grams = [xxhash.xxh3_128_digest(data[8 * i : 8 * (i + min_words)]) for i in range(n)]
                    pair = np.frombuffer(b"".join(grams), np.int64).reshape(n, 2)
                    covered = np.zeros(n, bool)
                    for span in spans:
                        covered[max(0, span["start"] - lo) : max(0, span["end"] - lo - min_words + 1)] = True
                    firsts, places = {}, {}
                    for i, gram in enumerate(grams):
                        firsts.setdefault(gram, i)
                        if not covered[i]:
                            places.setdefault(gram, []).append(lo + i)
                    at = np.array(list(firsts.values()))
                    arrays = [np.ascontiguousarray(pair[at, 0]), np.ascontiguousarray(pair[at, 1])]
                    arrays = [pa.array(a) for a in (*arrays, np.full(len(at), doc, np.int64), (lo + at).astype(np.int32))]
                    arrays.append(pa.array([places.get(gram, []) for gram in firsts], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(arrays, names=["gram", "more", "doc", "pos", "places"])

    return task


def _exact_runs(rows: DataFrame, found: DataFrame, passages: DataFrame, min_words: int) -> DataFrame:
    """Runs of ``min_words`` equal words or more that ``passages`` do not cover, each with the lowest document that has it.

    The lowest holders of single seeds may have parts of a run only, so here the key is the whole run. Only stretches made
    of shared seeds that reach beyond the passages are looked at, in all documents that hold their seeds.
    """
    spots = F.collect_list(F.struct("seed", "pos", "reach")).alias("spots")
    span = F.struct(F.col("start_word").alias("start"), F.col("end_word").alias("end"))
    spans = passages.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(span).alias("spans"))
    later = found.where("doc <> source").select("doc", "seed", "pos", "reach")
    held = later.groupBy("doc").agg(spots).join(spans, "doc", "left").select("spots", "spans")
    wanted = written(held.mapInArrow(_open_task(min_words), "seed long").distinct(), "open-seeds")
    again = found.join(wanted, "seed", "left_semi").groupBy("doc").agg(spots).join(spans, "doc", "left")
    again = again.select("doc", "spots", "spans").mapInArrow(_stretch_task(min_words), f"doc long, lo int, hi int, spans {SPANS}")
    cut = rows.join(written(again, "open-stretches"), "doc").select("doc", "lo", "hi", "spans", "text")
    grams = cut.mapInArrow(_gram_task(min_words), "gram long, more long, doc long, pos int, places array<int>")
    grams = written(grams, "grams")
    lowest = grams.groupBy("gram", "more").agg(F.min(F.struct("doc", "pos")).alias("low"), F.max("doc").alias("last"))
    lowest = written(lowest.where("low.doc < last").select("gram", "more", "low"), "repeated-grams")
    met = grams.where("size(places) > 0").join(lowest, ["gram", "more"]).where("doc > low.doc")
    place = F.struct("places", F.col("low.pos").alias("target"))
    met = met.groupBy("doc", F.col("low.doc").alias("source")).agg(F.collect_list(place).alias("met"))
    return met.mapInArrow(_run_task(min_words), _PASSAGE)


def _run_task(min_words: int):
    """Runs of grams that a pair of documents shares: neighbouring places as far apart in both are one run."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                lanes = sorted({(pos - m["target"], pos) for m in r["met"] for pos in m["places"]})
                at = 0
                for i, (lane, pos) in enumerate(lanes):
                    if i + 1 == len(lanes) or lanes[i + 1] != (lane, pos + 1):
                        start, end = lanes[at][1], pos + min_words
                        out.append((r["doc"], start, end, r["source"], start - lane, end - lane, 1.0))
                        at = i + 1
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=PASSAGE_NAMES)

    return task


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, y = a.view(np.uint64), b.view(np.uint64)
    mixed = (x ^ (x >> np.uint64(29))) * _MIX + y
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _pair_task(least: int, untried: bool):
    """Pairs of seeds of each document that can be the first and a later seed of a chain, by first place.

    With ``untried`` those, at each place of the first seed, that no passage has whole and that may have a lower holder left.
    """
    names = ["key", "tried", "a", "b", "doc", "pos", "end"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            spots, spans = batch.column(1), batch.column(2)
            columns = [spots.values.field(c).to_numpy() for c in ("pos", "seed", "source", "n")]
            limits = [spans.values.field(c).to_numpy() for c in ("start", "end")]
            upto, until = spots.offsets.to_numpy(), spans.offsets.to_numpy()
            for row, doc in enumerate(docs):
                order = np.lexsort([c[upto[row] : upto[row + 1]] for c in columns[1::-1]])
                pos, seed, source, n = (c[upto[row] : upto[row + 1]][order] for c in columns)
                low, high = np.searchsorted(pos, pos + least), np.searchsorted(pos, pos + least + FAR)
                i = np.repeat(np.arange(len(pos)), high - low)
                j = np.arange(len(i)) - np.repeat(np.cumsum(high - low) - high, high - low)
                if untried:
                    # Of a seed with two holders the other one is its source; it has met the seeds it is the source of.
                    met = (n[i] == 2) & (source[i] <= source[j]) | (n[j] == 2) & (source[j] <= source[i])
                    met |= (source[i] == doc) | (source[j] == doc)
                    if until[row + 1] > until[row]:
                        start, end = (c[until[row] : until[row + 1]] for c in limits)
                        by_start = np.argsort(start, kind="stable")
                        furthest = np.concatenate([[-1], np.maximum.accumulate(end[by_start])])
                        met |= furthest[np.searchsorted(start[by_start], pos[i], "right")] >= pos[j] + K
                    i, j = i[~met], j[~met]
                if not len(i):
                    continue
                keys = _pair_keys(seed[i], seed[j])
                _, first = np.unique(keys ^ (pos[i].astype(np.uint64) * _MIX).view(np.int64) if untried else keys, return_index=True)
                i, j, keys = i[first], j[first], keys[first]
                # The first round has compared it with a common source; no document below either source has both.
                tried = np.maximum(source[i], source[j]) - (source[i] != source[j])
                found = [keys, tried, seed[i], seed[j], np.full(len(i), doc), pos[i], pos[j]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=names)

    return task


def _further_passages(rows: DataFrame, found: DataFrame, passages: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """``passages`` and those of the pairs of seeds that they leave uncovered, with the lowest document that has both seeds.

    A near passage that the lowest holders of its seeds have in parts only has such a pair, as its chain has seeds
    ``_least_span`` words apart. Where the lowest holder of every pair has a part only as well, the passage is still missed.
    """
    least = _least_span(min_words) - K
    schema = "key long, tried long, a long, b long, doc long, pos int, end int"
    spot = F.collect_list(F.struct("pos", "seed", "source", "n")).alias("spots")
    span = F.struct(F.col("start_word").alias("start"), F.col("end_word").alias("end"))

    spans = written(passages.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(span).alias("spans")), "document-spans")
    held = found.groupBy("doc").agg(spot).join(spans, "doc", "left").select("doc", "spots", "spans")
    untried = written(held.mapInArrow(_pair_task(least, True), schema), "untried-pairs")
    seeds = written(untried.select(F.col("a").alias("seed")).union(untried.select("b")).distinct(), "untried-seeds")
    spots = found.join(seeds, "seed", "left_semi").groupBy("doc").agg(spot).select("doc", "spots", F.lit(None).cast(SPANS).alias("spans"))
    holders = spots.mapInArrow(_pair_task(least, False), schema).where("doc > tried")
    place = F.struct(F.col("doc").alias("source"), F.col("pos").alias("target"), F.col("end").alias("upto"))
    lowest = holders.groupBy("key").agg(F.min(place).alias("low")).select("key", "low.*")
    pairs = untried.join(written(lowest, "lowest-holders"), "key").where("source < doc")
    pairs = written(pairs.select("doc", "source", "pos", "target", "end", "upto"), "pairs-met")
    matches = pairs.select("doc", "source", "pos", "target").union(pairs.select("doc", "source", "end", "upto")).distinct()
    more = _aligned(rows, matches, min_words, similarity).join(spans.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
    # A passage inside another one of its document does not have the pair of seeds.
    inside = F.exists("spans", lambda x: (x["start"] <= F.col("start_word")) & (x["end"] >= F.col("end_word")))
    return passages.union(more.where(~F.coalesce(inside, F.lit(False))).select(*PASSAGE_NAMES)).distinct()


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, doc_id, text_hash, text)`` of the distinct documents; ``doc`` is the id, or a number below all of them for the
    further texts of an id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).dropna()
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    # Ids with several texts are few or none; each text's row goes once to them.
    several = rows.groupBy("doc_id").agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last")).where("first <> last")
    marked = rows.join(written(several.select("doc_id", "first"), "ids-with-texts"), "doc_id", "left")
    further = F.xxhash64("doc_id", "text_hash").bitwiseAND(F.lit((1 << 61) - 1)) - F.lit(1 << 62)
    number = F.when(F.col("first") != F.col("text_hash"), further).otherwise(F.col("doc_id"))
    return marked.select(number.alias("doc"), "doc_id", "text_hash", "text")


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per passage that a document shares with one of lower id.

    ``doc_id, text_hash`` (``xxhash64`` of the text), ``start_word, end_word`` (words between ASCII white space, end excluded),
    ``source_id, source_start, source_end`` and ``similarity``: matching words over the words of the longer side. Both sides have ``min_words`` words or more. For near
    passages a document is compared with the lowest id that shares a seed, so of many copies each is linked to the first. Equal
    runs that these leave uncovered are found whole, whoever holds their seeds (``min_words`` of ``REACH`` or more), and pairs of
    seeds that lie in no passage are compared with the lowest id that has both. Repeats inside one document are not reported. Rows with a null id or text take no part, nor do texts below ``K`` words; repeated rows of
    one id count once, and each different text of an id is a document of its own (the one of lowest hash in the place of its
    id, the others before all ids, by hash); an empty table gives an empty result; other columns are ignored.
    """
    whole = _documents(docs, id_col, text_col)
    found = _numbered_passages(whole, min_words, similarity)
    names = _names(whole)
    named = found.join(names, F.col("doc_id") == F.col("doc")).drop("doc", "doc_id").withColumnRenamed("id", "doc_id")
    sources = names.select(F.col("doc").alias("source_id"), F.col("id").alias("source"))
    named = named.join(sources, "source_id").drop("source_id").withColumnRenamed("source", "source_id")
    return named.select("doc_id", "text_hash", *PASSAGE_NAMES[1:])


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document that has such passages: ``doc_id, text_hash, spans``, the distinct ``(start_word, end_word)``.

    The passages are those of :func:`repeated_passages`, which also states what nulls and repeated rows give. They are gathered by
    document before they get their names, so a passage that many documents hold is not carried once per place it came from.
    """
    whole = _documents(docs, id_col, text_col)
    found = _numbered_passages(whole, min_words, similarity)
    spans = found.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    return spans.join(_names(whole), "doc").select(F.col("id").alias("doc_id"), "text_hash", "spans")


def _names(whole: DataFrame) -> DataFrame:
    return written(whole.select("doc", F.col("doc_id").alias("id"), "text_hash").distinct(), "document-names")


def _least_span(min_words: int) -> int:
    """Words from the first to the last seed of an equal run of ``min_words``."""
    return max(K, min_words - 2 * (WINDOW + K - 2))


def _numbered_passages(whole: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """Passages of :func:`repeated_passages` whose ids are the numbers of :func:`_documents`."""
    rows = whole.select("doc", "text")
    with scratch(whole.sparkSession) as keep:  # the seeds of all words go once the shared ones are stored
        seeds = written(rows.mapInArrow(_seed_task, "seed long, doc long, pos int, reach int"), "seeds")
        firsts = seeds.groupBy("seed").agg(F.min("doc").alias("source"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
        # Written, as is what the next join meets, so that these joins shuffle both sides and a very common seed can be split.
        shared = written(firsts.where("source < last").select("seed", "source", "n"), "repeated-seeds")
        found = keep(seeds.join(shared, "seed"), "shared-seeds")
    targets = written(found.where("doc = source").groupBy("seed").agg(F.min("pos").alias("target")), "seed-targets")
    matches = found.where("doc <> source").join(targets, "seed").select("doc", "source", "pos", "target").distinct()
    near = _aligned(rows, matches, min_words, similarity)
    passages = written(near.unionByName(_exact_runs(rows, found, near, min_words)), "first-passages")
    return written(_further_passages(rows, found, passages, min_words, similarity), "numbered-passages")


def _aligned(rows: DataFrame, matches: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """Passages along the chains of ``matches (doc, source, pos, target)``."""
    dealt = matches.repartition("doc", "source").sortWithinPartitions("doc", "source", "pos", "target")
    schema = "doc long, source long, pos array<int>, target array<int>"
    chains = dealt.mapInArrow(_chain_task(_least_span(min_words)), schema)

    def bounds(column: str, side: str) -> list:
        low = F.greatest(F.lit(0), F.col(column)[0] - MARGIN).alias(f"{side}_lo")
        return [low, (F.element_at(column, -1) + K + MARGIN).alias(f"{side}_hi")]

    chains = written(chains.select("*", *bounds("pos", "a"), *bounds("target", "b")), "chains")
    cuts = chains.select("doc", F.col("a_lo").alias("lo"), F.col("a_hi").alias("hi")).union(chains.select("source", "b_lo", "b_hi"))
    wanted = cuts.distinct()
    words = rows.join(wanted, "doc").select("doc", "lo", "hi", "text")
    words = words.mapInArrow(_cut_task, "doc long, lo int, hi int, words binary")
    words = written(words.dropDuplicates(["doc", "lo", "hi"]), "chain-words")
    for side, key in (("a", "doc"), ("b", "source")):
        cut = words.toDF(key, f"{side}_lo", f"{side}_hi", f"{side}_words")
        chains = chains.join(cut, [key, f"{side}_lo", f"{side}_hi"])
    return written(chains.mapInArrow(_align_task(similarity, min_words), _PASSAGE).distinct(), "near-passages")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` and the white space after each."""
    data = text.encode()
    at = [(m.start(), m.end()) for m in _WORD.finditer(data)]
    kept, done = [], 0
    for start, end in sorted(spans):
        lo = at[start][0]
        if lo > done:
            kept.append(data[done:lo])
        done = max(done, at[end][0] if end < len(at) else len(data))
    kept.append(data[done:])
    return b"".join(kept).decode()


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of the later documents; all columns and rows stay.

    Passages go by id and text, so another text of the same id keeps its words; null ids and texts, and documents
    without passages, are left alone; repeated rows are all cut.
    """
    found = F.collect_set(F.struct("start_word", "end_word")).alias("spans")
    return remove_spans(docs, passages.groupBy("doc_id", "text_hash").agg(found), id_col, text_col)


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`remove_passages` for the passages of each document in one row, as :func:`repeated_spans` gives them."""
    name, own = unused("_spans", docs), unused("_text_hash", docs)
    spans = spans.select(F.col("doc_id").alias(id_col), F.col("text_hash").alias(own), F.col("spans").alias(name))

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        return pd.Series([t and cut_text(t, [(s["start_word"], s["end_word"]) for s in x]) for t, x in zip(texts, spans)])

    # One join; only texts with passages go through Python.
    hashed = docs.withColumn(own, F.xxhash64(text_col))
    joined, found = hashed.join(spans, [id_col, own], "left").select(*docs.columns, name), F.col(name).isNotNull()
    shorter = cut(F.when(found, F.col(text_col)), F.col(name))
    return joined.withColumn(text_col, F.when(found, shorter).otherwise(F.col(text_col))).drop(name)
