"""Tokens of two tokenizers aligned by bytes, and how often each pair of ids is linked over the corpus.

Pass one aligns every document and counts, per task, in how many documents each pair is linked. The distinct pairs are dealt
into buckets of about ``BUCKET`` and every bucket gets a minimal perfect hash; the tasks' counts become dense vectors indexed by that
hash, each key verified, which are summed in a tree. Pass two aligns the documents again and looks the counts up: the
most frequent pairs (at most ``HOT``, a fixed bound) in a table that every worker holds, hashed the same way; the rare
rest, whatever its size, by a join.

Texts are cut into units that tokens of neither side reach across, and each unit is aligned once per worker (while its bounded
store holds it). New units are joined to one text and aligned by column operations; long texts go part by part.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import texts_of, written
from voxelweave.llm.minimal_hash import HashedTable, MinimalHash
from voxelweave.llm.piece_model import SPACE, normalise, open_model

BUCKET = 8_192
HOT = 1 << 19
FAN = 16
PART_ROWS = 1 << 18
LEVELS = 4  # steps of a doubling in which the least count of the hot table is chosen
SLICE = 1 << 18  # characters aligned at once
SHORT = 1 << 10  # links of a group that are listed one by one
FLUSH = 2_000_000
STORE = 224 << 20  # bytes of aligned units that a worker keeps
#: White space in any reading, and marks that some readings count as such: never next to a cut.
_BLANK = r"\s\x1c-\x1f\x85\u180e\u200b-\u200d\u2060\ufeff"
_CUT = re.compile(f"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")
_BLANKS = {chr(i) for i in range(0x10000) if re.match(f"[{_BLANK}]", chr(i))}
_ODD_SPACE = re.compile(f" [{_BLANK}]|[{_BLANK}] ")
#: Scripts whose letters, digits and marks every Unicode version in use classes alike.
_SETTLED = re.compile(
    r"[\x00-\u0233\u0250-\u036f\u0391-\u03a1\u03a3-\u03ff\u0400-\u0481\u048a-\u0513\u05d0-\u05ea\u0621-\u063a\u0641-\u0652"
    r"\u2010-\u2027\u2030-\u2052\u20a0-\u20ac\u3001-\u3020\u3041-\u3094\u30a1-\u30fe\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e]*"
)
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_values() -> dict[str, int]:
    """Bytes by the printable characters that stand for them in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokenizer:
    """A byte-level tokenizer file: ids of texts, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        values, self.bytes = _byte_values(), {}
        for token, i in self.whole.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()
        before, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.cuts = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.fast = self._ranked(spec, model, values) if self.cuts else None

    @staticmethod
    def _ranked(spec: dict, model: dict, values: dict[str, int]):
        """The same tokenizer by ranks, where the file's merges are in the order of their ids and nothing else acts."""
        import tiktoken

        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        vocab = model["vocab"]
        ids = [vocab.get(m.replace(" ", "", 1)) for m in merges]
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        plain = model.get("type") == "BPE" and not spec["normalizer"] and not any(model.get(o) for o in options)
        if not plain or None in ids or ids != sorted(set(ids)) or any(c not in vocab for c in values):
            return None
        tokens = set(values) | {m.replace(" ", "", 1) for m in merges}
        if max(vocab[c] for c in values) >= min(ids, default=1 << 40):
            return None
        ranks = {bytes(values[c] for c in token): vocab[token] for token in tokens}
        return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [x.ids for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return [
            self.fast.encode_ordinary(t)
            if len(t) <= 4 * SLICE and _SETTLED.fullmatch(t)
            else self.whole.encode(t, add_special_tokens=False).ids
            for t in texts
        ]


class Column:
    """A growing array."""

    def __init__(self, dtype):
        self.room, self.size = np.empty(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.room):
            grown = np.empty(max(need, 2 * len(self.room)), self.room.dtype)
            grown[: self.size] = self.room[: self.size]
            self.room = grown
        self.room[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Aligner:
    """Both tokenizers of a worker and the units aligned so far. The code of a pair of ids is ``a * pieces + b``.

    Per unit: ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` (columns of ``stats``; -1 where the tokens of a side do not give
    the unit back), ``groups`` as text, and the linked ``pairs`` with their ``times`` from ``first`` to the next unit's.
    """

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokenizer(byte_path), open_model(piece_path)
        model = self.b.whole
        self.mark = SPACE if self.b.escape else " "
        self.pieces = model.get_piece_size()
        self.b_bytes = []
        for i in range(self.pieces):
            piece = model.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
        size = max(self.a.bytes) + 1
        self.a_bytes = [self.a.bytes.get(i, b"") for i in range(size)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        self.codes = size * self.pieces
        ids = [b"%d" % i for i in range(max(size, self.pieces))]
        self.words = [i + end for i in ids for end in (b",", b"|", b";")]
        # Byte-level words begin at a space after a mark that is not blank, and pieces hold a space mark at their begin only.
        self.cuts = self.a.cuts and self.b.unit_pattern.pattern != r"[\s\S]+"
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.held = 0
        self.stats = [Column(np.int64) for _ in range(4)]
        self.first, self.pairs, self.times = Column(np.int64), Column(np.int64), Column(np.int64)
        self.first.extend(np.zeros(1, np.int64))

    def parts(self, text: str) -> list[str]:
        """Space + text in parts of about ``SLICE`` characters; none for texts without tokens."""
        if not text or SPACE in text:  # a space mark in the text comes back as a space
            return []
        if normalise(self.b, text, False)[0] != self.mark + text.replace(" ", self.mark):
            return []
        text, parts = " " + text, []
        while self.cuts and len(text) > SLICE:
            cut = _CUT.search(text, SLICE)
            if cut is None:
                break
            parts.append(text[: cut.start()])
            text = text[cut.start() :]
        return [*parts, text]

    def units(self, part: str) -> list[str]:
        """Units of a part, each without the space it begins with."""
        text = part[1:]
        if not self.cuts:
            return [text]
        if text[0] == " " or text[-1] == " " or _ODD_SPACE.search(text):
            first, *rest = _CUT.split(part)
            return [first[1:], *rest]
        return text.split(" ")

    def numbers(self, units: list[str]) -> np.ndarray:
        """Places of units in the store; new ones are aligned."""
        index = self.index
        new = [u for u in dict.fromkeys(units) if u not in index]
        if new:
            apart = [u for u in new if not self.cuts or not u or u[0] in _BLANKS or u[-1] in _BLANKS]
            if apart:
                index.update(dict.fromkeys(apart, -1))
                new = [u for u in new if u not in index]
            self._add(new + apart, len(new))
        return np.fromiter(map(index.__getitem__, units), np.int64, len(units))

    def _add(self, units: list[str], plain: int) -> None:
        """Align new units; the first ``plain`` ones may stand side by side in one text."""
        data = [b" " + u.encode() for u in units]
        texts = ([" " + " ".join(units[:plain])] if plain else []) + [" " + u for u in units[plain:]]
        a, b = self.a.ids(texts), self.b.plain.encode([t.replace(" ", self.mark) for t in texts], num_threads=1)
        whole, good = b"".join(data), range(len(units))
        if any(b"".join([t[i] for x in side for i in x]) != whole for side, t in ((a, self.a_bytes), (b, self.b_bytes))):
            a = self.a.ids([" " + u for u in units])
            b = self.b.plain.encode([self.mark + u.replace(" ", self.mark) for u in units], num_threads=1)
            same = (b"".join([self.a_bytes[i] for i in x]) == d == b"".join([self.b_bytes[i] for i in y]) for d, x, y in zip(data, a, b))
            good = [i for i, fine in enumerate(same) if fine]
            a, b = ([side[i] for i in good] for side in (a, b))
        ends = np.cumsum([0, *(len(data[i]) for i in good)])[1:]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (a, b))
        self._store(units, np.array(good, np.int64), ends, a, b)

    def _store(self, units: list[str], good: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Groups and links of the tokens ``a`` and ``b`` of the units ``good``, which end at the bytes ``ends``."""
        n = len(units)
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at = np.searchsorted(a_end, b_end)
        b_last = a_end[at] == b_end if len(a_end) else np.empty(0, bool)
        a_last = np.zeros(len(a), bool)
        a_last[at[b_last]] = True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        count = int(a_last.sum())
        a_n, b_n = np.bincount(a_group, minlength=count), np.bincount(b_group, minlength=count)
        a_to, b_to = np.cumsum(a_n), np.cumsum(b_n)
        unit = good[np.searchsorted(ends, b_end[b_last])] if count else np.empty(0, np.int64)  # of each group

        long = a_n * b_n > SHORT
        reps = np.where(long, 0, b_n)[a_group]
        place = np.arange(int(reps.sum())) + np.repeat((b_to - b_n)[a_group] - (np.cumsum(reps) - reps), reps)
        pairs, of = np.repeat(a * self.pieces, reps) + b[place], np.repeat(unit[a_group], reps)
        found = [(pairs, np.ones(len(pairs), np.int64), of)]
        for g in np.flatnonzero(long).tolist():  # by distinct ids and how often each occurs
            x, nx = np.unique(a[a_to[g] - a_n[g] : a_to[g]], return_counts=True)
            y, ny = np.unique(b[b_to[g] - b_n[g] : b_to[g]], return_counts=True)
            codes = (x[:, None] * self.pieces + y).ravel()
            found.append((codes, (nx[:, None] * ny).ravel(), np.full(len(codes), unit[g])))
        pairs, times, of = map(np.concatenate, zip(*found))
        if len(found) > 1:
            order = np.argsort(of, kind="stable")
            pairs, times, of = pairs[order], times[order], of[order]

        # Tokens in the order of the groups' text, each with what follows it.
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + (b_to - b_n)[a_group]] = a * 3 + a_last
        shown[np.arange(len(b)) + a_to[b_group]] = b * 3 + 2 * b_last
        shown = [self.words[i] for i in shown.tolist()]
        stats = [_row_sums(unit, n, values) for values in (a_n, b_n, np.ones(count, np.int64), a_n * b_n)]
        sizes = stats[0] + stats[1]
        groups = [b"".join(shown[stop - size : stop]) for stop, size in zip(np.cumsum(sizes).tolist(), sizes.tolist())]
        bad = np.ones(n, bool)
        bad[good] = False
        self.index.update(zip(units, range(len(self.groups), len(self.groups) + n)))
        self.groups += groups
        for column, out in zip(self.stats, stats):
            column.extend(np.where(bad, -1, out))
        self.first.extend(self.first.values[-1] + np.cumsum(np.bincount(of, minlength=n)))
        self.pairs.extend(pairs)
        self.times.extend(times)
        self.held += 300 * n + 3 * int(ends[-1] if len(ends) else 0) + sum(map(len, groups)) + 16 * len(pairs)

    def links(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs and times of all links of ``units``, and the place in ``units`` that each belongs to."""
        first = self.first.values
        sizes = first[units + 1] - first[units]
        of = np.repeat(np.arange(len(units)), sizes)
        at = np.arange(len(of)) + np.repeat(first[units] - (np.cumsum(sizes) - sizes), sizes)
        return self.pairs.values[at], self.times.values[at], of

    def slices(self, texts: list[str]) -> Iterator[tuple[int, int, bool, np.ndarray, np.ndarray]]:
        """Row ranges with, for each of their units in order, its row within the range and its place in the store.

        A long row comes alone and part by part; the flag marks its last (or only) part. Places hold until the next slice.
        """
        lo, units, docs, size = 0, [], [], 0
        for row, text in enumerate(texts):
            parts = self.parts(text)
            if row > lo and size + len(text) > SLICE:
                yield lo, row, True, *self._placed(units, docs)
                lo, units, docs, size = row, [], [], 0
            if len(parts) > 1:
                if row > lo:
                    yield lo, row, True, *self._placed(units, docs)
                for i, part in enumerate(parts):
                    own = self.units(part)
                    yield row, row + 1, i == len(parts) - 1, *self._placed(own, [0] * len(own))
                lo, units, docs, size = row + 1, [], [], 0
            else:
                for part in parts:
                    own = self.units(part)
                    units += own
                    docs += [row - lo] * len(own)
                size += len(text)
        if len(texts) > lo:
            yield lo, len(texts), True, *self._placed(units, docs)

    def _placed(self, units: list[str], docs: list[int]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > STORE:
            self.clear()
        return np.array(docs, np.int64), self.numbers(units)

    def failed(self, docs: np.ndarray, units: np.ndarray, n: int) -> np.ndarray:
        """Whether a row has a unit that its tokens do not give back."""
        out = np.zeros(n, bool)
        out[docs[self.stats[0].values[units] < 0]] = True
        return out


def _row_sums(docs: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """Sums by row, ``docs`` rising."""
    out = np.zeros(n, np.int64)
    if len(docs):
        first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        out[docs[first]] = np.add.reduceat(values, first)
    return out


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


@lru_cache(maxsize=2)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


class _Counter:
    """Documents per pair in a task, given out in bounded tables."""

    def __init__(self):
        self.keys, self.values, self.waiting, self.size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def add(self, pairs: np.ndarray) -> None:
        self.waiting.append(pairs)
        self.size += len(pairs)

    def settle(self) -> None:
        own, counts = np.unique(np.concatenate([np.empty(0, np.int64), *self.waiting]), return_counts=True)
        self.keys, self.values = _summed(np.concatenate([self.keys, own]), np.concatenate([self.values, counts]))
        self.waiting, self.size = [], 0

    def table(self, task: int) -> pa.RecordBatch:
        out = [pa.array(self.keys), pa.array(self.values), pa.array(np.full(len(self.keys), task, np.int32))]
        self.keys, self.values = np.empty(0, np.int64), np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(out, names=["pair", "docs", "task"])


def _pair_task(byte_path: str, piece_path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counter, number = _aligner(byte_path, piece_path), _Counter(), TaskContext.get().partitionId()
        for batch in batches:
            held: list[np.ndarray] = []  # of a long row
            failed = False
            for lo, hi, last, docs, units in aligner.slices(batch.column(1).to_pylist()):
                bad = aligner.failed(docs, units, hi - lo)
                failed |= bool(bad.all())
                store = len(aligner.groups)
                once = np.unique((docs * store + units)[~bad[docs]])
                pairs, _, of = aligner.links(once % store if store else once)
                held.append(np.unique((once // max(store, 1))[of] * aligner.codes + pairs))
                if last:
                    if len(held) > 1:
                        held = [] if failed else [np.unique(np.concatenate(held))]
                    for keys in held:
                        counter.add(keys % aligner.codes)
                    held, failed = [], False
                if counter.size > FLUSH:
                    counter.settle()
                    if len(counter.keys) > FLUSH:
                        yield counter.table(number)
        counter.settle()
        if len(counter.keys):
            yield counter.table(number)

    return task


def _hash_group(table: pa.Table) -> pa.Table:
    """Minimal perfect hash of a bucket's pairs and the pairs in its order."""
    keys = table["pair"].to_numpy()
    hashed = HashedTable(keys)
    columns = {"bucket": table["bucket"][:1], "hash": [hashed.hash.packed()], "pairs": [hashed.keys.tobytes()]}
    return pa.table(columns, pa.schema([("bucket", pa.int32()), ("hash", pa.binary()), ("pairs", pa.binary())]))


_VECTOR = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])


def _vector_group(partials: pa.Table, hashes: pa.Table) -> pa.Table:
    """Dense vector of a part of a bucket's counts, indexed by the bucket's hash."""
    if not len(partials):
        return _VECTOR.empty_table()
    function = MinimalHash.unpacked(hashes["hash"][0].as_py())
    known = np.frombuffer(hashes["pairs"][0].as_py(), np.int64)
    keys = partials["pair"].to_numpy()
    at = function.numbers(keys)
    if (at < 0).any() or (known[at] != keys).any():
        raise ValueError("a pair is missing from its bucket")
    counts = np.zeros(len(known), np.int64)
    np.add.at(counts, at, partials["docs"].to_numpy())
    columns = {"bucket": partials["bucket"][:1], "part": partials["part"][:1], "counts": [counts.tobytes()]}
    return pa.table(columns, _VECTOR)


def _sum_group(table: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(v.as_buffer(), np.int64) for v in table["counts"])
    return pa.table({"bucket": table["bucket"][:1], "part": table["part"][:1], "counts": [counts.tobytes()]}, _VECTOR)


def _open_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, counts in zip(batch.column(0), batch.column(1)):
            arrays = [pa.array(np.frombuffer(v.as_buffer(), np.int64)) for v in (pairs, counts)]
            yield pa.RecordBatch.from_arrays(arrays, names=["pair", "docs"])


def pair_counts(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``pair, a, b, docs, best`` of all linked id pairs: documents that hold it, and whether no other pair of ``a`` has more.

    ``pair`` is ``a * pieces + b`` with the number of the model's pieces. Documents (rows) without tokens (see :func:`align_documents`) hold no pair.
    """
    rows = texts_of(docs, id_col, text_col)
    partials = rows.mapInArrow(_pair_task(byte_path, piece_path), "pair long, docs long, task int")
    partials = written(partials, "partial-pairs")
    keys = written(partials.select("pair").distinct(), "pairs")
    total, held = keys.count(), partials.count()
    buckets = max(1, -(-total // BUCKET))
    parts = max(1, -(-held // (buckets * PART_ROWS)))
    bucket = F.pmod(F.xxhash64("pair"), F.lit(buckets)).cast("int").alias("bucket")
    schema = "bucket int, hash binary, pairs binary"
    hashes = written(keys.select("pair", bucket).groupBy("bucket").applyInArrow(_hash_group, schema), "pair-hashes")
    part = F.pmod(F.xxhash64("task"), F.lit(parts)).cast("int").alias("part")
    dealt = partials.select("pair", "docs", bucket, part).groupBy("bucket", "part")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    schema = "bucket int, part int, counts binary"
    vectors = dealt.cogroup(hashes.select("*", every).groupBy("bucket", "part")).applyInArrow(_vector_group, schema)
    while parts > 1:
        parts = -(-parts // FAN)
        upper = F.floor(F.col("part") / FAN).cast("int").alias("part")
        vectors = vectors.select("bucket", upper, "counts").groupBy("bucket", "part").applyInArrow(_sum_group, schema)
    opened = hashes.join(vectors, "bucket").select("pairs", "counts").mapInArrow(_open_vectors, "pair long, docs long")
    pieces = open_model(piece_path).whole.get_piece_size()
    counts = written(opened.withColumn("a", F.floor(F.expr(f"pair div {pieces}")).cast("int")), "dense-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    b = F.pmod("pair", F.lit(pieces)).cast("int").alias("b")
    return written(counts.join(most, "a").select("pair", "a", b, "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-counts")


def _hot_table(counts: DataFrame, limit: int) -> tuple[HashedTable, DataFrame]:
    """The most frequent pairs, at most ``limit``, hashed for the workers; and the rows of all others."""
    level = F.floor(F.log2("docs") * LEVELS).cast("int")
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    least, held = 1 << 30, 0
    for step in sorted(sizes, reverse=True):
        held += sizes[step]
        if held > limit:
            break
        least = step
    hot = counts.where(level >= least).select("pair", "docs", "best").toArrow()
    columns = [hot[c].to_numpy() if len(hot) else np.empty(0, t) for c, t in (("pair", np.int64), ("docs", np.int64), ("best", bool))]
    return HashedTable(*columns), counts.where(level < least)


COLD = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
OUTPUTS = {"groups_sha256": "string", "groups": "string"}


class _Scores:
    """Per unit of the store: sum of its links' counts and its best links by the hot table, and the links that lacks."""

    def __init__(self, aligner: Aligner, hot: HashedTable):
        self.aligner, self.hot = aligner, hot
        self.clear()

    def clear(self) -> None:
        self.columns = [Column(np.int64) for _ in range(2)]
        self.rare = Column(bool)
        self.index = self.aligner.index

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.index is not self.aligner.index:  # the store began anew
            self.clear()
        new = np.arange(self.rare.size, len(self.aligner.groups))
        if len(new):
            pairs, times, of = self.aligner.links(new)
            at, known = self.hot.find(pairs)
            for column, values in zip(self.columns, self.hot.values):
                column.extend(_row_sums(of, len(new), times * np.where(known, values[at] if len(values) else 0, 0)))
            self.rare.extend(_row_sums(of, len(new), (~known).astype(np.int64)) > 0)
        return *(c.values[units] for c in self.columns), self.rare.values[units]

    def rest(self, docs: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links that the hot table lacks: row and pair as one key, and occurrences."""
        pairs, times, of = self.aligner.links(units)
        _, known = self.hot.find(pairs)
        return _summed((docs[of] * self.aligner.codes + pairs)[~known], times[~known])


def _lookup_task(byte_path: str, piece_path: str, shared, outputs: tuple[str, ...]):
    kinds = [pa.binary()] + [pa.int64()] * 6 + [COLD] + [pa.string()] * len(outputs)
    names = ["doc_id", "node", "n_a", "n_b", "n_groups", "n_links", "count_sum", "n_best", "cold", *outputs]
    made = {"groups_sha256": lambda g: hashlib.sha256(g).hexdigest() if g else "", "groups": bytes.decode}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        scores = _Scores(aligner, shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            stats, joined, rest, failed = None, None, {}, None
            for lo, hi, last, docs, units in aligner.slices(texts):
                n = hi - lo
                if stats is None:
                    stats, joined, failed = np.zeros((6, n), np.int64), [[] for _ in range(n)], np.zeros(n, bool)
                failed |= aligner.failed(docs, units, n)
                docs_sum, best, rare = scores.of(units)
                for row, values in zip(stats, (*(c.values[units] for c in aligner.stats), docs_sum, best)):
                    row += _row_sums(docs, n, values)
                stops = np.searchsorted(docs, np.arange(n + 1)).tolist()
                shown = [aligner.groups[i] for i in units.tolist()]
                for out, start, stop in zip(joined, stops, stops[1:]):
                    out.append(b"".join(shown[start:stop]))
                if rare.any():
                    for key, t in zip(*(c.tolist() for c in scores.rest(docs[rare], units[rare]))):
                        of = rest.setdefault(key // aligner.codes, {})
                        of[key % aligner.codes] = of.get(key % aligner.codes, 0) + t
                if not last:
                    continue
                stats[:, failed] = 0
                whole = [b"" if bad else b"".join(g)[:-1] for g, bad in zip(joined, failed)]
                nodes, cold = [None] * n, [None] * n
                for doc, pairs in rest.items():
                    if not failed[doc]:
                        cold[doc] = [{"pair": p, "times": t} for p, t in pairs.items()]
                        nodes[doc] = xxhash.xxh3_128_digest(texts[lo + doc].encode())
                columns = [nodes, *stats, cold, *([made[o](g) for g in whole] for o in outputs)]
                arrays = [batch.column(0).slice(lo, n), *(pa.array(c, k) for c, k in zip(columns, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                stats, joined, rest, failed = None, None, {}, None

    return task


def align_documents(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("groups",),
    counts: DataFrame | None = None,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` and the chosen ``outputs``.

    The text is encoded with a space before it by the byte-level tokenizer (A) and as it is by the SentencePiece model (B, which
    adds the space), special tokens' names being plain text. Byte offsets where tokens of both end cut the tokens into ``groups``
    (``a1,a2|b1;a3|b2,b3``; ``groups_sha256`` is its digest); all pairs of occurrences in one group are links. ``count_sum`` adds up, over
    the links, the documents that hold the pair of ids linked; ``n_best`` counts links with the highest such number of their A id.
    ``counts`` may bring the pairs of another corpus (as :func:`pair_counts` gives them; pairs it lacks count zero).

    Null and empty texts, and texts that the tokens of one side do not give back byte for byte, have no tokens: zeros and empty
    strings. A null id stays null; repeated rows count and repeat; an empty table gives an empty result; other columns are ignored.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    spark = docs.sparkSession
    if counts is None:
        counts = pair_counts(docs, byte_path, piece_path, id_col, text_col)
    table, rare = _hot_table(counts, hot)
    task = _lookup_task(byte_path, piece_path, spark.sparkContext.broadcast(table), tuple(outputs))
    longs = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "count_sum", "n_best"))
    kinds = "".join(f", {o} {OUTPUTS[o]}" for o in outputs)
    schema = f"doc_id long, node binary, {longs}, cold array<struct<pair: long, times: long>>{kinds}"
    looked = written(texts_of(docs, id_col, text_col).mapInArrow(task, schema), "looked-up")
    cold = looked.where("cold is not null").select("node", F.explode("cold").alias("c")).select("node", "c.pair", "c.times")
    # Equal texts are joined once; written, so that the join can be split.
    cold = written(cold.dropDuplicates(["node", "pair"]), "rare-pairs")
    met = cold.join(rare.select("pair", "docs", "best"), "pair")
    more = met.groupBy("node").agg(
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    whole = looked.join(written(more, "rare-sums"), "node", "left")
    return whole.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        *outputs,
    )
