"""Cost-balanced packing of token sequences.

A document's cost is linear plus quadratic in its length (attention). Whole blocks of ``capacity`` tokens are sequences of
their own; the remainders are dealt evenly over groups of bounded size, and in each group, in descending order, every
remainder goes to the sequence of lowest cost that still has room for it. A group opens only as many sequences as its
tokens need; what then fits nowhere whole is cut over the remaining room, lowest cost first. So padding stays below one
sequence per group.

Tokenising is one map whose result is written; only remainders are shuffled, with their ids at two bytes each where the
vocabulary allows. Rows are dealt by their place in the scan, so neither copies nor a hot source load one group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import texts_of, written
from voxelweave.llm.piece_model import UnitCache

GROUP_ROWS = 4_096
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECE_NAMES = [c.split()[0] for c in PIECE.split(", ")]


@lru_cache(maxsize=2)
def _word_tokenizer(path: str):
    """Tokenizer and per-word cache of a worker; white space ends words and is dropped by the tokenizer."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def solve(words: list[bytes]) -> list[bytes]:
        found = tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    return tokenizer, UnitCache(solve, limit=1_200_000)


def word_ids(path: str, text: str) -> np.ndarray:
    """Ids of a tokenizer that lower-cases and drops white space, word by word.

    Words are cut at ASCII white space and looked up with A-Z in lower case, which such a tokenizer does anyway; a text
    with the opening of a special token's name is encoded as it stands.
    """
    tokenizer, cache = _word_tokenizer(path)
    if "<|" in text:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
    return np.frombuffer(b"".join(cache.get(text.encode().lower().split())), "<u4")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenise(path: str, end_id: int, capacity: int, groups: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, block = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(word_ids(path, text.as_py()), np.uint32(end_id)).astype("<u4")
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    # Negative, so that these never meet the numbers of packed sequences.
                    sequence = -1 - (part << 40 | block)
                    crc = _crc(ids[start : start + capacity])
                    out.append((doc_id, start, capacity, crc, len(ids), sequence, 0, None, None))
                    block += 1
                if whole < len(ids):
                    rest = ids[whole:]
                    small = rest.astype("<u2") if int(rest.max()) < 1 << 16 else rest
                    group = (part * 7919 + row) % groups
                    out.append((doc_id, whole, len(rest), 0, len(ids), 0, 0, group, small.tobytes()))
                row += 1
            columns = list(zip(*out)) if out else [()] * 9
            kinds = [pa.int64()] * 8 + [pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*_PIECE_NAMES, "group", "ids"])

    return task


def assign(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(item, first, length, sequence, offset)`` of items in descending order of length."""
    n = -(-int(lengths.sum()) // capacity)
    cost, room = np.zeros(n), np.full(n, capacity, np.int64)
    pieces, unplaced = [], []

    def put(item: int, first: int, size: int, to: int) -> None:
        pieces.append((item, first, size, to, int(capacity - room[to])))
        room[to] -= size
        cost[to] += linear * size + quadratic * size * size

    for item, size in enumerate(lengths.tolist()):
        open_cost = np.where(room >= size, cost, np.inf)
        to = int(open_cost.argmin())
        if open_cost[to] < np.inf:
            put(item, 0, size, to)
        else:
            unplaced.append((item, size))
    free = iter(sorted(np.flatnonzero(room > 0).tolist(), key=lambda s: (cost[s], s)))
    to = next(free, None)
    for item, size in unplaced:
        first = 0
        while first < size:
            take = min(size - first, int(room[to]))
            put(item, first, take, to)
            first += take
            if room[to] == 0:
                to = next(free, None)
    return pieces


def _pack(capacity: int, linear: float, quadratic: float):
    def group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("ids", "ascending")])
        number = rows["group"][0].as_py()
        doc, start, total = (rows[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        lengths = rows["length"].to_numpy()
        out = []
        for item, first, size, sequence, offset in assign(lengths, capacity, linear, quadratic):
            raw = rows["ids"][item].as_py()
            ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * lengths[item] else "<u4")[first : first + size]
            sequence_id = number << 32 | sequence
            out.append((doc[item], start[item] + first, size, _crc(ids), total[item], sequence_id, offset))
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=_PIECE_NAMES)

    return group


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and ``end_id``; a null or empty text is the end id alone. ``start`` counts the document's ids
    before the piece, ``offset`` the sequence's. Repeated rows are packed each; a null id stays null; an empty table gives
    an empty result; other columns are ignored. Lengths in one group break ties by id, then by ids.
    """
    rows = texts_of(docs, id_col, text_col)
    groups = max(1, -(-rows.count() // group_rows))
    schema = f"{PIECE}, group long, ids binary"
    tokens = written(rows.mapInArrow(_tokenise(tokenizer_path, end_id, capacity, groups), schema), "tokens")
    whole = tokens.where("group is null").select(*_PIECE_NAMES)
    rest = tokens.where(F.col("group").isNotNull()).groupBy("group").applyInArrow(_pack(capacity, linear, quadratic), PIECE)
    return whole.union(rest)
