"""Words of whole Arrow batches and hashes of neighbouring words, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0-9, a-z and every byte of characters beyond ASCII.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, SLICE_BYTES), _powers(_INVERSE, SLICE_BYTES)


@dataclass
class Words:
    """Words of some texts: lower-cased bytes, byte ranges and hashes of words, first word of each text (and the end)."""

    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    def text(self, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi`` joined by spaces."""
        return b" ".join(self.data[b:e].tobytes() for b, e in zip(self.begins[lo:hi], self.ends[lo:hi]))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of ``width`` words inside one text, and the hashes of the runs."""
        n = max(0, len(self.hashes) - width + 1)
        mixed = self.hashes[:n] + np.uint64(width)
        for i in range(1, width):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + self.hashes[i : i + n]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        mixed ^= mixed >> np.uint64(29)
        end = np.repeat(self.firsts[1:], self.counts())[:n]
        at = np.flatnonzero(np.arange(n) + width <= end)
        return at, mixed[at].view(np.int64)


def _hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges, a bounded piece of ``data`` at a time; a longer word goes by its pieces' hashes."""
    out = np.empty(len(begins), np.uint64)
    done = 0
    while done < len(begins):
        base = int(begins[done])
        upto = max(done + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        last = int(ends[upto - 1])
        if last - base > SLICE_BYTES:  # one very long word
            parts = [data[i : min(i + SLICE_BYTES, last)] for i in range(base, last, SLICE_BYTES)]
            value = 0
            for part in parts:
                piece = int(((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)]).sum())
                value = (value * _BASE + piece) & ((1 << 64) - 1)
            out[done] = value
        else:
            piece = (data[base:last].astype(np.uint64) + np.uint64(1)) * _UP[: last - base]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece, dtype=np.uint64)])
            b, e = begins[done:upto] - base, ends[done:upto] - base
            out[done:upto] = (total[e] - total[b]) * _DOWN[b] + (e - b).astype(np.uint64) * _MIX
        done = upto
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie between ``offsets`` in ``data`` (UTF-8): A-Z in lower case, ASCII letters and digits and all
    characters beyond ASCII belong to words."""
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] |= inside[edges + 1]
    end[edges - 1] |= inside[edges]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, begins, ends, _hashes(data, begins, ends), np.searchsorted(begins, offsets))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """Row ranges of a string column without nulls and their words; about ``SLICE_BYTES`` at a time, texts whole."""
    if not len(texts):
        return
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        hi = min(hi, len(texts))
        own = offsets[lo : hi + 1]
        yield lo, hi, words_of(data[own[0] : own[-1]], own - own[0])
        lo = hi
