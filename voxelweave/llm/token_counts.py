"""Token counts under a unigram vocabulary without building the tokens.

Method: an Aho-Corasick automaton lists every vocabulary piece ending at each character; a left-to-right dynamic
program carries only the best score and the number of pieces. Tie rule of the tokenizer: at one end, the candidate that
starts first stays unless a later start is strictly better. A character that no single piece covers costs the lowest
score minus 10 and counts as its UTF-8 bytes where the model falls back to bytes, else unknown neighbours count once.

Scores add up across units that no piece can cross, so a unit is solved once per worker and a text is the sum of
its units. Sums are exact doubles; the library adds 32-bit floats, so on very long texts with fractional scores its
rounding may break near-ties otherwise. One map over the documents, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from voxelweave.llm.common import texts_of
from voxelweave.llm.piece_model import UnitCache, normalise, open_model

UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer


class UnigramCounter:
    def __init__(self, path: str):
        self.model = open_model(path, unigram=True)
        sp = self.model.whole
        self.automaton, scores = ahocorasick.Automaton(), []
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)):
                piece, score = sp.id_to_piece(i), sp.get_score(i)
                scores.append(score)
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(scores) - UNKNOWN_PENALTY
        self.cache = UnitCache(lambda units: [self.solve(u) for u in units], limit=1_000_000)

    def solve(self, unit: str) -> complex:
        """Best score (real part) and piece count (imaginary part) of one unit."""
        size = len(unit)
        score: list = [None] * (size + 1)
        count, in_unknown, last = [0] * (size + 1), [False] * (size + 1), 0
        score[0] = 0.0

        def step_unknown(end: int) -> None:
            candidate = score[end - 1] + self.unknown
            if score[end] is None or candidate > score[end]:
                new = len(unit[end - 1].encode()) if self.model.byte_fallback else int(not in_unknown[end - 1])
                score[end], count[end], in_unknown[end] = candidate, count[end - 1] + new, True

        single = False
        for at, (length, value) in self.automaton.iter(unit):
            end = at + 1
            while last < end:  # positions passed without a one-character piece get an unknown step
                if last and not single:
                    step_unknown(last)
                last, single = last + 1, False
            candidate = score[end - length] + value
            if score[end] is None or candidate > score[end]:
                score[end], count[end], in_unknown[end] = candidate, count[end - length] + 1, False
            single = single or length == 1
        while last <= size:
            if last and not single:
                step_unknown(last)
            last, single = last + 1, False
        return complex(score[size], count[size])

    def count(self, text: str) -> tuple[int, float]:
        normalised, _ = normalise(self.model, text, align=False)
        total = sum(self.cache.get(self.model.unit_pattern.findall(normalised)), 0j)
        return int(total.imag), total.real


@lru_cache(maxsize=2)
def _counter(path: str) -> UnigramCounter:
    return UnigramCounter(path)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens`` (no begin or end mark) and ``best_score``.

    The pieces and scores of the model are read as a unigram vocabulary. A null or empty text has 0 tokens and score 0; a
    null id stays null; repeated rows repeat; an empty table gives an empty result; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            found = [counter.count(text.as_py()) for text in batch.column(1)]
            n, score = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(score, pa.float64())],
                names=["doc_id", "n_tokens", "best_score"],
            )

    return texts_of(docs, id_col, text_col).mapInArrow(task, "doc_id long, n_tokens long, best_score double")
