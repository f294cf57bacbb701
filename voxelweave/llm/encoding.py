"""SentencePiece encoding with source byte spans, and decoding.

Method: the text is normalised by longest-prefix matching through the model's compiled character map while the
source byte of every normalised byte is recorded; the normalised text is segmented with the model's own merge rules;
every piece is projected through the alignment to a byte span of the original text.

Segmentation runs on units that no piece can cross (see ``piece_model``), each solved once per worker. One map over the
documents, no shuffle: a hot source, copies and long texts change nothing but the work per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import texts_of
from voxelweave.llm.piece_model import PieceModel, UnitCache, normalise, open_model

OUTPUTS = {
    "n_tokens": "long",
    "ids_sha256": "string",
    "decoded_sha256": "string",
    "spans_crc32": "long",
    "ids": "array<int>",
    "begins": "array<int>",
    "ends": "array<int>",
    "decoded": "string",
}


def _segmenter(model: PieceModel):
    def solve(units: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in model.plain.encode(units, num_threads=1)]

    return UnitCache(solve)


def encode_text(model: PieceModel, cache: UnitCache, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids without begin and end marks, and the source byte span ``[begin, end)`` of each."""
    normalised, source = normalise(model, text)
    ids = np.frombuffer(b"".join(cache.get(model.unit_pattern.findall(normalised))), "<u4")
    sizes = model.piece_bytes[ids]
    if not model.byte_fallback and (ids == model.whole.unk_id()).any():
        pieces = (p for u in model.unit_pattern.findall(normalised) for p in model.plain.encode(u, out_type=str))
        sizes = np.array([len(p.encode()) for p in pieces], np.int32)
    ends = np.cumsum(sizes, dtype=np.int64)
    return ids, source[ends - sizes], source[ends]


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids", "begins", "ends", "decoded"),
    add_bos: bool = True,
    add_eos: bool = True,
) -> DataFrame:
    """One row per input row: ``doc_id`` and the chosen ``outputs``.

    ``ids`` (with begin and end marks as asked) equal the sentencepiece library's; ``begins``/``ends`` are byte offsets in
    the original UTF-8 text, marks having empty spans at its two ends; ``decoded`` is the library's text for the ids.
    ``ids_sha256`` digests the ids as little-endian 32-bit integers, ``decoded_sha256`` the decoded UTF-8 text,
    ``spans_crc32`` the begin and end offsets. A null text counts as empty and gives the marks only; a null id
    stays null; repeated rows give repeated rows; an empty table gives an empty result; other columns are ignored.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    wanted = tuple(outputs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        model = open_model(model_path)
        cache = _segmenter(model)
        bos, eos = [model.whole.bos_id()] * add_bos, [model.whole.eos_id()] * add_eos
        for batch in batches:
            out: dict[str, list] = {name: [] for name in wanted}
            for text in batch.column(1):
                text = text.as_py()
                body, begins, ends = encode_text(model, cache, text)
                ids = np.concatenate([bos, body, eos]).astype("<u4")
                size = len(text.encode()) if set(wanted) & {"spans_crc32", "begins", "ends"} else 0
                if "n_tokens" in out:
                    out["n_tokens"].append(len(ids))
                if "ids_sha256" in out:
                    out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
                if "decoded_sha256" in out or "decoded" in out:
                    decoded = model.whole.decode(ids.tolist())
                    if "decoded_sha256" in out:
                        out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if "decoded" in out:
                        out["decoded"].append(decoded)
                if size or "begins" in out or "ends" in out or "spans_crc32" in out:
                    first = np.concatenate([[0] * add_bos, begins, [size] * add_eos]).astype("<i4")
                    last = np.concatenate([[0] * add_bos, ends, [size] * add_eos]).astype("<i4")
                    if "spans_crc32" in out:
                        out["spans_crc32"].append(zlib.crc32(last.tobytes(), zlib.crc32(first.tobytes())))
                    if "begins" in out:
                        out["begins"].append(first)
                    if "ends" in out:
                        out["ends"].append(last)
                if "ids" in out:
                    out["ids"].append(ids.astype("<i4"))
            columns = [batch.column(0), *(pa.array(out[n], kinds[OUTPUTS[n]]) for n in wanted)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *wanted])

    schema = ", ".join(["doc_id long", *(f"{n} {OUTPUTS[n]}" for n in wanted)])
    return texts_of(docs, id_col, text_col).mapInArrow(task, schema)


def decode(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Text of each row's ids (null ids: null text); one map, rows kept as they are."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = open_model(model_path)
        for batch in batches:
            texts = [None if x is None else model.whole.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(task, "doc_id long, text string")
