"""A SentencePiece model file opened for work on units: settings, piece table, character map.

The file is a serialised message; joining two serialised messages merges them, later fields winning. That is
used to switch the library's own normaliser off (the text is normalised here, with its alignment) or to read the
same pieces and scores as a unigram vocabulary.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import sentencepiece

SPACE = "▁"
# Serialised settings appended to a model (fixed values of the file format).
UNIGRAM = bytes([0x12, 2, 0x18, 1])  # trainer: model type 1
UNMERGED = b"\x15" + struct.pack("<f", -1e9)  # score of a piece that merging never makes
NO_NORMALISER = bytes([0x1A, 8, 0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0])  # no map, prefix, trimming or escaping


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def message_fields(data: bytes):
    """``(number, value)`` of each field of a serialised message; nested ones stay bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """Compiled normalisation rules: a double-array trie over UTF-8 and a table of replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.replacements = blob[4 + size :]
        self.starters = {b for b in range(256) if self._step(self._offset(self.units[0]), b) is not None}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, node: int, byte: int):
        at = node ^ byte
        if at >= len(self.units):
            return None
        unit = self.units[at]
        return (at, unit) if unit & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest rule that matches at byte ``at``."""
        node, found = self._offset(self.units[0]), None
        for i in range(at, len(data)):
            step = self._step(node, data[i])
            if step is None:
                break
            node = step[0] ^ self._offset(step[1])
            if step[1] >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = self.replacements[start : self.replacements.index(0, start)], i + 1 - at
        return found


@dataclass
class PieceModel:
    """Everything a task needs; built once per Python worker by :func:`open_model`."""

    whole: sentencepiece.SentencePieceProcessor
    plain: sentencepiece.SentencePieceProcessor
    char_map: CharacterMap | None
    dummy_prefix: bool
    trim: bool
    escape: bool
    unit_pattern: re.Pattern
    byte_fallback: bool
    piece_bytes: np.ndarray = field(repr=False)


def _unit_pattern(pieces: list[str], byte_fallback: bool) -> re.Pattern:
    """Cuts normalised text where no piece of the vocabulary can reach across.

    A space mark starts a unit unless some piece holds one after another character; a line end is a unit
    of its own if no piece holds it and unknown characters become bytes (else unknown runs would merge).
    """
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
        return re.compile(r"[\s\S]+")
    if byte_fallback and not any("\n" in p for p in pieces):
        return re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
    return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def as_unigram(proto: bytes) -> bytes:
    """The same pieces and scores under unigram rules.

    Merge models give pieces that no merge makes the score -1e9, beside which a 32-bit float holds no ordinary
    score; such pieces get one less than the lowest ordinary score.
    """
    pieces = [dict(message_fields(value)) for number, value in message_fields(proto) if number == 1]
    scores = (struct.unpack("<f", p[2])[0] for p in pieces if 2 in p)
    lowest = min(s for s in scores if s > -1e9)
    return proto.replace(UNMERGED, b"\x15" + struct.pack("<f", lowest - 1)) + UNIGRAM


@lru_cache(maxsize=4)
def open_model(path: str, unigram: bool = False) -> PieceModel:
    with open(path, "rb") as f:
        proto = f.read()
    if unigram:
        proto = as_unigram(proto)
    settings = {2: b"", 3: 1, 4: 1, 5: 1}
    for number, value in message_fields(proto):
        if number == 3:
            settings |= dict(message_fields(value))
    whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
    plain = sentencepiece.SentencePieceProcessor(model_proto=proto + NO_NORMALISER)
    pieces = [whole.id_to_piece(i) for i in range(whole.get_piece_size())]
    byte = [whole.is_byte(i) for i in range(len(pieces))]
    sizes = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, byte)], np.int32)
    return PieceModel(
        whole,
        plain,
        CharacterMap(settings[2]) if settings[2] else None,
        bool(settings[3]),
        bool(settings[4]),
        bool(settings[5]),
        _unit_pattern([p for p, b in zip(pieces, byte) if not b], any(byte)),
        any(byte),
        sizes,
    )


def normalise(model: PieceModel, text: str, align: bool = True) -> tuple[str, np.ndarray | None]:
    """Normalised text and, per byte of it (and its end), the source byte where its character began."""
    mark = SPACE if model.escape else " "
    if not text:
        return "", np.zeros(1, np.int64) if align else None
    if model.char_map is None and not model.trim:
        prefix = mark if model.dummy_prefix else ""
        out = prefix + (text.replace(" ", SPACE) if model.escape else text)
        return out, _plain_alignment(text.encode(), len(prefix.encode()), 3 if model.escape else 1) if align else None
    data, out, source = text.encode(), bytearray(), []
    start, prefixed, after_space = 0, False, model.trim
    space = mark.encode()
    while start < len(data):
        found = model.char_map.longest(data, start) if model.char_map and data[start] in model.char_map.starters else None
        if found is None:
            size = 1 if data[start] < 0x80 else 2 if data[start] < 0xE0 else 3 if data[start] < 0xF0 else 4
            found = data[start : start + size], size
        piece = found[0].lstrip(b" ") if after_space else found[0]
        if piece:
            if model.dummy_prefix and not prefixed:
                out += space
                source += [start] * len(space)
            prefixed = True
            piece_out = piece.replace(b" ", space) if model.escape else piece
            out += piece_out
            source += [start] * len(piece_out)
            after_space = model.trim and piece.endswith(b" ")
        start += found[1]
    end = len(data)
    while model.trim and out.endswith(space):
        del out[-len(space) :]
        end = source[-len(space)]
        del source[-len(space) :]
    return out.decode(), np.array([*source, end], np.int64) if align else None


def _plain_alignment(data: bytes, prefix: int, space_bytes: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    begins = np.arange(len(raw), dtype=np.int64)
    if (raw >= 0x80).any():  # bytes inside a character point at its first byte
        begins = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, begins, 0))
    if space_bytes > 1:
        begins = np.repeat(begins, np.where(raw == 0x20, space_bytes, 1))
    return np.concatenate([np.zeros(prefix, np.int64), begins, [len(raw)]])


class UnitCache:
    """Remembers a result per unit of text within a worker; ``limit`` bounds its memory, not its answers.

    Workers outlive the steps of a job, so a cache that comes into use empties the one used before it.
    """

    _latest: UnitCache | None = None

    def __init__(self, solve, limit: int = 400_000):
        self.solve, self.limit, self.known = solve, limit, {}

    def get(self, units: list[str]) -> list:
        if UnitCache._latest is not self:
            if UnitCache._latest is not None:
                UnitCache._latest.known.clear()
            UnitCache._latest = self
        known = self.known
        new = [u for u in set(units) if u not in known]
        if new:
            if len(known) + len(new) > self.limit:
                known.clear()
                new = list(set(units))
            known.update(zip(new, self.solve(new)))
        return list(map(known.__getitem__, units))
