"""SentencePiece encoding and unigram counts against the library."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from voxelweave.llm import encoding, piece_model, token_counts
from voxelweave.llm.queries import all_queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  a  b ", "\n\n x\n", "▁▁ a▁b", "日本語 text 😀😀\x00q", "a" * 3000, "\t\t  \n  .", "é́é ﬁ ① Ⅷ ｱﾞ", "　wide space ",
    "İstanbul ſ ½ …", "​zero­soft", " " * 50, "x\r\ny",
]


@pytest.fixture(scope="module")
def mapped_model(tmp_path_factory):
    """The public pieces with a compiled character map, trimming and a dummy prefix."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_normalizer_spec()
    size, head = len(spec), bytearray([0x1A])
    while size >= 0x80:
        head.append(size & 0x7F | 0x80)
        size >>= 7
    head.append(size)
    with open(PATH, "rb") as f:
        proto = f.read() + bytes(head) + spec + bytes([0x1A, 6, 0x18, 1, 0x20, 1, 0x28, 1])
    path = tmp_path_factory.mktemp("model") / "mapped.model"
    path.write_bytes(proto)
    return str(path)


def check(path, texts):
    model = piece_model.open_model(path)
    cache = encoding._segmenter(model)
    for text in texts:
        ids, begins, ends = encoding.encode_text(model, cache, text)
        proto = model.whole.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in proto.pieces], text
        assert begins.tolist() == [p.begin for p in proto.pieces], text
        assert ends.tolist() == [p.end for p in proto.pieces], text


def test_ids_and_spans_equal_the_library(corpus):
    check(PATH, [*TEXTS, *corpus.values()])


def test_character_map_equals_the_library(mapped_model, corpus):
    assert piece_model.open_model(mapped_model).char_map is not None
    check(mapped_model, [*TEXTS, *list(corpus.values())[:60]])


def test_longest_prefix_normalisation(mapped_model):
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    model = piece_model.open_model(mapped_model)
    for text in TEXTS:
        assert piece_model.normalise(model, text)[0] == library.normalize(text), text


def test_query_digests(spark, sf_dir, corpus):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = all_queries()["op1_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        ids = sp.encode(corpus[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_round_trip_and_odd_rows(spark, odd):
    tokens = encoding.encode(odd, PATH).cache()
    assert tokens.count() == odd.count()
    empty = tokens.where("doc_id in (2, 3)").collect()
    assert [r["ids"] for r in empty] == [[1, 2], [1, 2]] and [r["ends"] for r in empty] == [[0, 0], [0, 0]]
    back = encoding.decode(tokens, PATH).where("doc_id = 6").first()["text"]
    assert back == "日本語 and 😀 emoji\nnext line"
    assert encoding.encode(odd.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        encoding.encode(odd, PATH, outputs=("nothing",))


def test_unigram_counts_equal_the_library(spark, corpus, odd):
    counter = token_counts.UnigramCounter(PATH)
    for text in [*TEXTS, *list(corpus.values())]:
        assert counter.count(text)[0] == len(counter.model.whole.encode(text)), text[:80]
    rows = token_counts.token_counts(odd, PATH).collect()
    assert len(rows) == odd.count()
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)] == [0, 0]
    assert token_counts.token_counts(odd.where(F.lit(False)), PATH).count() == 0


def test_cache_limit_changes_nothing():
    cache = piece_model.UnitCache(lambda units: [u.upper() for u in units], limit=3)
    assert cache.get(list("abcab")) == list("ABCAB")
    assert cache.get(list("cdefc")) == list("CDEFC")
