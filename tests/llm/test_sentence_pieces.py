from __future__ import annotations

from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from pairforge.llm import sentence_pieces as S
from pairforge.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = S.read_model(PATH)
VOCABULARY = S.MergeVocabulary(MODEL)
LIBRARY = SentencePieceProcessor(model_file=PATH)
PIECES = ["▁", " ", "  ", "\n", "\t", "\0", "th", "e", "<0x0A>", "<s>", "é", "中", "😀", "́", "﻿", "lo", "ll", "A"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=60).map("".join)))
def test_equals_the_library(text):
    ids = VOCABULARY.encode(text)
    assert ids == LIBRARY.encode(text)
    assert VOCABULARY.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=40))
def test_decodes_any_pieces(ids):
    assert VOCABULARY.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["a" * 100_000, " " * 50_000, "lol" * 30_000, "word " * 40_000, "😀" * 9_000])
def test_long_texts(text):
    ids = VOCABULARY.encode(text)
    assert ids == LIBRARY.encode(text)
    assert VOCABULARY.decode(ids) == text


def test_a_vocabulary_that_crosses_spaces_takes_the_whole_text_as_one_stretch():
    whole = S.MergeVocabulary(MODEL)
    whole.stretch = S.re.compile("(?s).+")
    text = "The cat  sat\non the mat, and  that was that."
    assert whole.encode(text) == VOCABULARY.encode(text)


def test_missing_model_is_told(tmp_path):
    with pytest.raises(FileNotFoundError, match="no SentencePiece model"):
        S.read_model(str(tmp_path / "none.model"))
    with pytest.raises(ValueError, match="merge-type"):
        S.MergeVocabulary(b"")


def test_nulls_repeated_rows_and_clashing_columns(spark, documents):
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, ""), (4, "퟿" * 300), (5, "wor " * 60_000)]
    docs = documents(*rows).selectExpr("*", "1 AS ids", "'d' AS decoded", "false AS agrees")
    got = S.encode_documents(docs, MODEL).collect()
    assert sorted(((r[0], r[2]) for r in got), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert all(r["agrees"] for r in got)
    assert [r["ids"] for r in got if r["doc_id"] in (2, 3)] == [[], []]
    assert S.encode_documents(documents(), MODEL).count() == 0


def test_query_equals_the_library_on_every_document(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {tuple(r) for r in QUERIES["op11_sentence_pieces"](spark, sf_dir).collect()}
    digest = lambda text: sha256(text.encode()).hexdigest()
    expected = set()
    for doc_id, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode(text or "")
        expected.add((doc_id, len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids)), True))
    assert got == expected
