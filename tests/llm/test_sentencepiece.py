"""Encoding and decoding next to the library's own."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from graphloom.llm.sentencepiece_bpe import PieceModel, encoded, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", "a", " ", "  a", "a  ", "▁x", " ▁x", "\n", "a" * 3000, "<s>", "<0x0A>", "日本語テスト", "🙂🙂", " " * 40 + "b", "\x00a", "é́", "a\tb"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_of_the_library(library):
    random.seed(3)
    letters = "abcdehilnorst  ▁'\n.ABéßжα日🙂0123456789_=(){}"
    texts = HARD + ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(500)]
    texts += ["".join(random.choice("ab ") for _ in range(random.randint(0, 200))) for _ in range(200)]
    model = PieceModel(PATH)
    ids, counts = model.encode([*texts, None])
    edges = np.cumsum([0, *counts])
    decoded = model.decode(ids, counts)
    for i, text in enumerate([*texts, ""]):
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert ids[edges[i] : edges[i + 1]].tolist() == expected
        assert decoded[i].decode() == library.decode(expected)


def test_digests_of_every_document(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in round_trip(docs, PATH).collect()}
    for r in docs.collect():
        ids = library.encode(r.text, add_bos=True, add_eos=True)
        assert found[r.doc_id].n_tokens == len(ids)
        assert found[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_repeated_rows_extra_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (7, "", 2), (7, "", 3)], "doc_id long, text string, ids int")
    assert [(r.doc_id, r.ids) for r in encoded(docs, PATH).collect()] == [(None, [1, 2]), (7, [1, 2]), (7, [1, 2])]
    assert encoded(docs.limit(0), PATH).collect() == []
