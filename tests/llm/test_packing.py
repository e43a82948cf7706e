"""Packing: pieces cover every document, sequences are full, ids are the tokenizer's."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from graphloom.llm.packing import packed, tokenizer_path

HARD = ["", None, "a", " ", "Don't STOP", "<|endoftext|> x<|startoftext|>y", "日本語 é́", "a\x1cb \x85 \xa0", "word " * 5000, "x" * 3000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, tokenizer):
    """`texts` by id; ids may repeat."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    steps = defaultdict(int)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == own[0].context <= 2048 and at & (at - 1) == 0
        assert len({(r.context, r.step_group) for r in own}) == 1
        steps[own[0].step_group] += at
    assert max(steps.values()) <= 8 * 2048


def test_every_id_lies_in_one_piece(spark, folder, tokenizer):
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(3)
    check(packed(docs, tokenizer_path()).collect(), {r.doc_id: r.text for r in docs.collect()}, tokenizer)


def test_odd_texts_and_extra_columns(spark, tokenizer):
    rows = [(i, t, "x") for i, t in enumerate(HARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").coalesce(1)
    check(packed(docs, tokenizer_path()).collect(), {i: t for i, t, _ in rows}, tokenizer)


def test_null_ids_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (7, "c d"), (7, "c d")], "doc_id long, text string")
    found = packed(docs, tokenizer_path()).collect()
    assert sum(r.length for r in found) == 9
    assert packed(docs.limit(0), tokenizer_path()).collect() == []
