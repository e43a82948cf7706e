"""Repeated windows next to counting all of them."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from graphloom.llm.recompression import WINDOW, deduplicated, roots
from graphloom.llm.stretches import Windows
from graphloom.llm.text import mixed


def plain(texts, k):
    words = [(t or "").encode().split() for t in texts]
    met = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - k + 1) if met[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def found(frame, windows=WINDOW):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in deduplicated(frame, windows).collect())


def check(spark, texts, windows=WINDOW, parts=3):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(parts)
    assert found(frame, windows) == [(i, *x) for i, x in enumerate(plain(texts, windows.length))]


def spliced(seed, vocabulary, documents=60):
    """Texts made of pieces of one another, with edits."""
    random.seed(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    pool = [[random.choice(words) for _ in range(random.randint(20, 120))] for _ in range(8)]
    texts = []
    for _ in range(documents):
        parts = []
        for _ in range(random.randint(0, 5)):
            piece = list(random.choice(pool))
            a = random.randint(0, 20)
            piece = piece[a : len(piece) - random.randint(0, 20)]
            if piece and random.random() < 0.5:
                piece[random.randrange(len(piece))] = "edited"
            parts += piece + [random.choice(words) for _ in range(random.randint(0, 3))]
        texts.append(random.choice([" ", "\n", "  \t"]).join(parts))
    return texts


@pytest.mark.parametrize("vocabulary", [2, 5, 1000])
def test_spliced_texts(spark, vocabulary):
    check(spark, spliced(vocabulary, vocabulary))


def test_short_windows(spark):
    check(spark, spliced(11, 3), Windows(length=6, choices=3, first=1))


def test_odd_texts_runs_and_copies(spark):
    passage = " ".join(f"p{i}" for i in range(34))
    texts = ["", None, " \n ", "a " * 34, "b " * 35, "c " * 36, "c " * 300 + "d", "ab ab " * 40, passage, passage + " x", passage + " x", passage + " y",
             "z " + passage + " y", "é\xa0ü " * 50, "A " * 36, "q " * 20 + passage + " q" * 20]
    check(spark, texts)


def test_null_ids_repeated_rows_and_no_rows(spark):
    long = " ".join(f"p{i}" for i in range(40))
    frame = spark.createDataFrame([(None, long), (5, long), (5, long), (6, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in deduplicated(frame).collect()) == [(0, 40), (5, 40), (5, 40), (6, 0)]
    assert deduplicated(frame.limit(0)).collect() == []


def test_every_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert found(docs) == [(i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows], 35), strict=True)]


def test_equal_sequences_have_equal_roots():
    random.seed(1)
    sequences = [[random.randint(0, 2) for _ in range(random.randint(1, 9))] for _ in range(5000)]
    flat = mixed(np.array([x for s in sequences for x in s], np.uint64) + np.uint64(1))
    made = roots(flat, np.array([len(s) for s in sequences]))
    names = {}
    for s, r in zip(sequences, made.tolist(), strict=True):
        assert names.setdefault(tuple(s), r) == r
    assert len(set(names.values())) == len(names)


def test_no_shuffle_stays_behind_the_repeats(spark):
    """What tables were made by is gone once they are written."""
    import re

    from graphloom.llm.recompression import repeated_windows
    from graphloom.session import dropped

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"shuffle_\d+", disk.getAllBlocks().mkString(" ")))
    docs = spark.createDataFrame([(i, " ".join(f"w{(i % 3) * k % 97}" for k in range(200))) for i in range(60)], "doc_id long, text string").repartition(3)
    dropped()
    before = shuffles()
    kept = repeated_windows(docs)
    assert len(kept) == 2 and not shuffles() - before
