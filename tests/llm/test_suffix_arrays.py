"""Repeated strings next to counting all of them; factors next to trying every earlier position."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from graphloom.llm.stretches import Windows
from graphloom.llm.suffix_arrays import GROUP, WINDOW, deduplicated, kept_first, longest_previous_factors


def plain(texts, k):
    data = [(t or "").encode() for t in texts]
    met = Counter(d[i : i + k] for d in data for i in range(len(d) - k + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - k + 1):
            if met[d[i : i + k]] > 1:
                gone[i : i + k] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def found(frame, windows=WINDOW, group=GROUP):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in deduplicated(frame, windows, group=group).collect())


def check(spark, texts, windows=WINDOW, group=GROUP):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(3)
    assert found(frame, windows, group) == [(i, *x) for i, x in enumerate(plain(texts, windows.length))]


def spliced(seed, letters, documents=50, longest=900):
    random.seed(seed)
    pool = ["".join(random.choice(letters) for _ in range(random.randint(300, longest))) for _ in range(6)]
    texts = []
    for _ in range(documents):
        out = ""
        for _ in range(random.randint(0, 4)):
            piece = random.choice(pool)
            piece = piece[random.randint(0, 150) :]
            if random.random() < 0.5:
                at = random.randrange(len(piece))
                piece = piece[:at] + "#" + piece[at + 1 :]
            out += piece + "".join(random.choice(letters) for _ in range(random.randint(0, 5)))
        texts.append(out)
    return texts


@pytest.mark.parametrize(("letters", "group"), [("ab", GROUP), ("abcdefgh é", GROUP), ("abcdefgh é", 2), ("abcdefgh é", 0)])
def test_spliced_texts(spark, letters, group):
    """Whatever the size from which a group is counted by windows."""
    check(spark, spliced(len(letters), letters), group=group)


def test_short_strings(spark):
    check(spark, spliced(3, "abc", 30, 320), Windows(length=12, choices=4))


def test_odd_texts_runs_and_copies(spark):
    passage = "".join(random.Random(1).choice("abcdefghij ") for _ in range(399))
    texts = ["", None, "a" * 399, "b" * 400, "c" * 401, "d" * 2000 + "e", "xy" * 500, passage, passage + "x", passage + "x", passage + "y", "z" + passage + "y",
             "é" * 200, "é" * 201, "日本" * 400, "\x00" * 500, "q" * 50 + passage + "q" * 50]
    check(spark, texts)


def test_null_ids_repeated_rows_and_no_rows(spark):
    long = "".join(random.Random(2).choice("abcdefghij ") for _ in range(450))
    frame = spark.createDataFrame([(None, long), (5, long), (5, long), (6, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in deduplicated(frame).collect()) == [(0, 450, 1), (5, 450, 1), (5, 450, 1), (6, 0, 0)]
    assert deduplicated(frame.limit(0)).collect() == []


def test_every_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert found(docs) == [(i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows], 400), strict=True)]


@pytest.mark.parametrize("later", [False, True])
def test_factors(later):
    random.seed(4)
    for length in (3, 9, 20, 33):
        for letters in ("a", "ab", "abcd"):
            data = "".join(random.choice(letters) for _ in range(120)).encode()
            got = longest_previous_factors(np.frombuffer(data, np.uint8), length, later=later)
            whole = longest_previous_factors(np.frombuffer(data, np.uint8), length, later=later, whole=True)
            assert (whole == np.where(got == length, length, 0)).all()
            for i in range(len(data)):
                best = 0
                for j in range(i + 1, len(data)) if later else range(i):
                    k = 0
                    while max(i, j) + k < len(data) and data[i + k] == data[j + k]:
                        k += 1
                    best = max(best, k)
                assert got[i] == min(best, length), (length, letters, i)


def plain_first(rows, order, k):
    """The first of each repeated string stays, later copies go."""
    data = [(t or "").encode() for _, t in rows]
    met = Counter(d[i : i + k] for d in data for i in range(len(d) - k + 1))
    seen, out = set(), {}
    for x in order:
        d = data[x]
        stays, gone = np.zeros(len(d), bool), np.zeros(len(d), bool)
        for i in range(len(d) - k + 1):
            if met[d[i : i + k]] > 1:
                (gone if d[i : i + k] in seen else stays)[i : i + k] = True
                seen.add(d[i : i + k])
        out[x] = bytes(np.frombuffer(d, np.uint8)[~gone | stays])
    return sorted(((rows[x][0] is None, rows[x][0] or 0, out[x]) for x in out))


@pytest.mark.parametrize(("seed", "letters", "group"), [(1, "abcdefghij", GROUP), (2, "ab", GROUP), (3, "abcé", 3)])
def test_the_first_of_each_string_stays(spark, seed, letters, group):
    texts = spliced(seed, letters, documents=24)
    texts += [texts[2], texts[5], "a" * 1500, "a" * 1500, "short", "short", None]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[9]), (None, texts[4]), (None, texts[4])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes = [r.h for r in frame.sparkSession.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i long, t string").selectExpr("i", "xxhash64(coalesce(t, '')) h").orderBy("i").collect()]
    order = sorted(range(len(rows)), key=lambda x: (rows[x][0] is None, rows[x][0] or 0, hashes[x]))
    found = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept)) for r in kept_first(frame, group=group).collect())
    assert found == plain_first(rows, order, WINDOW.length)
    assert kept_first(frame.limit(0)).collect() == []
