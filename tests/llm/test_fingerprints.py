"""Signatures next to sets of shingles, edited texts next to plain slicing."""

import hashlib
import random

import pyarrow as pa
import pytest

from graphloom.llm.fingerprints import compared_with_next, fingerprinted, near_pairs, signatures


def shingle_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    """`docs`: (id, text) in the order of the operator."""
    texts = [t or "" for _, t in docs]
    assert len(rows) == len(docs)
    by_text = {}
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    errors = []
    for i, (doc, _) in enumerate(docs):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r = next(r for r in found[doc] if r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_next <= 1
        errors += [abs(r.near_edited - jaccard(text, edited)), abs(r.near_next - jaccard(text, after))]
    assert sum(errors) / len(errors) < 0.06 and max(errors) < 0.35


def test_every_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(3)
    check(compared_with_next(docs).collect(), sorted((r.doc_id, r.text) for r in docs.collect()))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_odd_texts_nulls_and_ties(spark, parts):
    words = [f"w{i}" for i in range(400)]
    random.seed(parts)
    docs = [(None, ""), (None, "a b"), (1, ""), (1, "x y z"), (1, "x y z"), (5, "é" * 9), (9, " ".join(words)), (12, " ".join(random.sample(words, 300)))]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_range string").repartition(parts)
    check(compared_with_next(frame).collect(), docs)


def test_rows_that_come_in_many_batches(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 40")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        check(compared_with_next(docs).collect(), sorted((r.doc_id, r.text) for r in docs.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(3, "a b c d e f g h")], "doc_id long, text string")
    check(compared_with_next(one).collect(), [(3, "a b c d e f g h")])
    assert compared_with_next(one.limit(0)).collect() == []
    assert fingerprinted(one.limit(0)).collect() == []


def test_near_pairs_are_verified(spark):
    words = [f"w{i}" for i in range(200)]
    base = " ".join(words)
    near = " ".join(words[:195])
    far = " ".join(words[:120] + [f"v{i}" for i in range(80)])
    docs = spark.createDataFrame([(1, base), (2, near), (3, far), (4, base), (5, ""), (6, None)], "doc_id long, text string")
    found = near_pairs(docs).collect()
    assert len(found) == 1 and found[0].jaccard == pytest.approx(jaccard(base, near))


@pytest.mark.parametrize("block", [512, 7])
def test_near_pairs_of_a_family_of_many_variants(spark, block):
    """Next to all pairs that agree on a band."""
    rnd = random.Random(12)
    vocabulary, texts = [f"w{i}" for i in range(2000)], []
    for _ in range(2):
        base = [rnd.choice(vocabulary) for _ in range(300)]
        for _ in range(40):
            words = list(base)
            for _ in range(rnd.randint(0, 6)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    texts = sorted(set(texts))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    key = {r.text: r.key for r in docs.selectExpr("text", "xxhash64(text) key").collect()}
    bands = signatures(pa.array(texts)).reshape(len(texts), 16, 4)
    expected = {}
    for i, a in enumerate(texts):
        for j in range(i):
            likeness = jaccard(a, texts[j])
            if likeness >= 0.8 and (bands[i] == bands[j]).all(axis=1).any():
                expected[tuple(sorted((key[a], key[texts[j]])))] = pytest.approx(likeness)
    found = near_pairs(docs, block=block).collect()
    assert len(expected) > 500 and len(found) == len(expected)
    assert {(r.key_a, r.key_b): r.jaccard for r in found} == expected


def test_ids_are_whole_numbers(spark):
    with pytest.raises(TypeError):
        compared_with_next(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
    large = 2**62
    rows = [(large + i, f"text {i} of many") for i in range(50)] + [(None, "no id")]
    found = compared_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [large + i for i in range(50)] and len(found) == 51
