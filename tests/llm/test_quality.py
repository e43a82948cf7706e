"""Quality rules next to plain Python, and the classifier on labels it has not seen."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import graphloom.llm.quality_classifier as classifier
import graphloom.llm.quality_rules as rules
from graphloom.llm import oracle_sql, queries
from graphloom.llm.quality_classifier import fitted, learned, scored
from graphloom.llm.quality_rules import Rule, judged, measured
from tests.compare import connect, spark_rows, sql_rows

HARD = [
    "", None, " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x", "a\x0bb\x0cc\r\nd", "é" * 3, "a\xa0b c", "#$%&*|<> ^~",
    "l\nl\nl\n\n\n x\n x", "w " * 3000, " ".join(f"w{i % 700}" for i in range(2000)), "one two three\n" * 20, "\n\n\n", "a\x00b a\x00b a\x00b a\x00b",
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def measures(frame):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {r.doc_id: tuple(r.measures[n] for n in names) for r in measured(frame).collect()}


@pytest.mark.parametrize("bits", [24, 3])
def test_measures_of_hard_texts(spark, monkeypatch, bits):
    """With few bits for the place, windows are sorted by their words."""
    monkeypatch.setattr(rules, "_PLACE_BITS", bits)
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(HARD)], "doc_id long, text string, words int")
    assert measures(frame) == {i: plain(t) for i, t in enumerate(HARD)}


def test_equal_key_bits_of_different_windows(spark, monkeypatch):
    monkeypatch.setattr(rules, "_PLACE_BITS", 58)
    words = " ".join(f"w{i % 150}" for i in range(400))
    assert measures(spark.createDataFrame([(1, words)], "doc_id long, text string")) == {1: plain(words)}


def test_own_rules_and_names_of_broken_ones(spark):
    frame = spark.createDataFrame([(1, "a b c # # #", "k"), (1, "a b c # # #", "k"), (None, None, None)], "doc_id long, text string, kept string")
    frame = frame.withColumnRenamed("kept", "other")
    found = judged(frame, (Rule("marks", "n_symbols", "n_words", most=0.2),), ()).orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert [(r.kept, r.failed, r.other) for r in found] == [(False, ["marks"], "k")] * 2 + [(True, [], None)]
    assert judged(frame.limit(0)).collect() == []


def test_rules_keep_what_is_good(spark):
    folder = "/root/testdata/sf0.01"
    found = judged(spark.read.parquet(f"{folder}/documents.parquet")).where("not base_failed").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    assert found.where("quality = 1 and not kept").count() == 0
    assert found.where("quality = 0 and kept").count() <= 0.05 * found.where("quality = 0").count()


def test_filter_on_a_verdict_stays_above_the_measures(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = judged(docs).where("kept").select("text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sort_array") < 12 and "Python" not in plan


def test_query_gives_the_rows_of_its_sql(spark, folder):
    assert spark_rows(queries()["op10_quality_rules"](spark, folder)) == sql_rows(connect(folder), oracle_sql()["op10_quality_rules"])


def test_classifier_on_labels_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    found = queries()["op8_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    unseen = [r for r in found if r.held_out]
    right = np.mean([r.predicted == r.quality for r in unseen])
    good = np.array([r.score for r in unseen if r.quality == 1])
    bad = np.array([r.score for r in unseen if r.quality == 0])
    assert right > 0.97 and (good[:, None] > bad[None, :]).mean() > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_held_out_labels_change_nothing(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.expr("if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality)"))
    assert learned(docs, labels) == learned(docs, turned)


def test_classifier_without_labels_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(None, None, 0.1), (1, "", 0.2), (1, "", 0.3)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert learned(docs, none) is None
    assert [(r.score, r.predicted) for r in scored(docs, None).collect()] == [(0.5, 0)] * 3
    ranking = fitted(np.eye(9)[:2], np.array([True, False]))
    assert len({r.score for r in scored(docs, ranking).collect()}) == 1
    assert scored(docs.limit(0), ranking).collect() == []


@pytest.mark.parametrize("change", [str, str.upper])
def test_columns_of_any_name(spark, change):
    """Names of inner and new columns: those that are added replace given ones, the others stay."""
    inner = ["_given", "_parts", "_keys", "_pairs", "_places", "_row", "_text", "_label", "_hash", "words", "v", "good"]
    made = ["measures", "base_failed", "failed", "kept", "score", "predicted"]
    names = [change(n) for n in (*inner, *made)]
    frame = spark.createDataFrame([(1, "the word " * 60, *range(len(names)))], ["doc_id", "text", *names])
    for found, new in ((judged(frame), made[:4]), (scored(frame, None), made[4:])):
        assert sorted(c.lower() for c in found.columns) == sorted(["doc_id", "text", *inner, *made])
        row = found.where("doc_id = 1").first()
        assert [row[c] for c in names if c.lower() not in new] == [i for i, c in enumerate(names) if c.lower() not in new]
        assert all(row[c] not in range(2, len(names)) for c in found.columns if c in new)
    assert judged(frame.drop("kept", "KEPT")).where("kept").count() == 0  # repeats itself


def test_one_row_of_each_sampled_id(spark, monkeypatch):
    """Ids that repeat in documents do not add to the sample, and neither order nor tasks decide which row is taken."""
    rows = [(i, " ".join(["the word"] * (i + 2 * j + 1))) for i in range(40) for j in range(5)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    given = []
    monkeypatch.setattr("graphloom.llm.quality_classifier.fitted", lambda values, good: given.append((values.tolist(), good.tolist())))
    for parts in (1, 7):
        learned(spark.createDataFrame(rows[:: 1 if parts == 1 else -1], "doc_id long, text string").repartition(parts), labels, sample=10)
    assert len(given[0][0]) == 10 and given[0] == given[1]


def test_every_label_counts(spark):
    """Labels turned for all ids but the 20,000 of least hash, which were all that was learned from once, change the weights."""
    n = 32_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('The word # ', int(5 + id % 40))").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 40 >= 20).cast("int").alias("quality"))
    first = labels.orderBy(F.xxhash64("doc_id"), "doc_id").where("crc32(cast(doc_id as string)) % 4 <> 2").limit(20_000).select("doc_id", F.lit(1).alias("first"))
    turned = labels.join(first, "doc_id", "left").select("doc_id", F.expr("if(first = 1, quality, 1 - quality)").alias("quality"))
    whole, part = learned(docs, labels), learned(docs, turned)
    assert whole == learned(docs.repartition(3), labels.repartition(5)) and whole != part
    assert max(map(abs, part.weights)) < 0.9 * max(map(abs, whole.weights))


def test_tables_are_fitted_as_arrays_are(spark):
    draw = np.random.default_rng(3)
    values, good = draw.normal(size=(3000, 3)), draw.random(3000) < 0.2
    values[good] += [1.0, 0.5, 0.0]
    table = spark.createDataFrame([(i, v, bool(g)) for i, (v, g) in enumerate(zip(values.tolist(), good.tolist(), strict=True))], "doc_id long, v array<double>, good boolean")
    found, plain = classifier.fitted_on_tables(table, "doc_id"), fitted(values, good)
    assert np.allclose(found.weights, plain.weights, atol=0.12)
    ranked = np.sort(values @ np.array(found.weights))
    assert np.isclose(found.cut, ranked[(~good).sum() - 1 : (~good).sum() + 1].mean()) and np.isclose(found.width, ranked.std())


@pytest.mark.parametrize(("n_good", "n_bad"), [(7, 3), (3, 7), (1, 9), (4, 4)])
def test_every_labelled_row_is_in_pairs(spark, n_good, n_bad):
    rows = [(i, [float(2**i)], i >= n_bad) for i in range(n_good + n_bad)]
    gaps = [r.gap[0] for r in classifier._pairs(spark.createDataFrame(rows, "place long, v array<double>, good boolean"), n_good, n_bad).collect()]
    pairs = {2.0**g - 2.0**b: (g, b) for b in range(n_bad) for g in range(n_bad, n_good + n_bad)}
    assert len(gaps) == classifier.PARTNERS * max(n_good, n_bad)
    assert {x for gap in gaps for x in pairs[gap]} == set(range(n_good + n_bad))
