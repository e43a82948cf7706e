"""Exact dedup next to grouping in plain Python, in one batch and in several, with digests that collide."""

import hashlib

import pytest
from pyspark.sql import functions as F

from graphloom.llm import oracle_sql, queries
from graphloom.llm.exact_dedup import ExactDedup, exact_dedup
from tests.compare import connect, spark_rows, sql_rows

TEXTS = ["a", "b", None, "", "a", "A", "a ", "é", "é", "a", "x" * 3_000_000, "x" * 3_000_000, "x" * 2_999_999 + "y", "\x00", "b", "", "a"]


def plain(docs):
    groups = {}
    for id_, text in docs:
        groups.setdefault(text or "", []).append(id_)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs)


def found(frame):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in frame.collect())


def store(spark, path, docs, files, mode="error"):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, digest string, _metadata int")
    frame.repartitionByRange(files, "doc_id").write.mode(mode).parquet(str(path))
    return str(path)


def test_hard_texts(spark, tmp_path):
    docs = list(enumerate(TEXTS))
    assert found(exact_dedup(spark, store(spark, tmp_path / "docs", docs, 3))) == plain(docs)


def test_batches_one_file_at_a_time(spark, tmp_path):
    docs = list(enumerate(TEXTS * 2))
    path = store(spark, tmp_path / "docs", docs, 5)
    dedup = ExactDedup(spark)
    dedup.absorb(path, files_a_batch=1)
    assert found(dedup.decisions(path)) == plain(docs)


def test_later_files_meet_what_earlier_ones_left(spark, tmp_path):
    first, more = list(enumerate(TEXTS)), [(100 + i, t) for i, t in enumerate(TEXTS[::-1] + ["new"])]
    path, folder = store(spark, tmp_path / "docs", first, 2), str(tmp_path / "state")
    assert found(exact_dedup(spark, path, folder=folder)) == plain(first)
    store(spark, tmp_path / "docs", more, 2, "append")
    dedup = ExactDedup(spark, folder=folder)
    dedup.absorb(path)
    assert found(dedup.decisions(path)) == plain(first + more)
    dedup.absorb(path)  # nothing new
    assert dedup.state().agg(F.sum("n")).first()[0] == len(first + more)


@pytest.mark.parametrize("bits", [1, 3])
def test_digests_that_collide(spark, tmp_path, bits):
    docs = [(i, t) for i, t in enumerate([*TEXTS, *(f"t{i % 7}" for i in range(40))])]
    path = store(spark, tmp_path / "docs", docs, 3)
    dedup = ExactDedup(spark, digest=lambda text: F.crc32(text.cast("binary")) % 2**bits)
    dedup.absorb(path, files_a_batch=1)
    assert dedup.state().count() <= 2**bits
    assert found(dedup.decisions(path)) == plain(docs)


def test_ids_that_repeat_or_are_null(spark, tmp_path):
    docs = [(7, "a"), (7, "a"), (None, "a"), (None, "b"), (None, "b")]
    path = store(spark, tmp_path / "docs", docs, 1)
    rows = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(spark, path).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(rows, key=key) == sorted([(7, 7, 3, True), (7, 7, 3, False), (None, 7, 3, False), (None, None, 2, True), (None, None, 2, False)], key=key)


def test_empty_table(spark, tmp_path):
    assert exact_dedup(spark, store(spark, tmp_path / "docs", [], 1)).collect() == []


def test_query(spark, folder):
    out = queries()["op11_exact_dedup"](spark, folder)
    assert spark_rows(out) == sql_rows(connect(folder), oracle_sql()["op11_exact_dedup"])
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
