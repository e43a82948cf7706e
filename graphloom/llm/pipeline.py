"""From documents to training sequences, in five stages.

Quality rules, n-gram Jaccard join, suffix-array dedup, secret scans, packing. Each stage works on all that the one before
has kept; all but the last return the columns of `documents`. Between stages the rows are written as Parquet and read again.

A row stands for itself: ids may repeat or be null. Of rows that are equal throughout, or near copies of each other, the join
keeps one, of the least id. Texts that are null or without words do not get past the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.jaccard_join import near_components
from graphloom.llm.packing import packed, tokenizer_path
from graphloom.llm.quality_rules import judged
from graphloom.llm.secret_scans import redacted_text
from graphloom.llm.stretches import Windows
from graphloom.llm.suffix_arrays import first_kept
from graphloom.llm.text import dealt_anew
from graphloom.session import passing_tables, written

PASSAGE = Windows(length=200, choices=96)


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    rows = docs.select(F.struct(*_columns(docs)).alias("_doc"), F.col("text").alias("_text"))
    return judged(rows, text="_text").where("kept").select("_doc.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    row = F.xxhash64("doc_id", "text")
    with passing_tables() as tables:  # the join's own tables hold the texts once more
        found = written(near_components(docs.select(row.alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id"), "row-components")
        tables.remove(found)
    ids = docs.select(row.alias("_row"), "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    kept = ids.join(found.distinct(), "_row").groupBy("component_id").agg(first).select(dealt_anew("first._row", "_row"))
    rows = docs.select(row.alias("_row"), F.struct(*_columns(docs)).alias("_doc")).join(kept, "_row", "left_semi")
    return rows.dropDuplicates(["_row"]).select("_doc.*")


def suffix_arrays(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of the strings of 200 bytes that repeat; the first copy of each stays, that of the least id. A
    passage of over 50 words is longer than that. A later copy of which strings that overlap it, and are first there, would leave more
    than goes, goes as a whole. Characters that lose a byte go with it, and so do documents of which no word is left."""
    left = first_kept(docs, PASSAGE, give_way=True).select("_rest", F.col("kept_text").alias("text"))
    return _with_text(left.where(F.length(F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))) > 0), docs)


def _with_text(clean: DataFrame, docs: DataFrame) -> DataFrame:
    """`_rest` and `text` as the columns of `docs`, with the number of characters brought up to date."""
    out = [F.col("text") if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns]
    frame = clean.select(*out)
    return frame.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else frame


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    rows = docs.select(F.struct(*[c for c, name in zip(_columns(docs), docs.columns, strict=True) if name != "text"]).alias("_rest"), redacted_text(F.col("text")).alias("text"))
    return _with_text(rows, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences."""
    return packed(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("suffix_arrays", suffix_arrays),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: None: shingle components and token ids are beyond SQL; the tests have a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
