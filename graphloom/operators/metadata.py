"""What a document collection contains, found by aggregation."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.model.types import java_class_type
from graphloom.operators.documents import VERTEX_DOCUMENT


def _of(datasource: str | None, label: str | None = None) -> Column:
    condition = F.lit(True)
    if datasource is not None:
        condition &= F.col("datasource") == datasource
    if label is not None:
        condition &= F.col("label") == label
    return condition


def datasources(docs: DataFrame) -> DataFrame:
    """`datasource, n`."""
    return docs.groupBy("datasource").agg(F.count(F.lit(1)).alias("n"))


def datasource_sizes(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """`datasource, n_vertices, n_edges`."""
    tagged = vertices.select("datasource", F.lit(1).alias("v"), F.lit(0).alias("e")).unionAll(
        edges.select("datasource", F.lit(0).alias("v"), F.lit(1).alias("e"))
    )
    return tagged.groupBy("datasource").agg(F.sum("v").alias("n_vertices"), F.sum("e").alias("n_edges"))


def labels(docs: DataFrame, datasource: str | None = None) -> DataFrame:
    """`datasource, label, n`."""
    return docs.where(_of(datasource)).groupBy("datasource", "label").agg(F.count(F.lit(1)).alias("n"))


def _entries(docs: DataFrame) -> DataFrame:
    return docs.select("datasource", "label", F.explode("properties").alias("p")).select(
        "datasource", "label", F.col("p.key").alias("key"), F.col("p.type").alias("type")
    )


def keys(docs: DataFrame, datasource: str | None = None, label: str | None = None) -> DataFrame:
    """`datasource, label, key, n`: how often each property key occurs. Entries without a key are left out."""
    entries = _entries(docs.where(_of(datasource, label))).where(F.col("key").isNotNull())
    return entries.groupBy("datasource", "label", "key").agg(F.count(F.lit(1)).alias("n"))


def entry_counts(docs: DataFrame, *by: str) -> DataFrame:
    """`by, datasource, label, whole, key, type, n`: how often each key occurs with each type, and how many documents there are
    (rows that are `whole`, without key and type), in one pass. Counts of parts of a collection add up to those of all of
    it. Entries without a key are left out."""
    document = F.array(F.lit(None).cast("string"))
    none = F.array().cast("array<string>")
    entries = F.arrays_zip(
        *[F.concat(document, F.coalesce(F.col("properties")[f], none)).alias(f) for f in ("key", "type")]
    )
    group = [*by, "datasource", "label"]
    rows = docs.select(*group, F.posexplode(entries).alias("at", "entry")).select(
        *group, (F.col("at") == 0).alias("whole"), F.col("entry.key").alias("key"), F.col("entry.type").alias("type")
    )
    rows = rows.where(F.col("whole") | F.col("key").isNotNull())
    return rows.groupBy(*group, "whole", "key", "type").agg(F.count(F.lit(1)).alias("n"))


def tree(counts: DataFrame, *by: str) -> DataFrame:
    """`by, datasource, label, n_docs, key, type, n_type, n_key`, from the counts of entries.

    The dominant type of a key is the most frequent one, the first by name among equals.
    """
    group = [*by, "datasource", "label"]
    of_key = Window.partitionBy(*group, "whole", "key")
    ranked = counts.select(
        *group, "whole", "key", "type", F.col("n").alias("n_type"), F.sum("n").over(of_key).alias("n_key"),
        F.row_number().over(of_key.orderBy(F.desc("n"), "type")).alias("place"),
    ).where("place = 1")
    whole = ranked.where("whole").select(*[F.col(c).alias(f"@{c}") for c in group], F.col("n_key").alias("n_docs"))
    found = ranked.where("not whole").drop("whole", "place")
    same = [F.col(c).eqNullSafe(F.col(f"`@{c}`")) for c in group]
    joined = whole.join(found, reduce(and_, same), "left")
    return joined.select(*[F.col(f"`@{c}`").alias(c) for c in group], "n_docs", "key", "type", "n_type", "n_key")


def key_types(docs: DataFrame, datasource: str | None = None, label: str | None = None) -> DataFrame:
    """`datasource, label, key, type, n_type, n_key, mixed_types, nullable`.

    `type` is the dominant one and `n_type` its count; `mixed_types` tells that other types occur, and
    `nullable` that some documents of the label lack the key.
    """
    return key_types_of(entry_counts(docs.where(_of(datasource, label))))


def key_types_of(counts: DataFrame) -> DataFrame:
    """The same, from counts of entries."""
    found = tree(counts).where(F.col("key").isNotNull())
    return found.select(
        "datasource",
        "label",
        "key",
        "type",
        "n_type",
        "n_key",
        (F.col("n_type") != F.col("n_key")).alias("mixed_types"),
        (F.col("n_key") < F.col("n_docs")).alias("nullable"),
    )


def scan(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """The whole tree: `kind, datasource, label, n_docs, key, type, n_type, n_key, mixed_types`."""
    columns = ["datasource", "label", "properties"]
    both = vertices.select(F.lit("vertex").alias("kind"), *columns).unionAll(
        edges.select(F.lit("edge").alias("kind"), *columns)
    )
    return scan_of(entry_counts(both, "kind"))


def scan_of(counts: DataFrame) -> DataFrame:
    """The same, from counts of entries by `kind`."""
    return tree(counts, "kind").withColumn("mixed_types", F.col("n_type") != F.col("n_key"))


def collected(df: DataFrame) -> list:
    """Rows of a schema-sized table on the driver, fetched one partition at a time."""
    return list(df.toLocalIterator())


def label_schema(types: dict[str, str]) -> T.StructType:
    """Table schema of a label, from its keys and their type names."""
    base = [f for f in VERTEX_DOCUMENT.fields if f.name != "properties"]
    return T.StructType([*base, *[T.StructField(k, java_class_type(t)) for k, t in types.items()]])
