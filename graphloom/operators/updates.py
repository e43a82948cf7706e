"""New versions of document collections: upserts, soft deletes, changed properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.model.graph import quoted
from graphloom.operators.documents import PROPERTY, document_property
from graphloom.operators.table import first_rows

DELETED, LIVE = "Y", "N"


def latest(docs: DataFrame, id: str = "id", order: str = "timestamp") -> DataFrame:
    """The last version of each document. Each partition sends one version of an id; of versions with equal
    time the one with the greater hash stays."""
    rank = [quoted(order).desc(), F.xxhash64(*[quoted(c) for c in docs.columns]).desc()]
    return first_rows(docs, [id], rank).drop("@first")


def upsert(old: DataFrame, new: DataFrame, id: str = "id", order: str = "timestamp") -> DataFrame:
    """`old` with the documents of `new` put in place of those with equal ids, or added."""
    incoming = latest(new, id, order)
    kept = old.join(new.select(quoted(id).alias("@id")).distinct(), quoted(id) == quoted("@id"), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def add_column(docs: DataFrame, name: str, value: Column) -> DataFrame:
    """A copy with one more column, such as `deleted = 'N'`."""
    return docs.withColumn(name, value)


def soft_delete(docs: DataFrame, condition: Column) -> DataFrame:
    """Mark documents as deleted; reads leave them out with `live`."""
    flag = F.coalesce("deleted", F.lit(LIVE)) if "deleted" in docs.columns else F.lit(LIVE)
    return docs.withColumn("deleted", F.when(condition, F.lit(DELETED)).otherwise(flag))


def live(docs: DataFrame) -> DataFrame:
    """Documents that are not marked as deleted. Without a mark a document is live."""
    return docs.where(F.coalesce("deleted", F.lit(LIVE)) != DELETED)


def set_property(docs: DataFrame, key: str, value: Column, data_type: T.DataType, condition: Column | None = None) -> DataFrame:
    """Documents with a property set: the entry of that key is replaced, or added at the end."""
    others = F.filter(F.col("properties"), lambda p: p["key"] != key)
    entry = document_property(key, value, data_type)
    changed = F.array_append(F.coalesce(others, F.array().cast(T.ArrayType(PROPERTY))), entry)
    return docs.withColumn(
        "properties", changed if condition is None else F.when(condition, changed).otherwise(F.col("properties"))
    )


def remove_property(docs: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    others = F.filter(F.col("properties"), lambda p: p["key"] != key)
    return docs.withColumn(
        "properties", others if condition is None else F.when(condition, others).otherwise(F.col("properties"))
    )
