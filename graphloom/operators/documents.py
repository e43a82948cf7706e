"""Documents whose properties are a list of `{key, type, value}`: packing, typing, regrouping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphError
from graphloom.model.graph import quoted
from graphloom.model.types import java_class_name

PROPERTY = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
_BASE = [
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("datasource", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("label", T.StringType()),
]
_PROPERTIES = T.StructField("properties", T.ArrayType(PROPERTY))
VERTEX_DOCUMENT = T.StructType([*_BASE, _PROPERTIES])
EDGE_DOCUMENT = T.StructType(
    [*_BASE, T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()), _PROPERTIES]
)


def document_property(key: str, value: Column, data_type: T.DataType) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.lit(java_class_name(data_type)).alias("type"),
        value.cast("string").alias("value"),
    )


def pack_documents(
    df: DataFrame,
    datasource: str,
    label: str,
    id: Column,
    properties: Mapping[str, str],
    timestamp: Column | None = None,
    src: Column | None = None,
    dst: Column | None = None,
) -> DataFrame:
    """Rows of a table as documents; `properties` maps key to column, and nulls leave no entry."""
    entries = [
        F.when(quoted(column).isNotNull(), document_property(key, quoted(column), df.schema[column].dataType))
        for key, column in properties.items()
    ]
    packed = F.array_compact(F.array(*entries)) if entries else F.array()
    ends = [src.cast("string").alias("src"), dst.cast("string").alias("dst")] if src is not None else []
    return df.select(
        (timestamp if timestamp is not None else F.lit(None)).cast("timestamp").alias("timestamp"),
        F.lit(datasource).alias("datasource"),
        id.cast("string").alias("id"),
        F.lit(label).alias("label"),
        *ends,
        packed.cast(T.ArrayType(PROPERTY)).alias("properties"),
    )


# -- one property ---------------------------------------------------------------------------------


def property_value(properties: Column, key: str) -> Column:
    """Value of the first entry with this key, or null. Keys and values are taken off the list as two
    lists of texts, which compiles to plain loops, as a lambda over the entries would not."""
    position = F.array_position(properties["key"], F.lit(key)).cast("int")
    return F.get(properties["value"], position - 1)


def has_property(properties: Column, key: str) -> Column:
    return F.array_contains(properties["key"], key)


# -- typed columns --------------------------------------------------------------------------------


#: What a key that a document holds more than once becomes: its first value, a list of all, or a row for each.
FIRST, ALL, ROWS = "first", "all", "rows"


def property_values(properties: Column, key: str, data_type: T.DataType) -> Column:
    """Typed values of all entries with this key, in their order; none is an empty list."""
    own = F.filter(F.coalesce(properties, F.array().cast(T.ArrayType(PROPERTY))), lambda p: p["key"] == key)
    return F.transform(own, lambda p: p["value"].try_cast(data_type))


def _typed(keys: Mapping[str, T.DataType], repeated: str) -> list[Column]:
    if repeated not in (FIRST, ALL, ROWS):
        raise GraphError(f"repeated keys are read as '{FIRST}', '{ALL}' or '{ROWS}', not '{repeated}'")
    properties = F.col("properties")
    if repeated == FIRST:
        return [property_value(properties, key).try_cast(data_type).alias(key) for key, data_type in keys.items()]
    return [property_values(properties, key, data_type).alias(key) for key, data_type in keys.items()]


def _unfolded(df: DataFrame, keys: Mapping[str, T.DataType], repeated: str) -> DataFrame:
    """With `rows`, a row for each value of each key; a key without a value is null."""
    if repeated != ROWS:
        return df
    for key in keys:
        df = df.select(*[F.explode_outer(quoted(c)).alias(c) if c == key else quoted(c) for c in df.columns])
    return df


def explode_vertices(df: DataFrame, keys: Mapping[str, T.DataType], repeated: str = FIRST) -> DataFrame:
    """Vertex documents as a table with one typed column per key.

    Every document carries its own properties, so the columns are read off the list in place: a
    projection, with nothing shuffled however many keys there are. A value its type cannot hold is
    null, and a document without properties keeps its row. Of a key that occurs more than once the
    first entry counts; `repeated` may ask for all values as a list, or for a row of each (of several such
    keys, of each combination). `repeated_keys` finds such documents.
    """
    base = ["timestamp", "datasource", "label", "id", F.col("id").alias("id_")]
    return _unfolded(df.select(*base, *_typed(keys, repeated)), keys, repeated)


def explode_edges(df: DataFrame, keys: Mapping[str, T.DataType], repeated: str = FIRST) -> DataFrame:
    """Edge documents likewise; `src` and `dst` also appear as `source` and `target`."""
    base = [
        "timestamp",
        "datasource",
        "label",
        "id",
        F.col("src").alias("source"),
        F.col("dst").alias("target"),
        F.col("id").alias("id_"),
        "src",
        "dst",
    ]
    return _unfolded(df.select(*base, *_typed(keys, repeated)), keys, repeated)


def repeated_keys(df: DataFrame) -> DataFrame:
    """Documents that hold a key more than once: `id, key, n`."""
    keys = F.transform(F.col("properties"), lambda p: p["key"])
    again = F.filter(
        F.transform(
            F.array_distinct(keys),
            lambda k: F.struct(k.alias("key"), F.size(F.filter(keys, lambda x: x == k)).alias("n")),
        ),
        lambda e: e["n"] > 1,
    )
    return df.select("id", F.inline(again).alias("key", "n"))


# -- exploded properties --------------------------------------------------------------------------


def explode_properties(df: DataFrame, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """One row per property: `keep` columns, then `p_key, p_type, p_value`."""
    exploded = df.select(*[quoted(c) for c in keep], F.explode("properties").alias("property"))
    return exploded.select(
        *[quoted(c) for c in keep],
        F.col("property.key").alias("p_key"),
        F.col("property.type").alias("p_type"),
        F.col("property.value").alias("p_value"),
    )


def typed_values(df: DataFrame, key: str, data_type: str | T.DataType, name: str) -> DataFrame:
    """`id, label` and the typed value of one key, for every entry with that key."""
    rows = explode_properties(df).where(F.col("p_key") == key)
    return rows.select("id", "label", F.col("p_value").try_cast(data_type).alias(name))


def property_structs(exploded: DataFrame, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """Exploded rows with their property as one struct again: `new_property`."""
    return exploded.select(
        *[quoted(c) for c in keep],
        F.struct(
            F.col("p_key").alias("key"), F.col("p_type").alias("type"), F.col("p_value").alias("value")
        ).alias("new_property"),
    )


def regroup_properties(rows: DataFrame, by: Sequence[str] = ("id", "label"), name: str = "arr_properties") -> DataFrame:
    """The different property structs of each document as one sorted list."""
    return rows.groupBy(*[quoted(c) for c in by]).agg(F.sort_array(F.collect_set("new_property")).alias(name))


def distinct_properties(docs: DataFrame, name: str = "arr_properties") -> DataFrame:
    """`id, label` and the different property structs as a sorted list, in place. Where every document
    is one row this is what exploding and regrouping gives, with nothing shuffled."""
    return docs.where(F.size("properties") > 0).select(
        "id", "label", F.sort_array(F.array_distinct("properties")).alias(name)
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each table: `name, n`."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()
    ]
    counted = counts[0]
    for other in counts[1:]:
        counted = counted.unionAll(other)
    return counted
