"""Functions on lists of structs and of texts, also for use in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphSchemaError


def array_struct_sort(values: Column, field: str) -> Column:
    """List of structs ordered by one field, nulls first; equal structs keep their order."""

    def compare(left: Column, right: Column) -> Column:
        a, b = left[field], right[field]
        return (
            F.when(a.isNull() & b.isNull(), 0)
            .when(a.isNull(), -1)
            .when(b.isNull(), 1)
            .when(a < b, -1)
            .when(a > b, 1)
            .otherwise(0)
        )

    return F.array_sort(values, compare)


def struct_diff(df: DataFrame, left: Column, right: Column) -> Column:
    """Fields in which two structs of one type differ, with the second one's value:
    `array<{field, value}>`, null if there are none."""
    types = df.select(left.alias("l"), right.alias("r")).schema
    names = types["l"].dataType.fieldNames()
    if names != types["r"].dataType.fieldNames():
        raise GraphSchemaError("only structs with the same fields can be compared")
    changed = F.array_compact(
        F.array(
            *[
                F.when(
                    ~left.getField(n).eqNullSafe(right.getField(n)),
                    F.struct(F.lit(n).alias("field"), right.getField(n).cast("string").alias("value")),
                )
                for n in names
            ]
        )
    )
    return F.when(F.size(changed) > 0, changed)


def contains_text(values: Column, text: Column) -> Column:
    return F.array_contains(values, text)


def field_of_each(values: Column, field: str) -> Column:
    """The given field of every struct in the list."""
    return F.transform(values, lambda v: v[field])


def total_text_length(values: Column) -> Column:
    """Sum of the lengths in bytes; null for a null list."""
    return F.aggregate(values, F.lit(0), lambda acc, v: acc + F.coalesce(F.octet_length(v), F.lit(0)))


# SQL forms of the functions above: parameters, result type, expression
SQL_FUNCTIONS = {
    "array_contains_text": ("vals ARRAY<STRING>, txt STRING", "BOOLEAN", "array_contains(vals, txt)"),
    "sum_list_string_length": (
        "vals ARRAY<STRING>",
        "INT",
        "aggregate(vals, 0, (acc, v) -> acc + coalesce(octet_length(v), 0))",
    ),
    "property_get": (
        "props ARRAY<STRUCT<key: STRING, type: STRING, value: STRING>>, name STRING",
        "STRING",
        "get(filter(props, p -> p.key = name), 0).value",
    ),
    "property_keys": (
        "props ARRAY<STRUCT<key: STRING, type: STRING, value: STRING>>",
        "ARRAY<STRING>",
        "transform(props, p -> p.key)",
    ),
    "property_sort": (
        "props ARRAY<STRUCT<key: STRING, type: STRING, value: STRING>>",
        "ARRAY<STRUCT<key: STRING, type: STRING, value: STRING>>",
        "array_sort(props)",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the functions callable in SQL text. They are SQL expressions, so queries stay in the JVM."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return sorted(SQL_FUNCTIONS)


def register_function(spark: SparkSession, name: str, function, data_type: str | T.DataType = "string"):
    """A user's own scalar function for SQL. A Python function costs a trip to a Python worker per
    batch, so give a vectorized one (`pandas_udf`) where no built-in will do."""
    if hasattr(function, "returnType"):
        return spark.udf.register(name, function)
    return spark.udf.register(name, function, data_type)
