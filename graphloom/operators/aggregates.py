"""Aggregates over groups of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.model.graph import quoted
from graphloom.operators.table import with_row_index


def group(df: DataFrame, by: Sequence[str | Column] = (), **aggregates: Column) -> DataFrame:
    """One row per group; without `by`, one row over everything."""
    keys = [quoted(c) if isinstance(c, str) else c for c in by]
    return df.groupBy(*keys).agg(*[c.alias(alias) for alias, c in aggregates.items()])


def avg(value: Column, as_type: str | T.DataType = "double") -> Column:
    return F.avg(value).cast(as_type)


def count_all() -> Column:
    return F.count(F.lit(1))


def count(value: Column) -> Column:
    return F.count(value)


def count_distinct(value: Column) -> Column:
    return F.count_distinct(value)


def largest(value: Column) -> Column:
    return F.max(value)


def smallest(value: Column) -> Column:
    return F.min(value)


def total(value: Column) -> Column:
    """Sum; a 64-bit overflow is an error."""
    return F.sum(value)


def collect(value: Column) -> Column:
    """Sorted list of the non-null values of a group. The list is one value of one row, so groups have
    to be small; `collect_counted` folds repeated values before they meet, and `collect_segments` makes
    lists of bounded length."""
    return F.sort_array(F.collect_list(value))


def collect_distinct(value: Column) -> Column:
    """Sorted list of the different non-null values of a group."""
    return F.sort_array(F.collect_set(value))


def collect_counted(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Per group the sorted list `name` of `{value, n}`: `collect` with repetitions counted.

    Values are counted per group before groups are put together, so what a group gathers in one task
    is as many entries as it has different values, however many rows it has.
    """
    counted = (
        df.where(quoted(value).isNotNull())
        .groupBy(*[quoted(c) for c in by], quoted(value))
        .agg(F.count(F.lit(1)).alias("@n"))
    )
    entry = F.struct(quoted(value).alias("value"), quoted("@n").alias("n"))
    return counted.groupBy(*[quoted(c) for c in by]).agg(F.sort_array(F.collect_list(entry)).alias(name))


def collect_segments(df: DataFrame, by: Sequence[str], value: str, name: str, size: int = 10_000) -> DataFrame:
    """Per group the non-null values in order, as lists `name` of at most `size` numbered by `segment`.

    All rows are numbered in order of group and value and cut into blocks of `size`; a segment is what
    a block holds of a group. However large a group is, no task holds more of it than a block.
    """
    rows = df.where(quoted(value).isNotNull()).select(*[quoted(c) for c in [*by, value]])
    numbered = with_row_index(rows, *by, value, name="@row")
    block = F.floor(quoted("@row") / F.lit(size)).alias("segment")
    return numbered.groupBy(*[quoted(c) for c in by], block).agg(F.sort_array(F.collect_list(quoted(value))).alias(name))


def repeated(counted: Column) -> Column:
    """The plain sorted list behind a list of `{value, n}`."""
    return F.flatten(F.transform(counted, lambda e: F.array_repeat(e["value"], e["n"].cast("int"))))


def collect_structs(*fields: Column) -> Column:
    """Sorted set of structs, as used to put exploded properties back together."""
    return F.sort_array(F.collect_set(F.struct(*fields)))
