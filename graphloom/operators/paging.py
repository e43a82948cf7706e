"""Rows by their place in an order, found by counting instead of sorting them all.

A bounded sample of the sort keys cuts the order into ranges, and one pass counts the rows of each. That tells which ranges
hold the first and the last row asked for. Only rows of these are numbered, as `with_row_index` does; rows of the
ranges between them are taken as they are, others are left out by a filter. Nothing but the numbered ranges is shuffled or written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.column import Column as ClassicColumn

from graphloom.model.graph import quoted
from graphloom.operators.table import _repeatable, _sort_columns, with_row_index

RANGES = 32
SAMPLE = 1 << 11  # sort keys that the driver gets; they decide where ranges begin, never what is in a page


@dataclass(frozen=True)
class _Key:
    """One column of the order, with its values made comparable."""

    name: str
    column: Column
    descending: bool
    nulls_first: bool

    @classmethod
    def of(cls, df: DataFrame, place: int, column: Column) -> _Key | None:
        """None for values that a bound of plain values cannot be compared with."""
        descending, nulls_first = False, True
        node = column._jc.node()
        if node.getClass().getSimpleName() == "SortOrder":
            descending = "Descending" in node.sortDirection().toString()
            nulls_first = "NullsFirst" in node.nullOrdering().toString()
            column = ClassicColumn(df.sparkSession._jvm.org.apache.spark.sql.Column(node.child()))
        data_type = df.select(column).schema[0].dataType
        if isinstance(data_type, T.TimestampType):
            column = F.unix_micros(column)  # a number, so that the driver needs no time zone
        elif not isinstance(data_type, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.BinaryType)):
            return None
        return cls(f"@key{place}", column, descending, nulls_first)

    def directed(self) -> Column:
        column = quoted(self.name)
        if self.descending:
            return column.desc_nulls_first() if self.nulls_first else column.desc_nulls_last()
        return column.asc_nulls_first() if self.nulls_first else column.asc_nulls_last()

    def after(self, bound) -> Column:
        """Whether a row comes after a value of this column."""
        if bound is None:
            return self.column.isNotNull() if self.nulls_first else F.lit(False)
        after = self.column < F.lit(bound) if self.descending else self.column > F.lit(bound)
        return F.coalesce(after, F.lit(not self.nulls_first))

    def same(self, bound) -> Column:
        return self.column.isNull() if bound is None else self.column.eqNullSafe(F.lit(bound))


def _after(keys: Sequence[_Key], bound: Row) -> Column:
    """Whether a row comes after the keys of a bound."""
    ways = [reduce(and_, [*(k.same(bound[k.name]) for k in keys[:i]), key.after(bound[key.name])]) for i, key in enumerate(keys)]
    return reduce(or_, ways)


def _bounds(df: DataFrame, keys: Sequence[_Key]) -> list[Row]:
    """Different keys, in order, that cut the rows into ranges: those of the SAMPLE rows whose hash, the last key, is least. Each task
    sends no more than that."""
    drawn = df.select(*[k.column.alias(k.name) for k in keys]).orderBy(quoted(keys[-1].name)).limit(SAMPLE).distinct()
    sample = drawn.orderBy(*[k.directed() for k in keys]).collect()
    step = max(1, len(sample) // RANGES)
    return sample[step::step]


def _between(df: DataFrame, order: Sequence[str | Column], first: int, last: int | None) -> DataFrame:
    """Rows `first` to `last` (not included) of the order."""
    df = _repeatable(df)
    columns = _sort_columns(df, order)
    keys = [_Key.of(df, i, c) for i, c in enumerate(columns)]
    told_apart = len(columns) > len(order)
    bounds = _bounds(df, keys) if told_apart and None not in keys else []
    after = [_after(keys, b) for b in bounds]
    place = reduce(lambda n, way: n + way.cast("int"), after, F.lit(0))
    counts = dict(df.groupBy(place.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()) if bounds else {}
    sizes = [counts.get(r, 0) for r in range(len(after) + 1)]
    starts = [0, *accumulate(sizes)]

    def part(low: int, high: int) -> DataFrame:
        """Rows of the ranges `low` to `high`."""
        inside = [*([after[low - 1]] if low else []), *([~after[high]] if high < len(after) else [])]
        return df.where(reduce(and_, inside)) if inside else df

    def numbered(r: int) -> DataFrame:
        rows = with_row_index(part(r, r), *order, name="@row")
        at = F.col("@row") + starts[r]
        return rows.where((at >= first) & (at < last) if last is not None else at >= first).drop("@row")

    if not bounds:
        return numbered(0)
    end = starts[-1] if last is None else min(last, starts[-1])
    hit = [r for r in range(len(sizes)) if starts[r] < end and starts[r + 1] > first]
    cut = [r for r in hit if starts[r] < first or starts[r + 1] > end]
    whole = [r for r in hit if r not in cut]
    parts = [numbered(r) for r in cut] + ([part(whole[0], whole[-1])] if whole else [])
    return reduce(DataFrame.unionAll, parts) if parts else df.where(F.lit(False))


def skip(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """All rows but the first `n` of the order."""
    return _between(df, order, n, None)


def page(df: DataFrame, *order: str | Column, skip: int = 0, limit: int) -> DataFrame:
    """Rows `skip` to `skip + limit` of the order, however many are skipped. Rows that tie are told apart by a hash of the row.
    An order by lists, structs or maps has no bounds of plain values: all rows are one range then."""
    return _between(df, order, skip, skip + limit)
