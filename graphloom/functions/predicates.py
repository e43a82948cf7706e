"""Comparisons and three-valued logic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def equals(left: Column, right: Column) -> Column:
    return left == right


def equals_as(left: Column, right: Column, data_type: str | T.DataType) -> Column:
    """Equality across types: a side that cannot be read as `data_type` makes it null."""
    return left.try_cast(data_type) == right.try_cast(data_type)


def not_(value: Column) -> Column:
    return ~value


def is_null(value: Column) -> Column:
    return value.isNull()


def is_not_null(value: Column) -> Column:
    return value.isNotNull()


exists = is_not_null


def all_of(conditions: Sequence[Column]) -> Column:
    """AND of any number of conditions; true for none."""
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    """OR of any number of conditions; false for none."""
    return reduce(or_, conditions, F.lit(False))


def less(left: Column, right: Column) -> Column:
    return left < right


def less_or_equal(left: Column, right: Column) -> Column:
    return left <= right


def greater(left: Column, right: Column) -> Column:
    return left > right


def greater_or_equal(left: Column, right: Column) -> Column:
    return left >= right


def in_list(element: Column, values: Column) -> Column:
    """Membership; null if the element is null, or absent from a list that holds a null."""
    return F.array_contains(values, element)


def starts_with(text: Column, prefix: Column) -> Column:
    return F.startswith(text, prefix)


def ends_with(text: Column, suffix: Column) -> Column:
    return F.endswith(text, suffix)


def contains(text: Column, part: Column) -> Column:
    return F.contains(text, part)


def matches(text: Column, pattern: str, full: bool = False) -> Column:
    """Regular expression found anywhere in the text, or with `full` covering all of it."""
    return text.rlike(f"^(?:{pattern})$" if full else pattern)


def case(alternatives: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    """CASE WHEN; null without a match and a default."""
    (condition, value), *rest = alternatives
    chosen = F.when(condition, value)
    for condition, value in rest:
        chosen = chosen.when(condition, value)
    return chosen if default is None else chosen.otherwise(default)


def coalesce(*values: Column) -> Column:
    return F.coalesce(*values)
