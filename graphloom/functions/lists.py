"""Lists and maps. A map with known keys is a struct."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.entities import keys_of


def list_of(*values: Column) -> Column:
    return F.array(*values)


def map_of(values: Mapping[str, Column]) -> Column:
    if not values:
        return F.lit(None).cast(T.StructType())
    return F.struct(*[v.alias(k) for k, v in values.items()])


def null_of(data_type: str | T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def parameter(value) -> Column:
    """A query parameter as a literal: scalars, lists and maps, nested as they come."""
    if isinstance(value, Mapping):
        return map_of({str(k): parameter(v) for k, v in value.items()})
    if isinstance(value, (list, tuple)):
        return F.array(*[parameter(v) for v in value])
    return F.lit(value)


def size(values: Column) -> Column:
    """Length of a list; null for null."""
    return F.when(values.isNotNull(), F.size(values).cast("long"))


def unwind(values: Column) -> Column:
    """One row per element; no row for null or nothing."""
    return F.explode(values)


def range_(start: Column, end: Column, step: Column | int = 1) -> Column:
    """Whole numbers from `start` to `end`, both included. A step leading away from the end gives an
    empty list; a step of zero is an error."""
    start, end = start.cast("long"), end.cast("long")
    step = F.lit(step).cast("long") if isinstance(step, int) else step.cast("long")
    empty = F.array().cast("array<bigint>")
    toward = ((step > 0) & (start <= end)) | ((step < 0) & (start >= end))
    zero = F.raise_error(F.lit("the step of a range cannot be 0")).cast("array<bigint>")
    return (
        F.when(start.isNull() | end.isNull() | step.isNull(), F.lit(None).cast("array<bigint>"))
        .when(step == 0, zero)
        .when(~toward, empty)
        .otherwise(F.sequence(start, end, step))
    )


def at(values: Column, index: Column) -> Column:
    """Element at a position from 0; null outside the list."""
    return F.get(values, index)


def map_value(df: DataFrame, struct: Column, key: str) -> Column:
    """Value of a key; null if the map has no such key."""
    data_type = df.select(struct.alias("s")).schema["s"].dataType
    if isinstance(data_type, T.StructType):
        return struct.getField(key) if key in data_type.fieldNames() else F.lit(None)
    return F.try_element_at(struct, F.lit(key))


def map_at(values: Column, key: Column) -> Column:
    """Value of a key given by an expression, on a map column; null if absent."""
    return F.try_element_at(values, key)


def map_keys(df: DataFrame, struct: Column) -> Column:
    """Keys with a value, sorted."""
    data_type = df.select(struct.alias("s")).schema["s"].dataType
    return keys_of({name: struct.getField(name) for name in data_type.fieldNames()})


def append(values: Column, element: Column) -> Column:
    return F.array_append(values, element)


def list_literal(values: Sequence, data_type: str | T.DataType) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(T.ArrayType(_type(data_type)))


def _type(data_type: str | T.DataType) -> T.DataType:
    return data_type if isinstance(data_type, T.DataType) else T.DataType.fromDDL(data_type)
