"""Relational operations on plain DataFrames, with the checks graph code relies on."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphError, GraphSchemaError, GraphTypeError
from graphloom.model.graph import check_columns, quoted
from graphloom.model.types import common_type, widened
from graphloom.session import written

MAX_LIMIT = 2**31 - 1
_ROW_BITS = 2**33 - 1  # monotonically_increasing_id keeps the position within a partition in these bits


def _require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise GraphSchemaError(f"no column(s) {missing}; there are {df.columns}")


def _refuse(df: DataFrame, names: Iterable[str]) -> None:
    present = [n for n in names if n in df.columns]
    if present:
        raise GraphSchemaError(f"column(s) {present} exist already")


# -- projection -----------------------------------------------------------------------------------


def select(df: DataFrame, *columns: str | tuple[str, str]) -> DataFrame:
    """Project columns by exact name (dots included), each optionally renamed: `('a.name', 'name')`."""
    pairs = [(c, c) if isinstance(c, str) else c for c in columns]
    _require(df, [c for c, _ in pairs])
    return df.select([quoted(c).alias(alias) for c, alias in pairs])


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.where(condition)


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Replace columns in place and append new ones, each computed from the columns as they were."""
    return df.withColumns(dict(columns))


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    _refuse(df, columns)
    return df.withColumns(dict(columns))


def replace_column(df: DataFrame, name: str, column: Column) -> DataFrame:
    _require(df, [name])
    return df.withColumn(name, column)


def drop(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; unknown names are ignored."""
    return df.select([quoted(c) for c in df.columns if c not in names])


def drop_existing(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that must be there."""
    _require(df, names)
    return drop(df, *names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; a name that would then occur twice is refused."""
    _require(df, names)
    renamed = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in renamed if renamed.count(c) > 1})
    if twice:
        raise GraphSchemaError(f"renaming makes {twice} ambiguous")
    return df.toDF(*renamed)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def remove_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return rename(df, {c: c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)})


def transform_columns(df: DataFrame, names: Iterable[str], change: Callable[[Column], Column]) -> DataFrame:
    wanted = list(names)
    _require(df, wanted)
    return df.select([change(quoted(c)).alias(c) if c in wanted else quoted(c) for c in df.columns])


# -- order ----------------------------------------------------------------------------------------


def _sort_columns(df: DataFrame, order: Sequence[str | Column]) -> list[Column]:
    """The order, made total: rows that tie are told apart by a hash of the whole row, which also
    lets a range shuffle split a value that many rows share."""
    keys = [quoted(c) if isinstance(c, str) else c for c in order]
    hashable = [quoted(f.name) for f in df.schema.fields if not _holds_map(f.dataType)]
    return [*keys, F.xxhash64(*hashable)] if hashable else keys


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.CalendarIntervalType)


def order_by(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort; nulls first ascending, last descending."""
    return df.orderBy(*_sort_columns(df, order))


def limit(df: DataFrame, n: int) -> DataFrame:
    if not 0 <= n <= MAX_LIMIT:
        raise GraphError(f"limit takes a 32-bit count, not {n}")
    return df.limit(n)


def with_row_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """Number rows from 0 in the given order without bringing them together.

    Rows are range partitioned, sorted and written once; a row's number is its position in its
    partition plus the sizes of the partitions before it. Only those sizes, one per partition, are
    summed in one place.
    """
    _refuse(df, [name])
    keys = _sort_columns(df, order)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("@part", F.spark_partition_id())
        .withColumn("@pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    rows = written(placed, "row-index")
    sizes = rows.groupBy("@part").agg(F.count(F.lit(1)).alias("@size"))
    before = sizes.select(
        "@part",
        (F.sum("@size").over(Window.orderBy("@part")) - F.col("@size")).alias("@before"),
    )
    numbered = rows.join(F.broadcast(before), "@part")  # one row per shuffle partition
    return numbered.select(
        *[quoted(c) for c in df.columns], (F.col("@before") + F.col("@pos")).alias(name)
    )


def with_copy_index(df: DataFrame, by: Sequence[str] | None = None, name: str = "copy_index") -> DataFrame:
    """Number the copies of each row from 0, so that rows that are equal throughout (or in the columns `by`) can be told apart.

    Rows stay in the partitions they are in: they are sorted there, copies side by side, and written once. A row's number
    is its position among the copies of its partition plus those of the partitions before it. Only counts per
    row and partition are shuffled, so a row that makes up much of the table is no larger a task than another; a
    lost executor reads the written rows, and so gives them the same numbers. Maps are not compared.
    """
    _refuse(df, [name, "@key", "@part", "@pos"])
    _require(df, by or [])
    hashable = [quoted(f.name) for f in df.schema.fields if (by is None or f.name in by) and not _holds_map(f.dataType)]
    placed = (
        df.withColumn("@key", F.xxhash64(*hashable) if hashable else F.lit(0).cast("long"))
        .sortWithinPartitions("@key")
        .withColumn("@part", F.spark_partition_id())
        .withColumn("@pos", F.monotonically_increasing_id())
    )
    rows = written(placed, "copies")
    counts = rows.groupBy("@key", "@part").agg(F.count(F.lit(1)).alias("@n"), F.min("@pos").alias("@first"))
    of_key = Window.partitionBy("@key")
    before = F.sum("@n").over(of_key.orderBy("@part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("@n")
    repeated = counts.select("@key", "@part", "@first", before.alias("@before"), F.sum("@n").over(of_key).alias("@all"))
    numbered = rows.join(repeated.where(F.col("@all") > 1).drop("@all"), ["@key", "@part"], "left")
    number = F.coalesce(F.col("@before") + F.col("@pos") - F.col("@first"), F.lit(0).cast("long"))
    return numbered.select(*[quoted(c) for c in df.columns], number.alias(name))


# -- sets -----------------------------------------------------------------------------------------


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Append rows by position; every pair of columns must have one type."""
    if len(left.columns) != len(right.columns):
        raise GraphSchemaError(f"{len(left.columns)} columns against {len(right.columns)}")
    for a, b in zip(left.schema.fields, right.schema.fields):
        if a.dataType != b.dataType and common_type(a.dataType, b.dataType) is None:
            raise GraphSchemaError(f"'{a.name}' {a.dataType.simpleString()} against '{b.name}' {b.dataType.simpleString()}")
    return left.unionAll(right)


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_on(df: DataFrame, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per value of `columns`. With `order` it is the first one in that order.

    Of rows that tie it is any one.
    """
    _require(df, [*columns, *order])
    return drop(first_rows(df, columns, [quoted(c) for c in order] or _sort_columns(df, [])), "@first")


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each value of `by`, with a column `@first`. Rows are ranked by a window whose limit of one is
    applied before the shuffle too, so that each partition sends one candidate per value."""
    place = F.row_number().over(Window.partitionBy(*[quoted(c) for c in by]).orderBy(*order))
    return df.withColumn("@first", place).where(F.col("`@first`") == 1)


# -- joins ----------------------------------------------------------------------------------------


def join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join on pairs of columns, `how` one of inner, left, right, full. The sides share no column name.

    Outer joins are an inner join, whose hot keys Spark can split on either side, and the rows that met nothing, by anti
    joins with the different keys of the other side. In an outer join of Spark's a key that much of the optional side
    has would stay in one task, and in a full join any hot key.
    """
    if how not in ("inner", "left", "right", "full"):
        raise GraphError(f"no join of kind '{how}'")
    if not pairs:
        raise GraphError("a join needs at least one pair of columns")
    shared = sorted(set(left.columns) & set(right.columns))
    if shared:
        raise GraphSchemaError(f"both sides have {shared}")
    _require(left, [a for a, _ in pairs])
    _require(right, [b for _, b in pairs])
    if how != "inner":
        left, right = _repeatable(left), _repeatable(right)
    on = reduce(and_, [quoted(a) == quoted(b) for a, b in pairs])
    joined = left.join(right, on)
    if how in ("left", "full"):
        joined = joined.unionByName(_unmatched(left, right, on, [b for _, b in pairs]), allowMissingColumns=True)
    if how in ("right", "full"):
        joined = joined.unionByName(_unmatched(right, left, on, [a for a, _ in pairs]), allowMissingColumns=True)
    return joined


def _unmatched(rows: DataFrame, others: DataFrame, on: Column, keys: Sequence[str]) -> DataFrame:
    """Rows that meet none of the others; a null key meets none. Of those, each key comes once."""
    return rows.join(others.select(*[quoted(k) for k in dict.fromkeys(keys)]).distinct(), on, "left_anti")


def _repeatable(df: DataFrame) -> DataFrame:
    """The rows, written if computing them again could give others."""
    return df if df._jdf.queryExecution().analyzed().deterministic() else written(df, "rows")


# -- looking --------------------------------------------------------------------------------------


def size(df: DataFrame) -> int:
    return df.count()


def column_type(df: DataFrame, name: str) -> T.DataType:
    _require(df, [name])
    return widened(df.schema[name].dataType, name)


def rows(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time; the driver never holds more than one partition."""
    return df.toLocalIterator()


def for_each_partition(df: DataFrame, visit: Callable[[Iterator[Row]], None]) -> None:
    df.foreachPartition(visit)


def cache(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    return df.persist(level)


def validate(df: DataFrame, expected: Mapping[str, T.DataType]) -> DataFrame:
    """The same table, once every expected column is there with a fitting type."""
    check_columns("table", {f.name: f.dataType for f in df.schema.fields}, expected)
    return df


# -- types ----------------------------------------------------------------------------------------


def binary_to_hex(df: DataFrame) -> DataFrame:
    """Binary columns as hex text, for formats that hold text only."""
    return transform_columns(df, [f.name for f in df.schema.fields if f.dataType == T.BinaryType()], F.hex)


def hex_to_binary(df: DataFrame, *names: str) -> DataFrame:
    return transform_columns(df, names, F.unhex)


def normalize_ids(df: DataFrame, *names: str) -> DataFrame:
    """Id columns as long, string or binary; any other type is refused."""
    _require(df, names)
    changed = {}
    for name in names:
        data_type = widened(df.schema[name].dataType, name)
        if not isinstance(data_type, (T.LongType, T.StringType, T.BinaryType)):
            raise GraphTypeError(f"'{name}' is {data_type.simpleString()}; ids are long, string or binary")
        changed[name] = data_type
    return df.select([quoted(c).cast(changed[c]).alias(c) if c in changed else quoted(c) for c in df.columns])


# -- constants ------------------------------------------------------------------------------------


def unit(spark: SparkSession) -> DataFrame:
    """One row without columns."""
    return spark.range(1).select()


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
