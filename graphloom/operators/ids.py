"""Element ids: from columns of a view, tagged with a graph, or simply unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.errors import GraphError
from graphloom.model.graph import sql_name

TAGS = 128
_FRAME_SHIFT = 55


def _text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def serialized_id(kind: int | str, values: Sequence[str]) -> Column:
    """Key made of the element kind and values, given as SQL expressions. Each value carries its length
    and null has a mark of its own, so different values never make one key."""
    if not values:
        raise GraphError("an id needs at least one column")
    parts = [
        f"coalesce(concat(length(cast({v} AS STRING)), ':', cast({v} AS STRING)), '~')" for v in values
    ]
    return F.expr(f"concat({_text_literal(f'{kind}|')}, {', '.join(parts)})")


def hashed_id(view: str, labels: Sequence[str], values: Sequence[str]) -> Column:
    """64-bit hash of view, labels and values, in the encoding of `serialized_id`. Compact, but of n elements about
    n * n / 2**65 pairs collide: some 27,000 of 10**12. Serialized ids are the default for that reason."""
    kind = "|".join([view, *sorted(labels)])
    return F.xxhash64(serialized_id(kind, values))


def packed_id(tag: int, key: str) -> Column:
    """Long id `key * 128 + tag`: ids with different tags never meet, and equal ids have equal keys.
    A key beyond 56 bits overflows, which ANSI arithmetic (on by default) makes an error. A null key
    gives a null id, so that the condition on an id reaches the file as one on its key."""
    if not 0 <= tag < TAGS:
        raise GraphError(f"tags go from 0 to {TAGS - 1}, not {tag}")
    return F.expr(f"cast({sql_name(key)} AS BIGINT) * {TAGS}L + {tag}L")


def tagged_id(graph_tag: int, element_id: Column) -> Column:
    """Id within a union of graphs: `{graph, id}`."""
    return F.struct(F.lit(graph_tag).cast("long").alias("graph"), element_id.alias("id"))


def generated_id() -> Column:
    """Unique, not consecutive. Rows get other ids when they are computed again: write them first."""
    return F.monotonically_increasing_id()


def add_unique_ids(frames: Sequence[DataFrame], name: str = "id") -> list[DataFrame]:
    """A long id column on each DataFrame, unique over all of them: the position of the DataFrame sits
    above the bits that number partitions and rows. What does not fit these bits is an error, not an id
    given twice: 256 tables, and partitions beyond 4,194,303."""
    if len(frames) > 256:
        raise GraphError("at most 256 tables at once")
    fits = F.spark_partition_id() < 1 << (_FRAME_SHIFT - 33)
    number = F.when(fits, F.monotonically_increasing_id()).otherwise(F.raise_error(F.lit("too many partitions for ids")).cast("long"))
    if any(name in df.columns for df in frames):
        raise GraphError(f"column '{name}' exists already")
    return [
        df.withColumn(name, number.bitwiseOR(F.lit(i << _FRAME_SHIFT)))
        for i, df in enumerate(frames)
    ]


def append_to_path(path: Column, element: Column) -> Column:
    """A list of ids with one more at its end."""
    return F.array_append(path, element)
