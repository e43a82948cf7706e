"""Graphs from rows and DataFrames at hand."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from graphloom.errors import GraphSchemaError
from graphloom.model.graph import NodeTable, PropertyGraph, RelTable
from graphloom.model.schema import GraphSchema
from graphloom.model.types import normalize_types


def _records(rows: Sequence) -> tuple[type, list[dict]]:
    if not rows:
        raise GraphSchemaError("typed rows tell their label by their class; there are none here")
    kind = type(rows[0])
    if any(type(r) is not kind for r in rows):
        raise GraphSchemaError("all rows of a table are of one class")
    if dataclasses.is_dataclass(kind):
        return kind, [dataclasses.asdict(r) for r in rows]
    if hasattr(kind, "_fields"):
        return kind, [r._asdict() for r in rows]
    raise GraphSchemaError(f"{kind.__name__} is neither a dataclass nor a named tuple")


def nodes_from_rows(spark: SparkSession, rows: Sequence) -> NodeTable:
    """Node table of dataclass or named-tuple rows. The label is the class name, unless the class
    says otherwise in `__labels__`."""
    kind, records = _records(rows)
    return NodeTable(getattr(kind, "__labels__", (kind.__name__,)), spark.createDataFrame(records))


def relationships_from_rows(
    spark: SparkSession, rows: Sequence, source_labels: Iterable[str] = (), target_labels: Iterable[str] = ()
) -> RelTable:
    """Relationship table likewise; the type is the class name in capitals, or `__rel_type__`."""
    kind, records = _records(rows)
    rel_type = getattr(kind, "__rel_type__", kind.__name__.upper())
    return RelTable(rel_type, spark.createDataFrame(records), source_labels, target_labels)


def graph_from_rows(spark: SparkSession, nodes: Sequence, relationships: Sequence = ()) -> PropertyGraph:
    tables = [nodes_from_rows(spark, nodes)]
    if relationships:
        tables.append(relationships_from_rows(spark, relationships))
    return PropertyGraph.from_tables(*tables)


def graph_from_frames(
    nodes: dict[str | tuple[str, ...], DataFrame],
    relationships: dict[str, DataFrame] | None = None,
    schema: GraphSchema | None = None,
) -> PropertyGraph:
    """Graph of DataFrames that follow the naming convention, by label(s) and by type."""
    tables = [NodeTable(labels, df) for labels, df in nodes.items()]
    rels = [RelTable(rel_type, df) for rel_type, df in (relationships or {}).items()]
    return PropertyGraph.from_tables(*tables, *rels, schema=schema)


def records(spark: SparkSession, query: str) -> DataFrame:
    """Result of an SQL query with columns of graph types."""
    return normalize_types(spark.sql(query))
