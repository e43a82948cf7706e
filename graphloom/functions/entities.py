"""Nodes and relationships as struct values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _property_struct(properties: Mapping[str, Column]) -> Column:
    if not properties:
        return F.lit(None).cast(T.StructType())
    return F.struct(*[properties[name].alias(name) for name in sorted(properties)])


def node_struct(element_id: Column, labels: Column, properties: Mapping[str, Column]) -> Column:
    """`{id, labels, properties}`, null for a null id."""
    value = F.struct(element_id.alias("id"), labels.alias("labels"), _property_struct(properties).alias("properties"))
    return F.when(element_id.isNotNull(), value)


def relationship_struct(
    element_id: Column, source: Column, target: Column, rel_type: Column, properties: Mapping[str, Column]
) -> Column:
    """`{id, source, target, type, properties}`, null for a null id."""
    value = F.struct(
        element_id.alias("id"),
        source.alias("source"),
        target.alias("target"),
        rel_type.alias("type"),
        _property_struct(properties).alias("properties"),
    )
    return F.when(element_id.isNotNull(), value)


def keys_of(properties: Mapping[str, Column]) -> Column:
    """Names of the columns that are not null, sorted by name."""
    present = [F.when(properties[name].isNotNull(), F.lit(name)) for name in sorted(properties)]
    return F.array_compact(F.array(*present)) if present else F.array().cast("array<string>")


def labels_from_flags(flags: Mapping[str, Column]) -> Column:
    """Names of the flag columns that are true, sorted by name."""
    return F.array_compact(F.array(*[F.when(flags[name], F.lit(name)) for name in sorted(flags)]))


def type_from_flags(flags: Mapping[str, Column]) -> Column:
    """Name of the first flag column that is true."""
    return F.coalesce(*[F.when(flags[name], F.lit(name)) for name in sorted(flags)])


def entity_id(entity: Column) -> Column:
    return entity["id"]


def labels(node: Column) -> Column:
    return F.array_sort(node["labels"])


def has_label(node: Column, label: str) -> Column:
    return F.array_contains(node["labels"], label)


def rel_type(relationship: Column) -> Column:
    return relationship["type"]


def start_node(relationship: Column) -> Column:
    return relationship["source"]


def end_node(relationship: Column) -> Column:
    return relationship["target"]


def properties(entity: Column) -> Column:
    return entity["properties"]


def with_label(node: Column, label: str) -> Column:
    """The node with one more label."""
    return node.withField("labels", F.array_sort(F.array_union(node["labels"], F.array(F.lit(label)))))


def with_property(entity: Column, name: str, value: Column) -> Column:
    """The node or relationship with a property set."""
    return entity.withField(f"properties.`{name}`", value)


def without_property(entity: Column, name: str) -> Column:
    return entity.withField("properties", entity["properties"].dropFields(name))
