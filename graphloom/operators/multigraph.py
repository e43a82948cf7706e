"""Graphs made of graphs: unions, and new graphs constructed on old ones."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphSchemaError
from graphloom.model.graph import ID, SOURCE, TARGET, NodeTable, PropertyGraph, RelTable, quoted, sql_name
from graphloom.operators.ids import serialized_id, tagged_id
from graphloom.operators.patterns import Match, flat
from graphloom.operators.table import _holds_map, with_copy_index

_COPY = "@copy"  # a row's number among its copies


def _one_type(types: Iterable[T.DataType]) -> T.DataType:
    """The type all ids have, or string when they differ."""
    found = list({t.simpleString(): t for t in types}.values())
    if not found:
        return T.LongType()
    return found[0] if len(found) == 1 else T.StringType()


def _as(column: Column, held: T.DataType, wanted: T.DataType) -> Column:
    """The id as the wanted type; an id of an earlier union is a struct, whose text keeps both parts."""
    if held == wanted:
        return column
    return F.to_json(column) if isinstance(held, T.StructType) else column.cast(wanted)


@dataclass(frozen=True)
class _IdRule:
    """How the ids of member graphs are written in a union: numbers as `id * members + tag`, which
    stays a number and cannot coincide with an id of another member, anything else as `{graph, id}`.
    A number that grows too large for this is an error."""

    node_type: T.DataType
    rel_type: T.DataType
    members: int

    @classmethod
    def for_graphs(cls, graphs: Sequence[PropertyGraph], members: int) -> _IdRule:
        return cls(
            _one_type(n.df.schema[ID].dataType for g in graphs for n in g.nodes),
            _one_type(r.df.schema[ID].dataType for g in graphs for r in g.relationships),
            members,
        )

    def _id(self, tag: int, column: Column, held: T.DataType, wanted: T.DataType) -> Column:
        if isinstance(wanted, T.LongType):
            return column * F.lit(self.members).cast("long") + F.lit(tag).cast("long")
        tagged = tagged_id(tag, _as(column, held, wanted))
        return F.when(column.isNotNull(), tagged)

    def node_id(self, tag: int, column: Column, held: T.DataType) -> Column:
        return self._id(tag, column, held, self.node_type)

    def rel_id(self, tag: int, column: Column, held: T.DataType) -> Column:
        return self._id(tag, column, held, self.rel_type)


def _tagged(graph: PropertyGraph, tag: int, rule: _IdRule) -> tuple[list[NodeTable], list[RelTable]]:
    nodes = []
    for n in graph.nodes:
        types = {f.name: f.dataType for f in n.df.schema.fields}
        tagged = {ID: rule.node_id(tag, quoted(ID), types[ID])}
        for held in n.held:
            tagged[held.id] = rule.rel_id(tag, quoted(held.id), types[held.id])
            tagged[held.other] = rule.node_id(tag, quoted(held.other), types[held.other])
        nodes.append(NodeTable(n.labels, n.df.withColumns(tagged), n.held))
    rels = [
        RelTable(
            r.rel_type,
            r.df.withColumns(
                {
                    ID: rule.rel_id(tag, quoted(ID), r.df.schema[ID].dataType),
                    SOURCE: rule.node_id(tag, quoted(SOURCE), r.df.schema[SOURCE].dataType),
                    TARGET: rule.node_id(tag, quoted(TARGET), r.df.schema[TARGET].dataType),
                }
            ),
            r.source_labels,
            r.target_labels,
        )
        for r in graph.relationships
        if r.held is None
    ]
    return nodes, rels


def union_graphs(*graphs: PropertyGraph) -> PropertyGraph:
    """Everything in all the graphs. Ids are tagged with their graph, so elements of different members
    stay different even under equal ids."""
    if not graphs:
        raise GraphSchemaError("a union needs at least one graph")
    rule = _IdRule.for_graphs(graphs, len(graphs))
    tables: list[NodeTable | RelTable] = []
    for tag, graph in enumerate(graphs):
        nodes, rels = _tagged(graph, tag, rule)
        tables += [*nodes, *rels]
    return PropertyGraph.from_tables(*tables, spark=graphs[0].spark)


@dataclass(frozen=True)
class Create:
    """`CREATE (source)-[:rel_type {properties}]->(target)` for every row of a match.

    Ends name a node created alongside, or a variable of the match, whose graph is one of those constructed on. Where
    one graph is constructed on twice, `(variable, position of its graph)` says which is meant.
    """

    rel_type: str
    source: str | tuple[str, int]
    target: str | tuple[str, int]
    properties: Mapping[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class CreateNode:
    """`CREATE (name:labels {properties})` for every row of a match."""

    name: str
    labels: Iterable[str]
    properties: Mapping[str, Column] = field(default_factory=dict)


def construct(
    on: Sequence[PropertyGraph], match: Match, create: Sequence[Create | CreateNode]
) -> PropertyGraph:
    """The union of the graphs in `on` plus what each row of `match` creates.

    A created element is identified by the entities and the other values of its row, and by the row's number among its
    copies, so every row creates elements of its own. The rows are written once for that: computing them again after
    a lost executor gives the same ids.
    """
    # created elements have text ids; nodes keep their own type as long as none is created
    creates_nodes = any(isinstance(c, CreateNode) for c in create)
    members = len(on) + 1
    node_type = T.StringType() if creates_nodes else _IdRule.for_graphs(on, members).node_type
    rule = _IdRule(node_type, T.StringType(), members)
    tables: list[NodeTable | RelTable] = []
    for tag, graph in enumerate(on):
        nodes, rels = _tagged(graph, tag, rule)
        tables += [*nodes, *rels]

    fresh = len(on)
    bound = [flat(v, ID) for v in sorted([*match.nodes, *match.rels])]
    plain = sorted(c for c in match.df.columns if "__" not in c and not _holds_map(match.df.schema[c].dataType))
    match = match.with_rows(with_copy_index(match.df, [*bound, *plain], _COPY))

    def row_key(kind: str) -> Column:
        return serialized_id(kind, [_text(match.df, c) for c in [*bound, *plain, _COPY]])

    new_nodes = {c.name: c for c in create if isinstance(c, CreateNode)}

    def end(which: tuple[str, int] | str) -> tuple[Column, frozenset[str]]:
        if isinstance(which, str) and which in new_nodes:
            node = new_nodes[which]
            return rule.node_id(fresh, row_key(node.name), T.StringType()), frozenset(node.labels)
        var = which if isinstance(which, str) else which[0]
        places = [i for i, graph in enumerate(on) if graph is match.home(var)] if var in match.nodes else []
        tag = places[0] if isinstance(which, str) and places else which[1] if isinstance(which, tuple) else None
        if tag is None or (places and tag not in places):
            raise GraphSchemaError(f"'{var}' is no node of a graph that is constructed on, or not of that one")
        combos = match.nodes[var]
        known = next(iter(combos)) if len(combos) == 1 else frozenset()
        return rule.node_id(tag, match.id(var), match.df.schema[flat(var, ID)].dataType), known

    for position, item in enumerate(create):
        if isinstance(item, CreateNode):
            tables.append(
                NodeTable(
                    item.labels,
                    match.df.select(
                        rule.node_id(fresh, row_key(item.name), T.StringType()).alias(ID),
                        *[c.alias(p) for p, c in item.properties.items()],
                    ),
                )
            )
            continue
        source, source_labels = end(item.source)
        target, target_labels = end(item.target)
        tables.append(
            RelTable(
                item.rel_type,
                match.df.select(
                    rule.rel_id(fresh, row_key(f"{item.rel_type}#{position}"), T.StringType()).alias(ID),
                    source.alias(SOURCE),
                    target.alias(TARGET),
                    *[c.alias(p) for p, c in item.properties.items()],
                ),
                source_labels,
                target_labels,
            )
        )
    return PropertyGraph.from_tables(*tables, spark=match.df.sparkSession)


def _text(df: DataFrame, name: str) -> str:
    column = sql_name(name)
    return f"to_json({column})" if isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType)) else column
