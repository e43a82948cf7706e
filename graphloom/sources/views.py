"""Graphs over SQL views: which view holds which nodes, and how edges join to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Protocol
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphError, GraphNotFoundError, GraphSchemaError
from graphloom.model.graph import ID, SOURCE, TARGET, Held, NodeTable, PropertyGraph, RelTable, quoted, sql_name
from graphloom.model.schema import GraphSchema
from graphloom.operators.ids import hashed_id, serialized_id

# Reader options unless others are given.
JDBC_FETCH_SIZE = "100"
CSV_OPTIONS = {"header": "true"}


class ViewReader(Protocol):
    def read(self, spark: SparkSession, view: str) -> DataFrame: ...


@dataclass(frozen=True)
class CatalogViews:
    """Views and tables of the session catalog."""

    def read(self, spark: SparkSession, view: str) -> DataFrame:
        return spark.table(view)


@dataclass(frozen=True)
class JdbcViews:
    """Views of a database, read by several tasks: `partitionColumn`, `lowerBound`, `upperBound` and `numPartitions`
    belong to the options. `one_task` says that a view is small enough to do without."""

    url: str
    driver: str
    options: Mapping[str, str] = field(default_factory=dict)
    one_task: bool = False

    def reader_options(self, view: str) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "fetchSize": JDBC_FETCH_SIZE,
            **self.options,
            "dbtable": view,
        }

    def read(self, spark: SparkSession, view: str) -> DataFrame:
        if "partitionColumn" not in self.options and not self.one_task:
            raise GraphError(f"say how to partition '{view}', or that one task is to read it")
        return spark.read.format("jdbc").options(**self.reader_options(view)).load()


@dataclass(frozen=True)
class FileViews:
    """Views that are files; a relative name is looked up in `base_path`. `schemas` has the columns of views whose
    files do not tell their types: those of text files are texts otherwise, and are not guessed by another pass."""

    format: str
    base_path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)

    def location(self, view: str) -> str:
        if urlparse(view).scheme or view.startswith("/"):
            return view
        if self.base_path is None:
            raise GraphError(f"'{view}' is relative, and the source has no base path")
        return f"{self.base_path.rstrip('/')}/{view}"

    def read(self, spark: SparkSession, view: str) -> DataFrame:
        defaults = CSV_OPTIONS if self.format == "csv" else {}
        reader = spark.read.format(self.format).options(**{**defaults, **self.options})
        reader = reader.schema(self.schemas[view]) if view in self.schemas else reader
        return reader.load(self.location(view))


@dataclass(frozen=True)
class FrameViews:
    """Views at hand as DataFrames."""

    frames: Mapping[str, DataFrame]

    def read(self, spark: SparkSession, view: str) -> DataFrame:
        if view not in self.frames:
            raise GraphNotFoundError(f"no view '{view}'; there are {sorted(self.frames)}")
        return self.frames[view]


@dataclass(frozen=True)
class NodeView:
    """Nodes with `labels` in `view`. `properties` maps property to column, all columns by default;
    `key` names the columns that identify a node, by default those that edges join on."""

    labels: tuple[str, ...]
    view: str
    properties: Mapping[str, str] | None = None
    key: tuple[str, ...] | None = None


@dataclass(frozen=True)
class End:
    """One end of an edge: the node view, and pairs (node column, edge column) to join on."""

    labels: tuple[str, ...]
    view: str
    on: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class EdgeView:
    rel_type: str
    view: str
    start: End
    end: End
    properties: Mapping[str, str] = field(default_factory=dict)
    key: tuple[str, ...] | None = None  # columns that identify an edge; all of them by default


@dataclass(frozen=True)
class ViewGraph:
    """A graph over views. A declared schema gives the property types that columns are cast to."""

    nodes: tuple[NodeView, ...]
    edges: tuple[EdgeView, ...] = ()
    schema: GraphSchema = field(default_factory=GraphSchema)


def column_named(df: DataFrame, name: str) -> str:
    """The column of that name, in whatever case the view spells it."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise GraphSchemaError(f"no column '{name}' among {df.columns}")
    return name if name in found else found[0]


def normalized(df: DataFrame, properties: Mapping[str, str], types: Mapping[str, T.DataType]) -> list[Column]:
    """Property columns, found ignoring case, renamed, and cast to their declared types."""
    picked = []
    for prop, name in properties.items():
        column = quoted(column_named(df, name))
        picked.append((column.cast(types[prop]) if prop in types else column).alias(prop))
    return picked


class ViewGraphSource:
    """Graphs over views of one or more data sources. A view is named `source.view`."""

    def __init__(
        self,
        spark: SparkSession,
        readers: Mapping[str, ViewReader],
        graphs: Mapping[str, ViewGraph],
        hashed_ids: bool = False,
    ):
        self._spark = spark
        self._readers = readers
        self._graphs = graphs
        self._hashed = hashed_ids

    def graph_names(self) -> list[str]:
        return sorted(self._graphs)

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None:
        raise NotImplementedError("a graph over views is read only")

    def delete(self, name: str) -> None:
        raise NotImplementedError("a graph over views is read only")

    def _read(self, view: str) -> DataFrame:
        source, _, rest = view.partition(".")
        if source not in self._readers:
            raise GraphError(f"view '{view}': no data source '{source}' among {sorted(self._readers)}")
        return self._readers[source].read(self._spark, rest)

    def _id(self, labels: Sequence[str], view: str, columns: list[str]) -> Column:
        values = [sql_name(c) for c in columns]
        if self._hashed:
            return hashed_id(view, labels, values)
        return serialized_id(f"{view}|{':'.join(sorted(labels))}", values)

    def graph(self, name: str) -> PropertyGraph:
        if name not in self._graphs:
            raise GraphNotFoundError(name)
        spec = self._graphs[name]
        keys = {(frozenset(n.labels), n.view): self._key(n, spec.edges) for n in spec.nodes}
        holders = {i: self._holder(edge, keys) for i, edge in enumerate(spec.edges)}

        tables: list[NodeTable | RelTable] = []
        for node in spec.nodes:
            df = self._read(node.view)
            key = keys[frozenset(node.labels), node.view] or tuple(c.lower() for c in sorted(df.columns))
            properties = node.properties if node.properties is not None else {c: c for c in df.columns}
            columns = [
                self._id(node.labels, node.view, [column_named(df, c) for c in key]).alias(ID),
                *normalized(df, properties, spec.schema.node_property_keys(node.labels)),
            ]
            held = []
            for i, edge in enumerate(spec.edges):
                if holders[i] is not None and holders[i][1] == (frozenset(node.labels), node.view):
                    lies, edge_columns = self._held(f"@{i}", edge, holders[i][0], df, keys, spec.schema)
                    held.append(lies)
                    columns += edge_columns
            tables.append(NodeTable(node.labels, df.select(columns), held))

        for i, edge in enumerate(spec.edges):
            if holders[i] is None:
                df = self._read(edge.view)
                ends = {SOURCE: edge.start, TARGET: edge.end}
                tables.append(
                    RelTable(
                        edge.rel_type,
                        df.select(
                            self._edge_id(edge, df).alias(ID),
                            *[self._end_id(edge, end, df, keys).alias(side) for side, end in ends.items()],
                            *normalized(df, edge.properties, spec.schema.relationship_property_keys(edge.rel_type)),
                        ).where(quoted(SOURCE).isNotNull() & quoted(TARGET).isNotNull()),
                        edge.start.labels,
                        edge.end.labels,
                    )
                )
        return PropertyGraph.from_tables(*tables, schema=spec.schema, spark=self._spark)

    def _edge_id(self, edge: EdgeView, df: DataFrame) -> Column:
        columns = sorted(df.columns) if edge.key is None else [column_named(df, c) for c in edge.key]
        return self._id([edge.rel_type], f"{edge.view}|{edge.start.view}|{edge.end.view}", columns)

    def _end_id(self, edge: EdgeView, end: End, df: DataFrame, keys: Mapping) -> Column:
        """Id of the node at an end, made of the edge's columns as the node's is made of its own. A null
        among them joins to no node and gives no id."""
        key = keys.get((frozenset(end.labels), end.view))
        if key is None:
            raise GraphSchemaError(f"{edge.rel_type} ends at nodes {end.labels} of '{end.view}', which are none")
        by_node_column = {node.lower(): column for node, column in end.on}
        columns = [column_named(df, by_node_column[c]) for c in key]
        complete = reduce(and_, [quoted(c).isNotNull() for c in columns])
        return F.when(complete, self._id(end.labels, end.view, columns))

    @staticmethod
    def _holder(edge: EdgeView, keys: Mapping) -> tuple[str, tuple] | None:
        """The end whose nodes are the rows of the edge view itself, joined to themselves on their key."""
        for side, end in ((SOURCE, edge.start), (TARGET, edge.end)):
            node = (frozenset(end.labels), end.view)
            same = all(a.lower() == b.lower() for a, b in end.on)
            if end.view == edge.view and same and keys.get(node) == tuple(sorted(a.lower() for a, _ in end.on)):
                return side, node
        return None

    def _held(self, prefix, edge, side, df, keys, schema) -> tuple[Held, list[Column]]:
        """An edge in the rows of its nodes, and the columns that keep it there."""
        far = edge.end if side == SOURCE else edge.start
        properties = normalized(df, edge.properties, schema.relationship_property_keys(edge.rel_type))
        names = [(p, f"{prefix}.{p}") for p in edge.properties]
        held = Held(edge.rel_type, side, f"{prefix}.other", f"{prefix}.id", frozenset(far.labels), tuple(names))
        return held, [
            self._edge_id(edge, df).alias(held.id),
            self._end_id(edge, far, df, keys).alias(held.other),
            *[c.alias(name) for c, (_, name) in zip(properties, names)],
        ]

    @staticmethod
    def _key(node: NodeView, edges: Sequence[EdgeView]) -> tuple[str, ...]:
        """Columns of the node view that make its ids: all edges have to join on the same ones."""
        if node.key is not None:
            return tuple(sorted(c.lower() for c in node.key))
        used = {
            tuple(sorted(column.lower() for column, _ in end.on))
            for edge in edges
            for end in (edge.start, edge.end)
            if end.view == node.view and frozenset(end.labels) == frozenset(node.labels)
        }
        if len(used) > 1:
            raise GraphSchemaError(f"edges join '{node.view}' on different columns: {sorted(used)}")
        return next(iter(used), ())
