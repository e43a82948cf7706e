"""A property graph: one DataFrame per label combination, one or more per relationship type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphSchemaError
from graphloom.model.schema import GraphSchema, Labels
from graphloom.model.types import common_type, is_subtype, normalize_types

ID, SOURCE, TARGET = "id", "source", "target"


def quoted(name: str) -> Column:
    """Column of exactly this name, dots included."""
    return F.col(sql_name(name))


def sql_name(name: str) -> str:
    """Column name as it stands in an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def _require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise GraphSchemaError(f"{what} lacks column(s) {missing}; it has {df.columns}")


@dataclass(frozen=True)
class Held:
    """Relationships that lie in the rows of the nodes at one of their ends, as foreign keys do.

    `holder` says which end the node is, `other` names the column with the id at the far end, `id`
    the column with the relationship's id, and `properties` its further columns as pairs (property,
    column). A null in `other` is no relationship. Patterns follow a held relationship without joining
    the table it lies in to itself.
    """

    rel_type: str
    holder: str
    other: str
    id: str
    other_labels: Labels = frozenset()
    properties: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        if self.holder not in (SOURCE, TARGET):
            raise GraphSchemaError(f"a relationship is held at its source or its target, not at '{self.holder}'")

    @property
    def columns(self) -> list[str]:
        return [self.id, self.other, *[c for _, c in self.properties]]


@dataclass(frozen=True)
class NodeTable:
    """Nodes of one label combination: column `id`, every other column a property, except those that
    keep relationships."""

    labels: Labels
    df: DataFrame
    held: tuple[Held, ...] = ()

    def __init__(self, labels: Iterable[str] | str, df: DataFrame, held: Iterable[Held] = ()):
        combo = frozenset([labels] if isinstance(labels, str) else labels)
        held = tuple(held)
        _require_columns(df, [ID, *[c for h in held for c in h.columns]], f"node table {sorted(combo)}")
        object.__setattr__(self, "labels", combo)
        object.__setattr__(self, "df", normalize_types(df))
        object.__setattr__(self, "held", held)

    @classmethod
    def mapped(
        cls,
        labels: Iterable[str] | str,
        df: DataFrame,
        id_column: str,
        properties: Mapping[str, str] | None = None,
    ) -> NodeTable:
        """Table whose columns do not follow the convention: `properties` maps property to column."""
        picked = properties if properties is not None else {c: c for c in df.columns if c != id_column}
        _require_columns(df, [id_column, *picked.values()], "mapped node table")
        return cls(labels, df.select(quoted(id_column).alias(ID), *[quoted(c).alias(p) for p, c in picked.items()]))

    @property
    def properties(self) -> dict[str, T.DataType]:
        hidden = {ID, *self.held_columns}
        return {f.name: f.dataType for f in self.df.schema.fields if f.name not in hidden}

    @property
    def held_columns(self) -> list[str]:
        return [c for h in self.held for c in h.columns]

    def holding(self, *types: str) -> NodeTable:
        """The same nodes, keeping of their held relationships only those types."""
        kept = tuple(h for h in self.held if h.rel_type in types)
        dropped = {c for h in self.held if h not in kept for c in h.columns} - {c for h in kept for c in h.columns}
        return NodeTable(self.labels, self.df.drop(*dropped), kept)

    def held_relationships(self) -> list[RelTable]:
        """The relationships kept in these rows, as tables of their own."""
        tables = []
        for held in self.held:
            ends = {held.holder: ID, (TARGET if held.holder == SOURCE else SOURCE): held.other}
            df = self.df.where(quoted(held.other).isNotNull()).select(
                quoted(held.id).alias(ID),
                quoted(ends[SOURCE]).alias(SOURCE),
                quoted(ends[TARGET]).alias(TARGET),
                *[quoted(c).alias(p) for p, c in held.properties],
            )
            labels = {held.holder: self.labels}
            tables.append(
                RelTable(
                    held.rel_type,
                    df,
                    labels.get(SOURCE, held.other_labels),
                    labels.get(TARGET, held.other_labels),
                    held,
                )
            )
        return tables


@dataclass(frozen=True)
class RelTable:
    """Relationships of one type: columns `id`, `source`, `target`, every other column a property.

    `source_labels` and `target_labels` say which labels the endpoints have. They are optional, but a
    pattern reads only the node tables they allow, so declaring them spares whole scans and joins.
    """

    rel_type: str
    df: DataFrame
    source_labels: Labels = frozenset()
    target_labels: Labels = frozenset()
    held: Held | None = None

    def __init__(
        self,
        rel_type: str,
        df: DataFrame,
        source_labels: Iterable[str] = (),
        target_labels: Iterable[str] = (),
        held: Held | None = None,
    ):
        _require_columns(df, [ID, SOURCE, TARGET], f"relationship table {rel_type}")
        object.__setattr__(self, "rel_type", rel_type)
        object.__setattr__(self, "df", normalize_types(df))
        object.__setattr__(self, "source_labels", frozenset(source_labels))
        object.__setattr__(self, "target_labels", frozenset(target_labels))
        object.__setattr__(self, "held", held)

    @classmethod
    def mapped(
        cls,
        rel_type: str,
        df: DataFrame,
        id_column: str,
        source_column: str,
        target_column: str,
        properties: Mapping[str, str] | None = None,
        source_labels: Iterable[str] = (),
        target_labels: Iterable[str] = (),
    ) -> RelTable:
        keys = [id_column, source_column, target_column]
        picked = properties if properties is not None else {c: c for c in df.columns if c not in keys}
        _require_columns(df, [*keys, *picked.values()], "mapped relationship table")
        table = df.select(
            quoted(id_column).alias(ID),
            quoted(source_column).alias(SOURCE),
            quoted(target_column).alias(TARGET),
            *[quoted(c).alias(p) for p, c in picked.items()],
        )
        return cls(rel_type, table, source_labels, target_labels)

    @property
    def properties(self) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in self.df.schema.fields if f.name not in (ID, SOURCE, TARGET)}


@dataclass(frozen=True)
class Picked:
    """A column to read from a table: its new name, the SQL expression for it, and its type."""

    name: str
    sql: str
    type: T.DataType


def picked_columns(df: DataFrame, names: Mapping[str, str] | None = None) -> list[Picked]:
    """The columns of a table, or those named, as a map from new name to column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [Picked(new, sql_name(old), types[old]) for new, old in (names or {c: c for c in types}).items()]


def select_aligned(parts: Sequence[tuple[DataFrame, Sequence[Picked]]]) -> DataFrame:
    """The picked columns of all tables, one below the other: absent columns are null, shared ones get
    a common type."""
    target: dict[str, T.DataType] = {}
    for _, columns in parts:
        for c in columns:
            known = target.get(c.name, c.type)
            joined = known if known == c.type else common_type(known, c.type)
            if joined is None:
                raise GraphSchemaError(
                    f"column '{c.name}' is {known.simpleString()} in one table and {c.type.simpleString()} in another"
                )
            target[c.name] = joined

    def selected(df: DataFrame, columns: Sequence[Picked]) -> DataFrame:
        present = {c.name: c for c in columns}
        if all(name in present and present[name].type == t for name, t in target.items()):
            return df.selectExpr(*[f"{present[name].sql} AS {sql_name(name)}" for name in target])
        return df.select(
            [
                (F.expr(present[name].sql) if name in present else F.lit(None)).cast(t).alias(name)
                if name not in present or present[name].type != t
                else F.expr(f"{present[name].sql} AS {sql_name(name)}")
                for name, t in target.items()
            ]
        )

    return reduce(DataFrame.unionAll, [selected(df, columns) for df, columns in parts])


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """One table holding the rows of all."""
    return tables[0] if len(tables) == 1 else select_aligned([(df, picked_columns(df)) for df in tables])


@dataclass(frozen=True)
class PropertyGraph:
    """A set of node and relationship tables. Ids are unique over all nodes, and over all relationships."""

    spark: SparkSession
    nodes: tuple[NodeTable, ...] = ()
    relationships: tuple[RelTable, ...] = ()
    declared: GraphSchema | None = field(default=None, compare=False)

    @classmethod
    def from_tables(
        cls, *tables: NodeTable | RelTable, schema: GraphSchema | None = None, spark: SparkSession | None = None
    ) -> PropertyGraph:
        """Graph of the given tables, and of the relationships that node tables hold.

        Node tables with equal labels are unioned, as are relationship tables with equal type and
        endpoints. A declared schema is checked against the tables.
        """
        if not tables and spark is None:
            raise GraphSchemaError("an empty graph needs the session it belongs to")
        session = spark or tables[0].df.sparkSession

        node_groups: dict[Labels, list[NodeTable]] = {}
        rel_groups: dict[tuple[str, Labels, Labels], list[RelTable]] = {}
        for table in tables:
            if isinstance(table, NodeTable):
                node_groups.setdefault(table.labels, []).append(table)
        nodes = []
        held: list[RelTable] = []
        for labels, group in node_groups.items():
            alike = all(n.held == group[0].held for n in group)
            merged = NodeTable(
                labels,
                union_tables([n.df if alike else n.df.drop(*n.held_columns) for n in group]),
                group[0].held if alike else (),
            )
            nodes.append(merged)
            held += merged.held_relationships() if alike else [r for n in group for r in n.held_relationships()]
        present = {(r.held, r.source_labels, r.target_labels) for r in held}
        for table in tables:
            # a held relationship comes with its holder; given without it, it is a table like others
            if isinstance(table, RelTable) and (table.held, table.source_labels, table.target_labels) not in present:
                held.append(RelTable(table.rel_type, table.df, table.source_labels, table.target_labels))
        for table in held:
            rel_groups.setdefault((table.rel_type, table.source_labels, table.target_labels), []).append(table)

        graph = cls(
            session,
            tuple(nodes),
            tuple(
                group[0] if len(group) == 1 else RelTable(t, union_tables([r.df for r in group]), s, e)
                for (t, s, e), group in rel_groups.items()
            ),
            schema,
        )
        graph.schema.check()
        if schema is not None:
            graph._check_declared(schema)
        return graph

    @classmethod
    def empty(cls, spark: SparkSession) -> PropertyGraph:
        return cls.from_tables(spark=spark)

    def _check_declared(self, schema: GraphSchema) -> None:
        held = self._inferred()
        for combo, properties in schema.node_properties.items():
            if combo in held.node_properties:
                check_columns(f"node {sorted(combo)}", held.node_properties[combo], properties)
        for rel_type, properties in schema.rel_properties.items():
            if rel_type in held.rel_properties:
                check_columns(f"relationship {rel_type}", held.rel_properties[rel_type], properties)

    def _inferred(self) -> GraphSchema:
        schema = GraphSchema()
        for node in self.nodes:
            schema = schema.with_node(node.labels, node.properties)
        for rel in self.relationships:
            schema = schema.with_relationship(rel.rel_type, rel.properties)
            if rel.source_labels or rel.target_labels:
                schema = schema.with_pattern(rel.source_labels, rel.rel_type, rel.target_labels)
        return schema

    @property
    def schema(self) -> GraphSchema:
        inferred = self._inferred()
        if self.declared is None:
            return inferred
        return inferred._replace(
            patterns=inferred.patterns | self.declared.patterns,
            node_keys=self.declared.node_keys,
            rel_keys=self.declared.rel_keys,
        )

    @property
    def label_combinations(self) -> set[Labels]:
        return {n.labels for n in self.nodes}

    def node_tables(self, labels: Iterable[str] | str = (), exact: bool = False) -> list[NodeTable]:
        """Tables whose nodes carry all the labels; with `exact`, no others."""
        wanted = frozenset([labels] if isinstance(labels, str) else labels)
        return [n for n in self.nodes if (n.labels == wanted if exact else wanted <= n.labels)]

    def rel_tables(self, types: Iterable[str] | str = ()) -> list[RelTable]:
        wanted = {types} if isinstance(types, str) else set(types)
        return [r for r in self.relationships if not wanted or r.rel_type in wanted]

    # -- patterns ---------------------------------------------------------------------------------

    def match(self, var: str, labels: Iterable[str] | str = (), *, exact: bool = False, where=None):
        """Start a pattern at nodes: `(var:labels)`."""
        from graphloom.operators.patterns import match_nodes

        return match_nodes(self, var, labels, exact=exact, where=where)

    def match_relationships(self, var: str, types: Iterable[str] | str = (), *, directed: bool = True, where=None):
        """Relationships with unnamed endpoints: `()-[var:types]->()`, or `()-[var]-()` undirected."""
        from graphloom.operators.patterns import match_relationships

        return match_relationships(self, var, types, directed=directed, where=where)

    # -- whole graph ------------------------------------------------------------------------------

    def counts(self) -> DataFrame:
        """Rows per label combination and relationship type: `kind, name, n`."""
        parts = [
            n.df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("node").alias("kind"), F.lit(":".join(sorted(n.labels))).alias("name"), "n"
            )
            for n in self.nodes
        ] + [
            r.df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("relationship").alias("kind"), F.lit(r.rel_type).alias("name"), "n"
            )
            for r in self.relationships
        ]
        if not parts:
            return self.spark.createDataFrame([], "kind string, name string, n bigint")
        return reduce(DataFrame.unionAll, parts).groupBy("kind", "name").agg(F.sum("n").alias("n"))

    def map_tables(self, change) -> PropertyGraph:
        """Graph with `change(df)` in place of every table."""
        return PropertyGraph(
            self.spark,
            tuple(NodeTable(n.labels, change(n.df), n.held) for n in self.nodes),
            tuple(
                RelTable(r.rel_type, change(r.df), r.source_labels, r.target_labels, r.held)
                for r in self.relationships
            ),
            self.declared,
        )

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> PropertyGraph:
        return self.map_tables(lambda df: df.persist(level))

    def unpersist(self) -> PropertyGraph:
        return self.map_tables(lambda df: df.unpersist())


def check_columns(what: str, actual: Mapping[str, T.DataType], expected: Mapping[str, T.DataType]) -> None:
    """Refuse a table that lacks an expected column or holds it with another type."""
    missing = sorted(set(expected) - set(actual))
    if missing:
        raise GraphSchemaError(f"{what}: declared properties {missing} are not in the table")
    for name, data_type in expected.items():
        if not is_subtype(actual[name], data_type):
            raise GraphSchemaError(
                f"{what}: '{name}' is {actual[name].simpleString()}, declared {data_type.simpleString()}"
            )
