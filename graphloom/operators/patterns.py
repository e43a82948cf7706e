"""Pattern matching: node and relationship scans, expansion, optional and existential parts.

While matching, an entity variable owns flat columns: `a__id`, `a__@labels` and one `a__<property>`
each, so that column pruning and predicate pushdown reach every scan through every join. `entity()`
folds them into one struct when a whole node or relationship is returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphSchemaError, UnboundVariable
from graphloom.functions.entities import keys_of, node_struct, relationship_struct
from graphloom.model.graph import (
    ID,
    SOURCE,
    TARGET,
    Held,
    NodeTable,
    Picked,
    PropertyGraph,
    RelTable,
    picked_columns,
    quoted,
    select_aligned,
    sql_name,
    union_tables,
)
from graphloom.model.schema import Labels
from graphloom.session import written

LABELS, TYPE, FROM, TO = "@labels", "@type", "@from", "@to"
OUT, IN, BOTH = "out", "in", "both"


def flat(var: str, name: str) -> str:
    """Column that holds property `name` of variable `var`."""
    return f"{var}__{name}"


def _check_var(var: str) -> str:
    if "__" in var or not var:
        raise GraphSchemaError(f"'{var}' cannot name a variable")
    return var


def _as_set(names: Iterable[str] | str) -> frozenset[str]:
    return frozenset([names] if isinstance(names, str) else names)


@dataclass(frozen=True)
class Match:
    """Rows of bound variables. Every method gives a new Match, or a plain DataFrame of results."""

    graph: PropertyGraph
    df: DataFrame
    nodes: Mapping[str, frozenset[Labels]]
    rels: Mapping[str, frozenset[str]]
    open_rels: tuple[str, ...] = ()
    open_paths: Mapping[str, frozenset[str]] = field(default_factory=dict)
    scanned: tuple[str, object] | None = None  # variable and condition, while these rows are a plain scan
    homes: Mapping[str, PropertyGraph] = field(default_factory=dict)  # graphs of variables of other graphs

    # -- columns ----------------------------------------------------------------------------------

    def __getitem__(self, name: str) -> Column:
        """`m['a.age']`: a property, null where the entity has none of that name. `m['a']`: the entity."""
        var, dot, prop = name.partition(".")
        if not dot:
            return self.entity(var) if var in self.nodes or var in self.rels else quoted(var)
        column = flat(var, prop)
        if column in self.df.columns:
            return quoted(column)
        self._require(var)
        return F.lit(None)

    def _require(self, var: str) -> None:
        if var not in self.nodes and var not in self.rels:
            raise UnboundVariable(f"no variable '{var}' in this match")

    def id(self, var: str) -> Column:
        self._require(var)
        return quoted(flat(var, ID))

    def labels(self, node: str) -> Column:
        self._require(node)
        return quoted(flat(node, LABELS))

    def has_label(self, node: str, label: str) -> Column:
        return F.array_contains(self.labels(node), label)

    def type(self, rel: str) -> Column:
        return quoted(flat(rel, TYPE))

    def has_type(self, rel: str, rel_type: str) -> Column:
        return self.type(rel) == rel_type

    def start_node(self, rel: str) -> Column:
        return quoted(flat(rel, SOURCE))

    def end_node(self, rel: str) -> Column:
        return quoted(flat(rel, TARGET))

    def property_names(self, var: str) -> list[str]:
        hidden = {ID} if var in self.nodes else {ID, SOURCE, TARGET}
        names = [c[len(var) + 2 :] for c in self.df.columns if c.startswith(f"{var}__")]
        return sorted(n for n in names if n not in hidden and not n.startswith("@"))

    def properties(self, var: str) -> Column:
        names = self.property_names(var)
        return F.struct(*[quoted(flat(var, n)).alias(n) for n in names]) if names else F.lit(None).cast(T.StructType())

    def keys(self, var: str) -> Column:
        """Names of the properties the entity has, sorted."""
        return keys_of({n: quoted(flat(var, n)) for n in self.property_names(var)})

    def entity(self, var: str) -> Column:
        """The whole node or relationship as a struct; null where an optional part did not match."""
        self._require(var)
        properties = {n: quoted(flat(var, n)) for n in self.property_names(var)}
        if var in self.nodes:
            return node_struct(self.id(var), self.labels(var), properties).alias(var)
        return relationship_struct(
            self.id(var), self.start_node(var), self.end_node(var), self.type(var), properties
        ).alias(var)

    def home(self, var: str) -> PropertyGraph:
        """The graph a variable is bound in."""
        return self.homes.get(var, self.graph)

    # -- rows -------------------------------------------------------------------------------------

    def with_rows(self, df: DataFrame) -> Match:
        return replace(self, df=df, scanned=None)

    def where(self, condition) -> Match:
        return self.with_rows(_filtered(self, condition).df)

    def with_column(self, name: str, column: Column) -> Match:
        return self.with_rows(self.df.withColumn(name, column))

    def next_pattern(self) -> Match:
        """Begin another MATCH: its relationships may repeat those bound so far."""
        return replace(self, open_rels=(), open_paths={})

    def select(self, *columns: Column | str, **named: Column | str) -> DataFrame:
        """RETURN: names like `a.name` or `a`, and aliases as keyword arguments."""
        picked = [self._named(c) if isinstance(c, str) else c for c in columns]
        picked += [(self[c] if isinstance(c, str) else c).alias(alias) for alias, c in named.items()]
        return self.df.select(*picked)

    def _named(self, name: str) -> Column:
        """`a.name` comes out as `a_name`; a plain column under its own name."""
        return self[name].alias(name.replace(".", "_"))

    def group(self, by: Iterable[str] = (), keep: Mapping[str, Iterable[str]] | None = None, **aggregates) -> DataFrame:
        """Aggregate by entities (`'a'`), properties (`'a.name'`) or plain columns.

        Grouping by an entity means by its id. `keep` names the properties to carry along: they
        depend on the id, so as further grouping keys they leave the groups as they are and the
        aggregation stays hash based. Without `keep` all the properties of a node come along: they are
        read for the groups, after the aggregation.
        """
        keys: list[Column] = []
        read: list[str] = []
        for name in by:
            if name in self.nodes and name not in (keep or {}):
                read.append(name)
                keys.append(self.id(name).alias(f"{name}_id"))
            elif name in self.nodes or name in self.rels:
                props = (keep or {}).get(name, self.property_names(name))
                keys.append(self.id(name).alias(f"{name}_id"))
                keys += [self[f"{name}.{p}"].alias(f"{name}_{p}") for p in props]
            else:
                keys.append(self._named(name))
        groups = self.df.groupBy(*keys).agg(*[c.alias(alias) for alias, c in aggregates.items()])
        columns = list(groups.columns)
        for name in read:
            nodes = _node_scan(self.home(name), name, self.nodes[name])
            props = [p for p in self.property_names(name) if flat(name, p) in nodes.columns]
            nodes = nodes.select(quoted(flat(name, ID)).alias("@id"), *[quoted(flat(name, p)).alias(f"{name}_{p}") for p in props])
            groups = groups.join(nodes, quoted(f"{name}_id") == quoted("@id"), "left").drop("@id")
            at = columns.index(f"{name}_id") + 1
            columns[at:at] = [f"{name}_{p}" for p in props]
        return groups.select([quoted(c) for c in columns])

    # -- growing the pattern ----------------------------------------------------------------------

    def expand(
        self,
        source: str,
        rel: str,
        target: str | None = None,
        *,
        types: Iterable[str] | str = (),
        labels: Iterable[str] | str = (),
        direction: str = OUT,
        where=None,
        rel_where: Mapping[str, object] | None = None,
        node_where: Mapping[str, object] | None = None,
        optional: bool = False,
    ) -> Match:
        """`(source)-[rel:types {rel_where}]->(target:labels {node_where})`.

        Relationships of one pattern are pairwise distinct. Without a `target` name the far end is
        anonymous and its nodes are not read. A `target` that is bound already closes a cycle.
        `optional` keeps rows without a match, their new variables null; `where` then belongs to the
        optional part.
        """
        _check_var(rel)
        types, labels = _as_set(types), _as_set(labels)
        closing = target in self.nodes if target else False
        where = _inline(where, rel, rel_where, None if closing else target, node_where)
        bound = self.nodes[target] if closing else None
        graph = self.home(source)
        reach = _reach(graph, types, labels, direction, self.nodes[source], bound)
        start = self if optional else self._narrowed_start(source, reach)
        nodes = dict(start.nodes)
        if target and not closing:
            nodes[target] = reach.far
        homes = dict(self.homes)
        if graph is not self.graph:
            homes.update({var: graph for var in (rel, target) if var})
        grown = replace(
            self,
            df=start.df,
            nodes=nodes,
            rels={**self.rels, rel: reach.types},
            open_rels=(*self.open_rels, rel),
            homes=homes,
            scanned=None,
        )

        if optional:
            return grown.with_rows(self._optional_rows(grown, source, rel, target, closing, reach, where))
        held = start._held_along(source, reach)
        if held is not None:
            df = start._held_rows(source, rel, held)
            far_end = quoted(flat(source, _held_name(held, "other")))
            reached = False
        else:
            holder = None if closing or target is None else _far_holder(graph, reach)
            part = _rels_of(graph, rel, reach) if holder is None else _holder_scan(*holder, rel, _check_var(target))
            df = start.df.join(part, self.id(source) == quoted(flat(rel, FROM)))
            far_end = quoted(flat(rel, TO))
            reached = holder is not None
        for condition in self._distinct_from(source, rel, reach.types):
            df = df.where(condition)
        if closing:
            df = df.where(far_end == self.id(target))
        elif target is not None and not reached:
            df = df.join(_node_scan(graph, _check_var(target), reach.far), far_end == quoted(flat(target, ID)))
        elif target is None and reach.narrowed:
            df = df.join(_ids_of(graph, reach.far), far_end == quoted("@end"), "left_semi")
        return _filtered(grown.with_rows(df.drop(flat(rel, FROM), flat(rel, TO))), where)

    def _narrowed_start(self, source: str, reach: _Reach) -> Match:
        """This match, knowing that `source` has a relationship. If nothing has been done with the
        nodes yet but to scan them, the scan is cut down to the labels that can have one."""
        if reach.near == self.nodes[source]:
            return self
        nodes = {**self.nodes, source: reach.near}
        if self.scanned is None or self.scanned[0] != source:
            return replace(self, nodes=nodes)
        scan = _node_scan(self.graph, source, reach.near)
        # columns that only the labels left out have may be in use already: they stay, empty
        absent = {
            f.name: F.lit(None).cast(f.dataType) for f in self.df.schema.fields if f.name not in scan.columns
        }
        return _filtered(Match(self.graph, scan.withColumns(absent) if absent else scan, nodes, {}), self.scanned[1])

    def _optional_rows(self, grown, source, rel, target, closing, reach, where) -> DataFrame:
        """Rows with what they match, or with nulls where they match nothing.

        Where the condition concerns the optional part alone, that part is completed from the tables of the graph:
        a row of nulls for each node that matches nothing, and one for no node. The rows so far then take part in
        one inner join, whose hot keys Spark can split on either side. In an outer join a key that much
        of the optional side shares would stay in one task.
        """
        part = _arm(self.home(source), rel, None if closing else target, reach)
        key = self.id(source) == quoted(flat(rel, FROM))
        distinct = self._distinct_from(source, rel, reach.types)
        ends = [flat(rel, FROM), flat(rel, TO)]
        if not closing and not distinct:
            alone = Match(
                self.home(source), part, {} if target is None else {target: reach.far}, {rel: reach.types}
            )
            try:
                matching = _filtered(alone, where).df
            except (UnboundVariable, AnalysisException):
                matching = None  # the condition looks at earlier variables as well
            if matching is not None:
                near = quoted(flat(rel, FROM))
                keys = matching.select(near.alias("@near")).distinct()
                nodes = _ids_of(self.home(source), self.nodes[source])
                idle = nodes.join(keys, quoted("@end") == quoted("@near"), "left_anti")
                none = idle.sparkSession.range(1).select(F.lit(None).cast(idle.schema["@end"].dataType).alias("@end"))
                idle = idle.unionAll(none).select(quoted("@end").alias(flat(rel, FROM)))
                complete = matching.unionByName(idle, allowMissingColumns=True)
                return self.df.join(complete, self.id(source).eqNullSafe(near)).drop(*ends)
        conditions = [key, *distinct]
        if closing:
            conditions.append(self.id(target) == quoted(flat(rel, TO)))
        if where is not None:
            seen = replace(grown, df=_Columns([*self.df.columns, "@row", *part.columns]))
            conditions.append(_condition(seen, where))
        # Rows are numbered and written, so that those that an inner join leaves out can be told.
        rows = written(self.df.withColumn("@row", F.monotonically_increasing_id()), "rows")
        met = rows.join(part, reduce(and_, conditions))
        idle = rows.join(met.select(quoted("@row").alias("@met")).distinct(), quoted("@row") == quoted("@met"), "left_anti")
        return met.unionByName(idle, allowMissingColumns=True).drop("@row", *ends)

    def _held_along(self, source: str, reach: _Reach) -> Held | None:
        """The one relationship table to follow, if it lies in the rows of `source` themselves."""
        if len(reach.steps) != 1 or len(self.nodes[source]) != 1:
            return None
        table, way = reach.steps[0]
        if table.held is None or way != (OUT if table.held.holder == SOURCE else IN):
            return None
        return table.held if flat(source, _held_name(table.held, ID)) in self.df.columns else None

    def _held_rows(self, source: str, rel: str, held: Held) -> DataFrame:
        """Rows of `source` with the relationship they hold."""
        other = quoted(flat(source, _held_name(held, "other")))
        ends = {held.holder: self.id(source), (TARGET if held.holder == SOURCE else SOURCE): other}
        return self.df.where(other.isNotNull()).select(
            "*",
            quoted(flat(source, _held_name(held, ID))).alias(flat(rel, ID)),
            ends[SOURCE].alias(flat(rel, SOURCE)),
            ends[TARGET].alias(flat(rel, TARGET)),
            F.lit(held.rel_type).alias(flat(rel, TYPE)),
            *[quoted(flat(source, _held_name(held, f".{p}"))).alias(flat(rel, p)) for p, _ in held.properties],
        )

    def _distinct_from(self, source: str, rel: str, types: frozenset[str]) -> list[Column]:
        """Conditions that `rel` differs from each relationship of the pattern it could be the same as."""
        home = self.home(source)
        single = [
            quoted(flat(rel, ID)) != self.id(other)
            for other in self.open_rels
            if self.rels[other] & types and self.home(other) is home
        ]
        return single + [
            _not_on(path, rel) for path, on in self.open_paths.items() if on & types and self.home(path) is home
        ]

    def optional(self, source: str, rel: str, target: str | None = None, **options) -> Match:
        """OPTIONAL MATCH of one step."""
        return self.expand(source, rel, target, optional=True, **options)

    def exists(
        self,
        source: str,
        *,
        types: Iterable[str] | str = (),
        labels: Iterable[str] | str = (),
        direction: str = OUT,
        where=None,
        rel_where: Mapping[str, object] | None = None,
        node_where: Mapping[str, object] | None = None,
        negated: bool = False,
    ) -> Match:
        """Keep rows whose `source` has (or, negated, lacks) such a neighbour: a semi or anti join."""
        where = _inline(where, "rel", rel_where, "node", node_where)
        near = self._neighbours(source, _as_set(types), _as_set(labels), direction, where)
        return self.with_rows(
            self.df.join(near, self.id(source) == quoted("@near"), "left_anti" if negated else "left_semi")
        )

    def with_exists(
        self,
        name: str,
        source: str,
        *,
        types: Iterable[str] | str = (),
        labels: Iterable[str] | str = (),
        direction: str = OUT,
        where=None,
        rel_where: Mapping[str, object] | None = None,
        node_where: Mapping[str, object] | None = None,
    ) -> Match:
        """Column `name`: whether `source` has such a neighbour."""
        where = _inline(where, "rel", rel_where, "node", node_where)
        near = self._neighbours(source, _as_set(types), _as_set(labels), direction, where)
        joined = self.df.join(near, self.id(source) == quoted("@near"), "left")
        return self.with_rows(joined.withColumn(name, quoted("@near").isNotNull()).drop("@near"))

    def _neighbours(self, source, types, labels, direction, where) -> DataFrame:
        """Column `@near`: the different near ends of the relationships an existential part is about.
        Its condition sees the variables `rel` and `node`."""
        graph = self.home(source)
        reach = _reach(graph, types, labels, direction, self.nodes[source], None)
        inner = _inner(graph, reach, lambda m: _filtered(m, where))
        return inner.df.select(quoted(flat("rel", FROM)).alias("@near")).distinct()

    def expand_aggregate(
        self,
        source: str,
        *,
        types: Iterable[str] | str = (),
        labels: Iterable[str] | str = (),
        direction: str = OUT,
        where=None,
        rel_where: Mapping[str, object] | None = None,
        node_where: Mapping[str, object] | None = None,
        optional: bool = False,
        aggregates: Callable[[Match], Mapping[str, Column]],
    ) -> Match:
        """One row per binding with aggregates over its neighbours.

        The neighbours are aggregated by the near end before they meet `source`: partial sums are
        shuffled in place of relationships, so a node holding much of a relationship type costs no
        more than any other. `aggregates` gets a match of the variables `rel` and `node`.
        """
        where = _inline(where, "rel", rel_where, "node", node_where)
        graph = self.home(source)
        reach = _reach(graph, _as_set(types), _as_set(labels), direction, self.nodes[source], None)

        def prepared(m: Match) -> tuple[Match, list[Column]]:
            m = _filtered(m, where)
            return m, [c.alias(alias) for alias, c in aggregates(m).items()]

        inner, columns = _inner(graph, reach, prepared)
        folded = inner.df.groupBy(quoted(flat("rel", FROM)).alias("@near")).agg(*columns)
        joined = self.df.join(folded, self.id(source) == quoted("@near"), "left" if optional else "inner")
        return self.with_rows(joined.drop("@near"))

    def expand_path(
        self,
        source: str,
        path: str,
        target: str,
        *,
        types: Iterable[str] | str = (),
        labels: Iterable[str] | str = (),
        direction: str = OUT,
        min_hops: int = 1,
        max_hops: int,
        properties: bool = False,
        optional: bool = False,
    ) -> Match:
        """`(source)-[path:types*min..max]->(target:labels)`.

        `path` becomes a list of relationships `{id, source, target, type}` in walking order, with their
        `properties` if asked for. No relationship occurs twice in a pattern. Walks know no more of a row than where
        they start (and earlier relationships that they must differ from): they start once from each different
        node, and meet the rows at the end. Every length is one more join on the last node of the shorter walks, with
        the relationships that can leave the labels reached so far. The walks of each length are written once to the
        shared folder, as the next length and the result both use them. A `target` that is bound already closes the
        path. `optional` keeps rows without a path, with null for path and target.
        """
        if not 0 <= min_hops <= max_hops:
            raise GraphSchemaError(f"not a range of lengths: {min_hops}..{max_hops}")
        _check_var(path)
        closing = target in self.nodes
        types, labels = _as_set(types), _as_set(labels)
        graph = self.home(source)
        keys = self._walk_keys(source, types)
        starts = self._walk_starts(source, types, direction, keys)
        lengths = self._walks(starts, source, path, types, direction, min_hops, max_hops, properties)
        reached = self.nodes[target] if closing else frozenset(c for _, ends in lengths for c in ends if labels <= c)
        here = {c: f"@{c}" for c in keys}
        walks = reduce(DataFrame.unionAll, [w for w, _ in lengths]) if lengths else starts.where(F.lit(False)).select(
            *[quoted(c) for c in keys], self.id(source).alias("@last"), self._no_steps(graph, types, properties).alias(path)
        )
        walks = walks.select(*[quoted(c).alias(a) for c, a in here.items()], "@last", quoted(path))
        if closing:
            here = {**here, flat(target, ID): "@last"}
            found = walks
        else:
            ends = _node_scan(graph, _check_var(target), reached)
            if optional:
                walks = written(walks.join(_ids_of(graph, reached), quoted("@last") == quoted("@end"), "left_semi"), "walks")
            found = walks.join(ends, quoted("@last") == quoted(flat(target, ID)))
        if optional:
            # Complete with a row for what starts no walk, the rows meet it in one inner join, which can be split.
            asked = self.df.select(*[quoted(c).alias(f"{a}?") for c, a in here.items()]).distinct()
            same = reduce(and_, [quoted(f"{a}?").eqNullSafe(quoted(a)) for a in here.values()])
            idle = asked.join(walks.select(*[quoted(a) for a in here.values()]), same, "left_anti")
            idle = idle.select(*[quoted(f"{a}?").alias(a) for a in here.values()])
            found = found.unionByName(idle, allowMissingColumns=True)
        meets = reduce(and_, [quoted(c).eqNullSafe(quoted(a)) if optional or c != flat(source, ID) else quoted(c) == quoted(a) for c, a in here.items()])
        joined = self.df.join(found, meets).drop(*{"@last", *here.values()})
        homes = dict(self.homes) if graph is self.graph else {**self.homes, target: graph}
        if graph is not self.graph:
            homes[path] = graph
        return replace(
            self,
            df=joined,
            nodes={**self.nodes, target: reached},
            scanned=None,
            homes=homes,
            open_paths={**self.open_paths, path: types or frozenset(graph.schema.relationship_types)},
        )

    def _walk_keys(self, source: str, types: frozenset[str]) -> list[str]:
        """Columns that walks depend on: the node they start from, and what they must differ from."""
        home = self.home(source)
        types = types or frozenset(home.schema.relationship_types)
        rels = [flat(rel, ID) for rel in self.open_rels if self.rels[rel] & types and self.home(rel) is home]
        paths = [p for p, on in self.open_paths.items() if on & types and self.home(p) is home]
        return [flat(source, ID), *rels, *paths]

    def _walk_starts(self, source: str, types: frozenset[str], direction: str, keys: list[str]) -> DataFrame:
        """The different starts of walks, with the relationship that a start holds itself."""
        reach = _reach(self.home(source), types, frozenset(), direction, self.nodes[source], None)
        held = self._held_along(source, reach)
        more = [] if held is None else [ID, "other", *(f".{p}" for p, _ in held.properties)]
        columns = [*keys, *(flat(source, _held_name(held, part)) for part in more)]
        starts = self.df.select(*[quoted(c) for c in columns]).where(self.id(source).isNotNull())
        return starts if self.scanned is not None and self.scanned[0] == source else starts.distinct()

    def _no_steps(self, graph: PropertyGraph, types: frozenset[str], properties: bool) -> Column:
        kept = graph.schema.relationship_property_keys_for(types) if properties else {}
        return F.array().cast(T.ArrayType(_step_type(graph, kept)))

    def _walks(
        self, starts: DataFrame, source: str, path: str, types: frozenset[str], direction: str, min_hops: int, max_hops: int, properties: bool
    ) -> list[tuple[DataFrame, frozenset[Labels]]]:
        """For each length, the walks (their keys, `@last` and `path`) and the labels that they may have reached."""
        graph = self.home(source)
        near = self.nodes[source]
        keys = [quoted(c) for c in self._walk_keys(source, types)]
        kept = graph.schema.relationship_property_keys_for(types) if properties else {}
        step_type = _step_type(graph, kept)
        none = self._no_steps(graph, types, properties)
        walk = starts.select(*keys, self.id(source).alias("@last"), none.alias(path))
        lengths = [(walk, near)] if min_hops == 0 else []
        for length in range(1, max_hops + 1):
            reach = _reach(graph, types, frozenset(), direction, near, None)
            if not reach.steps:
                break
            held = self._held_along(source, reach) if length == 1 else None
            if held is not None:
                joined = self.with_rows(starts)._held_rows(source, "@hop", held).withColumn(
                    flat("@hop", TO), quoted(flat(source, _held_name(held, "other")))
                ).withColumn(path, none)
            else:
                joined = walk.join(_rels_of(graph, "@hop", reach), quoted("@last") == quoted(flat("@hop", FROM)))
            if length > 1:
                joined = joined.where(_not_on(path, "@hop"))
            for condition in self._distinct_from(source, "@hop", reach.types):
                joined = joined.where(condition)
            step = F.struct(*[quoted(flat("@hop", c)).alias(c.lstrip("@")) for c in (ID, SOURCE, TARGET, TYPE)])
            if kept:
                values = [
                    (quoted(c) if (c := flat("@hop", p)) in joined.columns else F.lit(None)).cast(t).alias(p)
                    for p, t in kept.items()
                ]
                step = step.withField("properties", F.struct(*values))
            walk = joined.select(
                *keys, quoted(flat("@hop", TO)).alias("@last"), F.array_append(quoted(path), step.cast(step_type)).alias(path)
            )
            if length < max_hops:
                walk = written(walk, "walks")
            near = reach.far
            if length >= min_hops:
                lengths.append((walk, near))
        return lengths

    def join(self, other: Match, on: Iterable[tuple[str, str]], how: str = "inner") -> Match:
        """Combine two patterns, of one graph or of two, by equal values: `on=[('p.name', 'c.name')]`. A value that
        both sides repeat gives every pair of its rows."""
        shared = set(self.df.columns) & set(other.df.columns)
        if shared:
            raise GraphSchemaError(f"both sides bind {sorted(shared)}")
        pairs = [self[left] == other[right] for left, right in on]
        if not pairs:
            raise GraphSchemaError("patterns are joined by at least one pair of values")
        joined = self.df.join(other.df, reduce(and_, pairs), how)
        homes = {v: m.home(v) for m in (self, other) for v in m.nodes if m.home(v) is not self.graph}
        return Match(self.graph, joined, {**self.nodes, **other.nodes}, {**self.rels, **other.rels}, homes=homes)


# -- scans ----------------------------------------------------------------------------------------


def _held_name(held: Held, part: str) -> str:
    return f"@{held.rel_type}.{held.holder}.{part}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _node_columns(node: NodeTable, var: str, with_held: bool) -> list[Picked]:
    names = {flat(var, ID): ID, **{flat(var, p): p for p in node.properties}}
    for held in node.held if with_held else ():
        names[flat(var, _held_name(held, ID))] = held.id
        names[flat(var, _held_name(held, "other"))] = held.other
        names.update({flat(var, _held_name(held, f".{p}")): c for p, c in held.properties})
    labels = ", ".join(_text(label) for label in sorted(node.labels))
    return [
        *picked_columns(node.df, names),
        Picked(flat(var, LABELS), f"cast(array({labels}) AS ARRAY<STRING>)", T.ArrayType(T.StringType())),
    ]


def _node_scan(graph: PropertyGraph, var: str, combos: Iterable[Labels]) -> DataFrame:
    """Nodes of the given label combinations. Nodes of a single one bring the relationships they hold."""
    wanted = set(combos)
    tables = [n for n in graph.nodes if n.labels in wanted]
    if not tables:
        return graph.spark.createDataFrame([], f"`{flat(var, ID)}` string, `{flat(var, LABELS)}` array<string>")
    return select_aligned([(n.df, _node_columns(n, var, len(tables) == 1)) for n in tables])


def _ids_of(graph: PropertyGraph, combos: Iterable[Labels]) -> DataFrame:
    return _node_scan(graph, "@end", combos).select(quoted(flat("@end", ID)).alias("@end"))


def _rel_columns(rel: RelTable, var: str, orientation: str | None) -> tuple[DataFrame, list[Picked]]:
    """Relationships with the ends to walk from and to. Walked both ways, a table is read once and
    each row unfolded into its two directions; a loop has only one."""
    names = {flat(var, c): c for c in (ID, SOURCE, TARGET, *rel.properties)}
    df = rel.df
    columns = [*picked_columns(df, names), Picked(flat(var, TYPE), _text(rel.rel_type), T.StringType())]
    if orientation is None:
        return df, columns
    types = {f.name: f.dataType for f in df.schema.fields}
    if orientation == BOTH:
        forth = f"named_struct('f', {SOURCE}, 't', {TARGET})"
        back = f"named_struct('f', {TARGET}, 't', {SOURCE})"
        ways = F.expr(f"inline(if({SOURCE} = {TARGET}, array({forth}), array({forth}, {back})))")
        df = df.select("*", ways.alias(FROM, TO))
        walk = (sql_name(FROM), sql_name(TO))
    else:
        walk = (SOURCE, TARGET) if orientation == OUT else (TARGET, SOURCE)
    ends = [types[TARGET if walk[i] == TARGET else SOURCE] for i in range(2)]
    return df, [*columns, Picked(flat(var, FROM), walk[0], ends[0]), Picked(flat(var, TO), walk[1], ends[1])]


@dataclass(frozen=True)
class _Reach:
    """Where a step can lead: relationship tables with the direction to walk them in, the label
    combinations at the near and the far end, and whether the wanted labels leave out some that the declared
    endpoints allow."""

    steps: tuple[tuple[RelTable, str], ...]
    types: frozenset[str]
    near: frozenset[Labels]
    far: frozenset[Labels]
    narrowed: bool


def _reach(
    graph: PropertyGraph,
    types: frozenset[str],
    labels: frozenset[str],
    direction: str,
    near: frozenset[Labels],
    bound_far: frozenset[Labels] | None,
) -> _Reach:
    """Only tables and directions are followed whose declared endpoints fit both ends."""
    if direction not in (OUT, IN, BOTH):
        raise GraphSchemaError(f"no such direction: {direction}")
    combos = frozenset(graph.label_combinations)
    wanted = bound_far if bound_far is not None else frozenset(c for c in combos if labels <= c)

    steps: list[tuple[RelTable, str]] = []
    leaving: set[Labels] = set()
    far: set[Labels] = set()
    narrowed = False
    for table in graph.rel_tables(types):
        fitting = []
        for way, start, end in (
            (OUT, table.source_labels, table.target_labels),
            (IN, table.target_labels, table.source_labels),
        ):
            possible = {c for c in combos if end <= c}
            starting = {c for c in near if start <= c}
            if direction in (way, BOTH) and possible & wanted and starting:
                fitting.append(way)
                leaving |= starting
                far |= possible & wanted
                narrowed = narrowed or bool(possible - wanted)
        if fitting:
            steps.append((table, BOTH if len(fitting) == 2 else fitting[0]))
    return _Reach(tuple(steps), frozenset(t.rel_type for t, _ in steps), frozenset(leaving), frozenset(far), narrowed)


def _rels_of(graph: PropertyGraph, rel: str, reach: _Reach) -> DataFrame:
    """The relationships of a step."""
    if not reach.steps:
        return _no_rels(graph, rel)
    return select_aligned([_rel_columns(table, rel, way) for table, way in reach.steps])


def _far_holder(graph: PropertyGraph, reach: _Reach) -> tuple[NodeTable, Held] | None:
    """The far nodes, if there is one table of them and it holds the relationships of the step."""
    if len(reach.steps) != 1 or len(reach.far) != 1:
        return None
    (table, way), = reach.steps
    if table.held is None or way != (IN if table.held.holder == SOURCE else OUT):
        return None
    holder = graph.node_tables(next(iter(reach.far)), exact=True)[0]
    return (holder, table.held) if table.held in holder.held else None


def _arm(graph: PropertyGraph, rel: str, target: str | None, reach: _Reach) -> DataFrame:
    """The relationships of a step, with their far nodes where those are named. A table that lies in
    the rows of its far nodes brings them along without a join."""
    if target is not None:
        _check_var(target)
        holder = _far_holder(graph, reach)
        if holder is not None:
            return _holder_scan(*holder, rel, target)
    part = _rels_of(graph, rel, reach)
    if target is not None:
        return part.join(_node_scan(graph, target, reach.far), quoted(flat(rel, TO)) == quoted(flat(target, ID)))
    if reach.narrowed:
        return part.join(_ids_of(graph, reach.far), quoted(flat(rel, TO)) == quoted("@end"), "left_semi")
    return part


def _holder_scan(holder: NodeTable, held: Held, rel: str, target: str) -> DataFrame:
    """Far nodes together with the relationships they hold, from one scan of their table."""
    ends = {held.holder: ID, (TARGET if held.holder == SOURCE else SOURCE): held.other}
    names = {
        flat(rel, ID): held.id,
        flat(rel, SOURCE): ends[SOURCE],
        flat(rel, TARGET): ends[TARGET],
        flat(rel, FROM): held.other,
        flat(rel, TO): ID,
        **{flat(rel, p): c for p, c in held.properties},
    }
    columns = [
        *picked_columns(holder.df, names),
        Picked(flat(rel, TYPE), _text(held.rel_type), T.StringType()),
        *_node_columns(holder, target, True),
    ]
    return select_aligned([(holder.df.where(quoted(held.other).isNotNull()), columns)])


def _inner(graph: PropertyGraph, reach: _Reach, use: Callable[[Match], object]):
    """`use` applied to the relationships of a step as `rel`; their far nodes are joined as `node` only
    if `use` asks for them."""
    part = _arm(graph, "rel", None, reach)
    try:
        return use(Match(graph, part, {}, {"rel": reach.types}))
    except UnboundVariable:
        part = _arm(graph, "rel", "node", reach)
        return use(Match(graph, part, {"node": reach.far}, {"rel": reach.types}))


def _not_on(path: str, rel: str) -> Column:
    """That a relationship is not one of a path."""
    return ~F.exists(quoted(path), lambda step: step[ID] == quoted(flat(rel, ID)))


def _step_type(graph: PropertyGraph, properties: Mapping[str, T.DataType]) -> T.StructType:
    """Type of one step of a path."""
    table = union_tables([r.df.select(ID, SOURCE, TARGET) for r in graph.relationships]) if graph.relationships else None
    fields = [T.StructField(c, table.schema[c].dataType if table else T.StringType()) for c in (ID, SOURCE, TARGET)]
    fields.append(T.StructField("type", T.StringType()))
    if properties:
        fields.append(T.StructField("properties", T.StructType([T.StructField(p, t) for p, t in properties.items()])))
    return T.StructType(fields)


def _no_rels(graph: PropertyGraph, rel: str) -> DataFrame:
    names = [ID, SOURCE, TARGET, TYPE, FROM, TO]
    return graph.spark.createDataFrame([], ", ".join(f"`{flat(rel, n)}` string" for n in names))


@dataclass(frozen=True)
class _Columns:
    """Names a condition may use before the tables they come from are joined."""

    columns: list[str]


def _condition(match: Match, where) -> Column:
    return where(match) if callable(where) else where


def _filtered(match: Match, where) -> Match:
    return match if where is None else match.with_rows(match.df.where(_condition(match, where)))


def _equal_to(var: str, values: Mapping[str, object]) -> Callable[[Match], Column]:
    """`var {key: value, ...}`"""
    return lambda m: reduce(and_, [m[f"{var}.{k}"] == F.lit(v) for k, v in values.items()], F.lit(True))


def _inline(where, rel: str, rel_where, node: str | None, node_where) -> Callable[[Match], Column] | Column | None:
    """The condition of a step, with the inline predicates of its new relationship and its new far node."""
    if isinstance(where, Mapping):
        raise GraphSchemaError("rel_where or node_where says what a dictionary is about")
    if node_where and node is None:
        raise GraphSchemaError("node_where needs a far node that this step binds")
    inline = [_equal_to(var, values) for var, values in ((rel, rel_where), (node, node_where)) if values]
    if not inline:
        return where
    given = [] if where is None else [where]
    return lambda m: reduce(and_, [_condition(m, c) for c in [*inline, *given]])


def match_nodes(graph: PropertyGraph, var: str, labels: Iterable[str] | str, *, exact: bool, where) -> Match:
    _check_var(var)
    combos = frozenset(n.labels for n in graph.node_tables(labels, exact))
    where = _equal_to(var, where) if isinstance(where, Mapping) else where
    match = _filtered(Match(graph, _node_scan(graph, var, combos), {var: combos}, {}), where)
    return replace(match, scanned=(var, where))


def match_relationships(
    graph: PropertyGraph, var: str, types: Iterable[str] | str, *, directed: bool, where
) -> Match:
    _check_var(var)
    where = _equal_to(var, where) if isinstance(where, Mapping) else where
    tables = graph.rel_tables(types)
    if tables:
        rows = select_aligned([_rel_columns(t, var, None if directed else BOTH) for t in tables])
    else:
        rows = _no_rels(graph, var)
    rows = rows.drop(flat(var, FROM), flat(var, TO))
    match = Match(graph, rows, {}, {var: frozenset(t.rel_type for t in tables)}, (var,))
    return _filtered(match, where)
