from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from graphloom import NodeTable, PropertyGraph, RelTable
from graphloom.errors import GraphSchemaError
from graphloom.functions import entities
from graphloom.model.graph import Held
from graphloom.operators import aggregates as agg
from tests.conftest import row_key, values


def test_directed_expand_follows_every_friendship(friends):
    m = friends.match("a", "Person").expand("a", "r", "b", types="FRIEND_OF")
    assert values(m.select("a.name", "b.name", "r.since")) == sorted(
        [
            ("Alice", "Bob", "23/01/1987"),
            ("Bob", "Carol", "12/12/2009"),
            ("Carol's Mom", "Carol", "02/04/1982"),
            ("Carol's Mom", "Alice", "22/08/1976"),
        ],
        key=row_key,
    )


def test_incoming_expand_is_the_reverse(friends):
    out = friends.match("a").expand("a", "r", "b").select(x="a.name", y="b.name")
    back = friends.match("b").expand("b", "r", "a", direction="in").select(x="a.name", y="b.name")
    assert values(out) == values(back)


def test_undirected_twice_directed_but_loops_once(spark, friends):
    assert friends.match_relationships("e", directed=False).df.count() == 8
    loops = spark.createDataFrame([(9, 1, 1), (10, 1, 2)], "id long, source long, target long")
    graph = PropertyGraph.from_tables(*friends.nodes, RelTable("SELF", loops))
    assert graph.match_relationships("e", "SELF", directed=False).df.count() == 3
    m = graph.match("a").expand("a", "r", "b", types="SELF", direction="both")
    assert values(m.select("a.name", "b.name")) == [("Bob", "Bob"), ("Bob", "Carol"), ("Carol", "Bob")]


def test_relationships_of_one_pattern_differ(friends):
    m = friends.match("a").expand("a", "r", "b", direction="both")
    pattern = m.expand("b", "s", "c", direction="both")
    assert all(r["r__id"] != r["s__id"] for r in pattern.df.collect())
    again = m.next_pattern().expand("b", "s", "c", direction="both")
    assert again.df.count() > pattern.df.count()
    brute = [
        (e1, e2)
        for e1, (a, b) in _steps()
        for e2, (c, d) in _steps()
        if b == c and e1 != e2
    ]
    assert pattern.df.count() == len(brute)


def _steps():
    edges = {0: (0, 1), 1: (1, 2), 2: (3, 2), 3: (3, 0)}
    return [(i, ends) for i, ends in edges.items()] + [(i, ends[::-1]) for i, ends in edges.items()]


def test_optional_keeps_rows_without_match(friends):
    m = friends.match("a").optional("a", "r", "b", where=lambda m: m["b.age"] > 12)
    assert values(m.select("a.name", "b.name")) == sorted(
        [
            ("Alice", "Bob"),
            ("Bob", "Carol"),
            ("Carol's Mom", "Carol"),
            ("Carol", None),
        ],
        key=row_key,
    )


def test_optional_condition_on_earlier_variables(friends):
    m = friends.match("a").optional("a", "r", "b", where=lambda m: m["b.age"] < m["a.age"])
    assert values(m.select("a.name", "b.name")) == sorted(
        [
            ("Bob", "Carol"),
            ("Carol's Mom", "Carol"),
            ("Carol's Mom", "Alice"),
            ("Alice", None),
            ("Carol", None),
        ],
        key=row_key,
    )


def test_optional_unmatched_entity_is_null(friends):
    m = friends.match("a", where={"name": "Carol"}).optional("a", "r", "b")
    row = m.select("a", "b", "r").first()
    assert row["b"] is None and row["r"] is None and row["a"]["properties"]["name"] == "Carol"


def test_optional_chain_from_a_missing_node(friends):
    m = friends.match("a", where={"name": "Carol"}).optional("a", "r", "b").optional("b", "s", "c")
    assert values(m.select("a.name", "b.name", "c.name")) == [("Carol", None, None)]


def test_exists_and_its_negation_share_the_rows(friends):
    having = friends.match("a").exists("a", types="FRIEND_OF")
    lacking = friends.match("a").exists("a", types="FRIEND_OF", negated=True)
    assert values(having.select("a.name")) == [("Alice",), ("Bob",), ("Carol's Mom",)]
    assert values(lacking.select("a.name")) == [("Carol",)]
    flagged = friends.match("a").with_exists("f", "a", where=lambda m: m["node.age"] > 12)
    assert values(flagged.select("a.name", F.col("f"))) == [
        ("Alice", True),
        ("Bob", True),
        ("Carol", False),
        ("Carol's Mom", True),
    ]


def test_closing_a_cycle(spark):
    nodes = spark.createDataFrame([(i,) for i in range(4)], "id long")
    rels = spark.createDataFrame([(0, 0, 1), (1, 1, 2), (2, 2, 0), (3, 2, 3)], "id long, source long, target long")
    graph = PropertyGraph.from_tables(NodeTable("N", nodes), RelTable("R", rels))
    m = graph.match("a").expand("a", "r", "b").expand("b", "s", "c").expand("c", "t", "a")
    assert values(m.df.select("a__id", "b__id", "c__id")) == [(0, 1, 2), (1, 2, 0), (2, 0, 1)]


def test_paths_repeat_no_relationship(spark):
    nodes = spark.createDataFrame([(i,) for i in range(3)], "id long")
    rels = spark.createDataFrame([(0, 0, 1), (1, 1, 0), (2, 1, 2)], "id long, source long, target long")
    graph = PropertyGraph.from_tables(NodeTable("N", nodes), RelTable("R", rels))
    m = graph.match("a").expand_path("a", "p", "b", max_hops=4)
    walked = sorted((r["a__id"], r["b__id"], tuple(s["id"] for s in r["p"])) for r in m.df.collect())
    edges = {0: (0, 1), 1: (1, 0), 2: (1, 2)}
    expected = []

    def grow(start, last, taken):
        if taken:
            expected.append((start, last, taken))
        for e, (s, t) in edges.items():
            if s == last and e not in taken and len(taken) < 4:
                grow(start, t, (*taken, e))

    for n in range(3):
        grow(n, n, ())
    assert walked == sorted(expected)
    ends = graph.match("a").expand("a", "r", "b").next_pattern().expand_path("a", "p", "b", max_hops=4)
    assert ends.df.count() == sum((s, t) in edges.values() for s, t, _ in expected)
    found = graph.match("a").expand_path("a", "p", "b", max_hops=4, optional=True).df
    assert found.count() == len(expected) + 1 and found.where("b__id IS NULL AND p IS NULL").count() == 1
    assert graph.match("a").expand_path("a", "p", "b", min_hops=0, max_hops=1).df.count() == 6


def test_paths_carry_properties_and_count_as_relationships(friends):
    m = friends.match("a", where={"name": "Carol's Mom"}).expand_path("a", "p", "b", max_hops=2, properties=True)
    found = sorted(tuple(s["properties"]["since"] for s in r["p"]) for r in m.df.collect())
    assert found == [
        ("02/04/1982",), ("22/08/1976",), ("22/08/1976", "23/01/1987"),
    ]
    back = friends.match("a", where={"name": "Bob"}).expand("a", "r", "b").expand_path(
        "b", "p", "c", max_hops=1, direction="both"
    )
    assert values(back.select("c.name")) == [("Carol's Mom",)]
    onward = friends.match("a", where={"name": "Bob"}).expand_path("a", "p", "b", max_hops=1).expand(
        "b", "r", "c", direction="both"
    )
    assert values(onward.select("c.name")) == [("Carol's Mom",)]
    assert onward.next_pattern().expand("b", "s", "d", direction="both").df.count() == 2


def test_aggregating_neighbours_equals_grouping_after_the_join(friends):
    folded = friends.match("a").expand_aggregate(
        "a", types="FRIEND_OF", aggregates=lambda m: {"n": agg.count_all(), "years": F.sum(m["node.age"])}
    )
    joined = friends.match("a").expand("a", "r", "b", types="FRIEND_OF")
    grouped = joined.group(["a"], n=agg.count_all(), years=F.sum(joined["b.age"]))
    assert values(folded.select("a.name", F.col("n"), F.col("years"))) == values(grouped, "a_name", "n", "years")


def test_match_by_labels_and_exact_labels(spark):
    base = spark.createDataFrame([(1, "x")], "id long, name string")
    other = spark.createDataFrame([(2, "y", 5)], "id long, name string, n int")
    graph = PropertyGraph.from_tables(NodeTable(["A"], base), NodeTable(["A", "B"], other))
    assert values(graph.match("a", "A").select("a.name", "a.n")) == [("x", None), ("y", 5)]
    assert values(graph.match("a", "A", exact=True).select("a.name")) == [("x",)]
    assert values(graph.match("a", ["A", "B"]).select("a.name")) == [("y",)]
    assert graph.match("a", "C").df.count() == 0


def test_missing_property_is_null_but_unknown_variable_is_an_error(friends):
    m = friends.match("a")
    assert m.select(x="a.nothing").first()["x"] is None
    with pytest.raises(GraphSchemaError):
        m["b.name"]


def test_held_relationships_match_like_tables(spark):
    """Foreign keys and a table of the same relationships give the same rows in every pattern."""
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    orders = spark.createDataFrame(
        [(10, 5.0, 1, "p1", "web"), (11, 7.0, 1, "p2", "shop"), (12, 9.0, 2, "p3", "web"), (13, 1.0, None, None, None)],
        "id long, price double, `@customer` long, `@placed` string, `@via` string",
    )
    held = Held("PLACED", "target", "@customer", "@placed", frozenset(["Customer"]), (("via", "@via"),))
    keyed = PropertyGraph.from_tables(NodeTable("Customer", customers), NodeTable("Order", orders, [held]))
    placed = orders.where("`@customer` is not null").selectExpr(
        "`@placed` as id", "`@customer` as source", "id as target", "`@via` as via"
    )
    tabled = PropertyGraph.from_tables(
        NodeTable("Customer", customers),
        NodeTable("Order", orders.select("id", "price")),
        RelTable("PLACED", placed, ["Customer"], ["Order"]),
    )

    def answers(graph):
        c, o = graph.match("c", "Customer"), graph.match("o", "Order")
        yield values(c.expand("c", "r", "o", types="PLACED").select("c.name", "o.price", "r.via"))
        yield values(o.expand("o", "r", "c", types="PLACED", direction="in").select("c.name", "o.price", "r.via"))
        yield values(o.expand("o", "r", None, direction="in").df.select("r__id", "r__source", "r__target", "o__id"))
        yield values(o.expand("o", "r", "c", direction="both").select("c.name", "o.price"))
        yield values(c.optional("c", "r", "o").select("c.name", "o.price", "r.via"))
        yield values(o.optional("o", "r", "c", direction="in").select("c.name", "o.price", "r.via"))
        yield values(c.exists("c", where=lambda m: m["node.price"] > 6).select("c.name"))
        yield values(c.exists("c", where=lambda m: m["rel.via"] == "web").select("c.name"))
        both = c.expand("c", "r", "o", types="PLACED")
        yield values(both.next_pattern().expand("o", "s", "c", direction="in").select("c.name", "o.price"))
        yield values(both.expand("o", "s", "c", direction="in").select("c.name", "o.price"))
        yield values(o.expand_path("o", "p", "c", direction="in", max_hops=3).df.select("o__id", "c__id", F.col("p")[0]["id"]))
        yield values(graph.match("x").expand("x", "r", "y", direction="both").df.select("x__id", "y__id"))
        yield values(graph.match_relationships("r").select("r.via"))
        yield graph.match("o", "Order").property_names("o")
        yield graph.schema.to_json()

    assert list(answers(keyed)) == list(answers(tabled))


def test_variables_of_another_graph_stay_in_it(spark, friends):
    towns = PropertyGraph.from_tables(
        NodeTable("Town", spark.sql("SELECT 1L AS id, 'Bob' AS mayor")),
        NodeTable("River", spark.sql("SELECT 7L AS id, 'Rhine' AS name")),
        RelTable("AT", spark.sql("SELECT 1L AS id, 1L AS source, 7L AS target"), ["Town"], ["River"]),
    )
    m = friends.match("p", "Person").join(towns.match("t", "Town"), on=[("p.name", "t.mayor")])
    m = m.expand("t", "a", "r", types="AT").expand("p", "f", "q", types="FRIEND_OF")
    assert values(m.select("p.name", "r.name", "q.name")) == [("Bob", "Rhine", "Carol")]
    assert m.expand("r", "b", "s", types="AT", direction="in").df.count() == 0
    assert m.next_pattern().expand("r", "b", "s", direction="in").df.count() == 1


def test_entities_and_their_changes(friends):
    m = friends.match("p", "Person", where=lambda m: m["p.age"] >= 18)
    changed = entities.with_property(entities.with_label(F.col("p"), "Adult"), "canVote", F.lit(True))
    rows = m.select("p").select(changed.alias("p")).collect()
    found = {r["p"]["properties"]["name"]: r["p"].asDict(recursive=True) for r in rows}
    assert set(found) == {"Bob", "Carol's Mom"}
    assert found["Bob"]["labels"] == ["Adult", "Person"]
    assert found["Bob"]["properties"] == {"age": 20, "name": "Bob", "canVote": True}
    dropped = m.select("p").select(entities.without_property(F.col("p"), "age").alias("p"))
    assert dropped.first()["p"]["properties"].asDict().keys() == {"name"}


def test_hot_keys_give_whole_results(spark):
    """A third of all relationships at one node: every pattern keeps all of them."""
    nodes = spark.range(3000).selectExpr("id", "id % 7 as kind")
    rels = spark.range(9000).selectExpr("id", "IF(id % 3 = 0, 0, id % 3000) as source", "(id * 7) % 3000 as target")
    graph = PropertyGraph.from_tables(NodeTable("N", nodes), RelTable("R", rels, ["N"], ["N"]))
    ends = {r["id"]: (r["source"], r["target"]) for r in rels.collect()}
    m = graph.match("a")
    assert m.expand("a", "r", "b").df.count() == 9000
    sources = {s for s, _ in ends.values()}
    assert m.optional("a", "r", "b").df.count() == 9000 + 3000 - len(sources)
    assert m.exists("a").df.count() == len(sources)
    folded = m.expand_aggregate("a", aggregates=lambda m: {"n": agg.count_all()})
    assert folded.df.agg(F.sum("n"), F.max("n")).first()[:] == (9000, sum(s == 0 for s, _ in ends.values()))
    counted = agg.collect_counted(graph.match("a").expand("a", "r", "b").select("a.kind", "b.kind"), ["a_kind"], "b_kind", "found")
    total = counted.select(F.aggregate("found", F.lit(0).cast("long"), lambda acc, e: acc + e["n"]).alias("n"))
    assert total.agg(F.sum("n")).first()[0] == 9000


def test_columns_taken_before_a_scan_is_narrowed(spark):
    graph = PropertyGraph.from_tables(
        NodeTable("A", spark.sql("SELECT 1L AS id, 'x' AS name")),
        NodeTable("B", spark.sql("SELECT 2L AS id, 5 AS size")),
        RelTable("R", spark.sql("SELECT 1L AS id, 1L AS source, 2L AS target"), ["A"], ["B"]),
    )
    m = graph.match("n")
    name, size = m["n.name"], m["n.size"]
    assert values(m.expand("n", "r", "b").df.select(name, size, "b__size")) == [("x", None, 5)]
    assert graph.match("n", where=F.col("n__size").isNull()).expand("n", "r", "b").df.count() == 1


def test_types_and_labels_nobody_has(friends):
    m = friends.match("a")
    assert m.expand("a", "r", "b", types="NOPE").df.count() == 0
    assert m.expand("a", "r", "b", labels="Nobody").select("a.name", "b.name").count() == 0
    assert values(m.optional("a", "r", "b", types="NOPE").select("a.name", "b.name"))[0] == ("Alice", None)
    assert m.exists("a", types="NOPE", negated=True).df.count() == 4
    assert m.exists("a", labels="Nobody").df.count() == 0
    assert m.expand_path("a", "p", "b", types="NOPE", max_hops=2).df.count() == 0
    assert m.expand_path("a", "p", "b", labels="Nobody", max_hops=2).df.count() == 0
    counted = m.expand_aggregate("a", types="NOPE", optional=True, aggregates=lambda m: {"n": F.sum(m["node.age"])})
    assert counted.df.where("n IS NULL").count() == 4
    assert friends.match_relationships("r", "NOPE").df.count() == 0
    assert friends.match("x", "Nobody").expand("x", "r", "y").df.count() == 0
    with pytest.raises(GraphSchemaError):
        m.expand("a", "r", "b", direction="sideways")
    with pytest.raises(GraphSchemaError):
        m.expand("a", "r__x", "b")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs_against_brute_force(spark, seed):
    """Two labels, three relationship tables, declared endpoints and none: the same rows as a plain search."""
    rng = random.Random(seed)
    labels = {i: rng.choice("AB") for i in range(12)}
    shapes = [("R", "A", "B"), ("R", "B", "B"), ("S", "B", "A")]
    edges = {}
    for n in range(40):
        rel_type, s, t = rng.choice(shapes)
        sources, targets = [i for i in labels if labels[i] == s], [i for i in labels if labels[i] == t]
        if sources and targets:
            edges[n] = (rel_type, rng.choice(sources), rng.choice(targets), s, t)
    nodes = [
        NodeTable(label, spark.createDataFrame([(i, i % 5) for i in labels if labels[i] == label] or [(99, 0)], "id long, v int"))
        for label in "AB"
    ]
    rels, bare = [], []
    for rel_type, s, t in shapes:
        rows = [(n, e[1], e[2], n % 3) for n, e in edges.items() if (e[0], e[3], e[4]) == (rel_type, s, t)]
        df = spark.createDataFrame(rows, "id long, source long, target long, w int")
        rels.append(RelTable(rel_type, df, [s], [t]))
        bare.append(RelTable(rel_type, df))
    for graph in (PropertyGraph.from_tables(*nodes, *rels), PropertyGraph.from_tables(*nodes, *bare)):
        m = graph.match("a", "A").expand("a", "r", "b", direction="both")
        m = m.expand("b", "s", "c", types="R", labels="B", where=lambda m: m["s.w"] != m["a.v"])
        got = sorted(tuple(r) for r in m.df.select("a__id", "r__id", "b__id", "s__id", "c__id").collect())
        expected = []
        for r, (_, x, y, _, _) in edges.items():
            for a, b in {(x, y), (y, x)}:
                if labels[a] != "A":
                    continue
                for s, (kind, u, c, _, _) in edges.items():
                    if s != r and kind == "R" and u == b and labels[c] == "B" and s % 3 != a % 5:
                        expected.append((a, r, b, s, c))
        assert got == sorted(expected)
        optional = graph.match("a").optional("a", "r", "b", types="S", direction="in", where=lambda m: m["b.v"] > 1)
        got = sorted((tuple(r) for r in optional.df.select("a__id", "r__id", "b__id").collect()), key=row_key)
        expected = []
        for a in {i for n in nodes for i in [r["id"] for r in n.df.collect()]}:
            hits = [(a, r, x) for r, (k, x, y, _, _) in edges.items() if k == "S" and y == a and x % 5 > 1]
            expected += hits or [(a, None, None)]
        assert got == sorted(expected, key=row_key)


def test_inline_predicates_are_about_the_new_variables(friends):
    m = friends.match("a").expand("a", "r", "b", node_where={"name": "Bob"})
    assert values(m.select("a.name", "b.name")) == [("Alice", "Bob")]
    m = friends.match("a").expand("a", "r", "b", rel_where={"since": "02/04/1982"}, where=lambda m: m["a.age"] > 50)
    assert values(m.select("a.name", "b.name")) == [("Carol's Mom", "Carol")]
    m = friends.match("a").optional("a", "r", "b", node_where={"name": "Bob"})
    assert values(m.select("a.name", "b.name")) == [("Alice", "Bob"), ("Bob", None), ("Carol", None), ("Carol's Mom", None)]
    assert values(friends.match("a").exists("a", node_where={"name": "Bob"}).select("a.name")) == [("Alice",)]
    assert friends.match("a").exists("a", node_where={"name": "Bob"}, negated=True).df.count() == 3
    assert friends.match("a").with_exists("e", "a", rel_where={"since": "12/12/2009"}).df.where("e").count() == 1
    counted = friends.match("a").expand_aggregate("a", node_where={"name": "Alice"}, aggregates=lambda m: {"n": F.count("*")})
    assert values(counted.select("a.name", "n")) == [("Carol's Mom", 1)]


@pytest.mark.parametrize(
    ("options", "target"), [({"where": {"name": "Bob"}}, "b"), ({"node_where": {"name": "Bob"}}, None)]
)
def test_inline_predicates_without_a_variable_are_refused(friends, options, target):
    with pytest.raises(GraphSchemaError):
        friends.match("a").expand("a", "r", target, **options)


def test_optional_steps_add_the_same_reads_each(friends):
    m, reads = friends.match("v0"), []
    for i in range(4):
        m = m.optional(f"v{i}", f"r{i}", f"v{i + 1}").next_pattern()
        reads.append(m.df._jdf.queryExecution().analyzed().collectLeaves().size())
    assert reads[2] - reads[1] == reads[1] - reads[0] == reads[3] - reads[2]


def test_longer_paths_read_no_more_each_hop(friends):
    reads = []
    for hops in range(2, 6):
        m = friends.match("a").expand_path("a", "p", "b", max_hops=hops)
        reads.append(m.df._jdf.queryExecution().analyzed().collectLeaves().size())
    assert reads[1] - reads[0] == reads[2] - reads[1] == reads[3] - reads[2]


def test_walks_carry_no_more_than_their_start(friends, monkeypatch):
    import graphloom.operators.patterns as patterns

    kept = []

    def seen(df, name):
        kept.append((name, df.columns))
        return written(df, name)

    written = patterns.written
    monkeypatch.setattr(patterns, "written", seen)
    m = friends.match("a").expand("a", "r", "b").next_pattern()
    assert m.expand_path("b", "p", "c", max_hops=3, optional=True).df.count() > 0
    assert kept and all(name == "walks" and len(columns) == 3 for name, columns in kept)


def test_optional_paths_that_close_or_must_differ(friends):
    edges = [(0, 0, 1), (1, 1, 2), (2, 3, 2), (3, 3, 0)]  # id, source, target

    def walks(start, hops, taken=()):
        found = []
        for i, s, t in edges:
            if s == start and i not in taken:
                found.append((t, (i,)))
                if hops > 1:
                    found += [(end, (i, *more)) for end, more in walks(t, hops - 1, (*taken, i))]
        return found

    # MATCH (a)-[r]-(b) OPTIONAL MATCH (a)-[p*1..3]->(b)
    m = friends.match("a").expand("a", "r", "b", direction="both").next_pattern()
    closed = m.expand_path("a", "p", "b", max_hops=3, optional=True).df
    expected = []
    for i, s, t in edges:
        for a, b in ((s, t), (t, s)):
            own = [p for end, p in walks(a, 3) if end == b]
            expected += [(a, i, b, p) for p in own or [None]]
    rows = [(r["a__id"], r["r__id"], r["b__id"], tuple(x["id"] for x in r["p"]) if r["p"] is not None else None) for r in closed.collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    # MATCH (a)-[r]-(b)-[p*1..2]->(c): p never has r
    m = friends.match("a").expand("a", "r", "b", direction="both")
    for optional in (False, True):
        found = m.expand_path("b", "p", "c", max_hops=2, optional=optional).df
        expected = []
        for i, s, t in edges:
            for a, b in ((s, t), (t, s)):
                own = [(end, p) for end, p in walks(b, 2, (i,))]
                expected += [(a, i, b, end, p) for end, p in own or [(None, None)] * optional]
        rows = [(r["a__id"], r["r__id"], r["b__id"], r["c__id"], tuple(x["id"] for x in r["p"]) if r["p"] is not None else None) for r in found.collect()]
        assert sorted(rows, key=repr) == sorted(expected, key=repr)
