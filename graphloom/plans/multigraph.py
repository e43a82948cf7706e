"""Catalog, unions of graphs, constructed graphs, graphs over views."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.model.graph import NodeTable, PropertyGraph, RelTable
from graphloom.model.schema import GraphSchema
from graphloom.model.types import parse_type_name
from graphloom.operators import aggregates as agg
from graphloom.operators.multigraph import Create, CreateNode, construct, union_graphs
from graphloom.plans.registry import query
from graphloom.plans.tables import activity_graph, exact_sum, shop_graph, table
from graphloom.session import new_location
from graphloom.sources.catalog import CachedSource, GraphCatalog, SessionGraphs
from graphloom.sources.frames import records
from graphloom.sources.views import CatalogViews, EdgeView, End, FileViews, NodeView, ViewGraph, ViewGraphSource


def _catalog(spark, folder):
    catalog = GraphCatalog(spark)
    catalog.store("shop", shop_graph(spark, folder))
    held = SessionGraphs(spark)
    held.store("clicks", activity_graph(spark, folder))
    catalog.register("web", held)
    return catalog


@query(
    "from_graph",
    """
    SELECT user_id AS userid, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY user_id
    """,
)
def from_graph(spark, folder):
    """FROM GRAPH web.clicks MATCH (u:User)-[:DID]->(e:Event {kind: 'purchase'}) RETURN u.userid, count(*)"""
    m = _catalog(spark, folder).graph("web.clicks").match("u", "User")
    m = m.expand_aggregate(
        "u", types="DID", labels="Event", where=lambda m: m["node.kind"] == "purchase",
        aggregates=lambda m: {"n": agg.count_all()},
    )
    return m.select("n", userid="u.userid")


@query(
    "catalog_names",
    """
    SELECT unnest(['session.emptyGraph', 'session.shop', 'web.clicks', 'web.emptyGraph']) AS name,
        unnest([0, 6, 2, 0]) AS n_labels, unnest([0, (SELECT count(*) FROM orders), 0, 0]) AS n_orders
    """,
)
def catalog_names(spark, folder):
    """Graphs of a catalog with what their schemas hold and how many orders they have."""
    catalog = _catalog(spark, folder)
    parts = []
    for name in catalog.graph_names():
        graph = catalog.graph(name)
        counted = agg.group(graph.match("o", "Order").df, n_orders=agg.count_all())
        parts.append(
            counted.select(F.lit(name).alias("name"), F.lit(len(graph.schema.labels)).alias("n_labels"), "n_orders")
        )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    return union


@query("schema_properties", "SELECT 'Order' AS label, 'orderdate,orderkey,priority,status,totalprice' AS keys, count(*) AS n FROM orders")
def schema_properties(spark, folder):
    graph = shop_graph(spark, folder)
    schema = graph.schema + activity_graph(spark, folder).schema
    keys = ",".join(sorted(schema.node_property_keys(["Order"])))
    return agg.group(graph.match("o", "Order").df, n=agg.count_all()).select(
        F.lit("Order").alias("label"), F.lit(keys).alias("keys"), "n"
    )


@query(
    "graph_union_count",
    """
    SELECT label, 2 * n AS n, 2 * n AS n_ids FROM (
        SELECT 'Customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'Order', count(*) FROM orders
        UNION ALL SELECT 'Part', count(*) FROM part UNION ALL SELECT 'Supplier', count(*) FROM supplier
        UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'Region', count(*) FROM region)
    """,
)
def graph_union_count(spark, folder):
    """A graph in union with itself: twice the nodes, and every id still different."""
    graph = shop_graph(spark, folder)
    m = union_graphs(graph, graph).match("n")
    return m.df.groupBy(F.array_join(m.labels("n"), ":").alias("label")).agg(
        agg.count_all().alias("n"), agg.count_distinct(m.id("n")).alias("n_ids")
    )


@query(
    "graph_union_expand",
    "SELECT c_mktsegment AS segment, 2 * count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1",
)
def graph_union_expand(spark, folder):
    """Relationships of a union lead to nodes of their own member."""
    graph = shop_graph(spark, folder)
    m = union_graphs(graph, graph).match("c", "Customer")
    m = m.expand_aggregate("c", types="PLACED", labels="Order", aggregates=lambda m: {"n": agg.count_all()})
    return m.df.groupBy(m["c.segment"].alias("segment")).agg(F.sum("n").alias("n"))


def _linked(spark, folder):
    """FROM GRAPH shop MATCH (c:Customer) FROM GRAPH activity MATCH (u:User) WHERE c.custkey = u.userid
    CONSTRUCT ON shop, activity CREATE (u)-[:IS {since: 2024}]->(c) RETURN GRAPH"""
    shop, web = shop_graph(spark, folder), activity_graph(spark, folder)
    same = web.match("u", "User").join(shop.match("c", "Customer"), on=[("u.userid", "c.custkey")])
    return construct([shop, web], same, [Create("IS", "u", "c", {"since": F.lit(2024)})])


@query(
    "construct_edges",
    """
    SELECT 'IS' AS type, count(*) AS n, count(*) AS n_ids, 2024 * count(*) AS years FROM customer
    WHERE c_custkey IN (SELECT user_id FROM events)
    """,
)
def construct_edges(spark, folder):
    m = _linked(spark, folder).match_relationships("e", "IS")
    return m.df.groupBy(m.type("e").alias("type")).agg(
        agg.count_all().alias("n"), agg.count_distinct(m.id("e")).alias("n_ids"), F.sum(m["e.since"]).alias("years")
    )


@query(
    "recommendation",
    """
    SELECT DISTINCT u AS userid, p_brand AS brand FROM (SELECT DISTINCT user_id AS u FROM events)
    JOIN customer ON c_custkey = u JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey
    """,
)
def recommendation(spark, folder):
    """MATCH (u:User)-[:IS]->(c:Customer), (c)-[:PLACED]->(o:Order), (o)-[:CONTAINS]->(p:Part)
    RETURN DISTINCT u.userid, p.brand, on the constructed graph"""
    m = _linked(spark, folder).match("u", "User")
    m = m.expand("u", "i", "c", types="IS", labels="Customer")
    m = m.expand("c", "r", "o", types="PLACED", labels="Order")
    m = m.expand("o", "l", "p", types="CONTAINS", labels="Part")
    return m.select(userid="u.userid", brand="p.brand").distinct()


@query(
    "construct_unwound",
    """
    SELECT count(*) AS n, count(*) AS n_ids, CAST(sum(v) AS BIGINT) AS total FROM (
        SELECT unnest([1, 2, 3]) AS v FROM customer WHERE c_custkey IN (SELECT user_id FROM events))
    """,
)
def construct_unwound(spark, folder):
    """As many created relationships, each with an id of its own, as rows after an UNWIND."""
    shop, web = shop_graph(spark, folder), activity_graph(spark, folder)
    same = web.match("u", "User").join(shop.match("c", "Customer"), on=[("u.userid", "c.custkey")])
    rows = same.with_rows(same.df.withColumn("level", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))))
    m = construct([shop, web], rows, [Create("IS", "u", "c", {"level": F.col("level")})]).match_relationships("e", "IS")
    return agg.group(m.df, n=agg.count_all(), n_ids=agg.count_distinct(m.id("e")), total=agg.total(m["e.level"]))


@query(
    "construct_equal_rows",
    """
    SELECT o_orderpriority AS priority, 2 * count(*) AS n, 2 * count(*) AS n_ids, 2 * count(*) AS n_notes FROM orders
    JOIN customer ON c_custkey = o_custkey GROUP BY 1
    """,
)
def construct_equal_rows(spark, folder):
    """A relationship and a node for every row, of orders without their keys and each twice: many rows are equal."""
    shop = shop_graph(spark, folder)
    customers = shop.match("c", "Customer")
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"))
    twice = orders.withColumn("again", F.explode(F.array(F.lit(1), F.lit(1)))).drop("again")
    rows = customers.with_rows(customers.df.join(twice, customers["c.custkey"] == F.col("custkey")).drop("custkey"))
    graph = construct(
        [shop], rows, [CreateNode("note", ["Note"], {"priority": F.col("priority")}), Create("NOTED", "c", "note", {"priority": F.col("priority")})]
    )
    m = graph.match("c", "Customer").expand("c", "e", "n", types="NOTED", labels="Note")
    return m.df.groupBy(m["e.priority"].alias("priority")).agg(
        agg.count_all().alias("n"), agg.count_distinct(m.id("e")).alias("n_ids"), agg.count_distinct(m.id("n")).alias("n_notes")
    )


@query(
    "construct_nodes",
    "SELECT c_name AS name, 'gold' AS level FROM customer",
)
def construct_nodes(spark, folder):
    """MATCH (c:Customer) CONSTRUCT ON shop
    CREATE (c)-[:HOLDS]->(:Card {level: 'gold'}) RETURN GRAPH, then MATCH (c)-[:HOLDS]->(k:Card)"""
    shop = shop_graph(spark, folder)
    graph = construct(
        [shop], shop.match("c", "Customer"), [CreateNode("card", ["Card"], {"level": F.lit("gold")}), Create("HOLDS", "c", "card")]
    )
    m = graph.match("c", "Customer").expand("c", "h", "k", types="HOLDS", labels="Card")
    return m.select(name="c.name", level="k.level")


def _view_graph(spark, folder, hashed=False):
    order_type = GraphSchema().with_node(
        ["Order"], {"totalprice": parse_type_name("FLOAT"), "status": parse_type_name("STRING")}
    )
    spec = ViewGraph(
        nodes=(
            NodeView(("Person", "Customer"), "files.customer.parquet", {"name": "C_NAME", "segment": "c_mktsegment"}),
            NodeView(("Order",), "files.orders.parquet", {"totalprice": "O_TOTALPRICE", "status": "o_orderstatus"}),
            NodeView(("Person", "Supplier"), "files.supplier.parquet", {"name": "s_name"}, key=("S_SUPPKEY",)),
        ),
        edges=(
            EdgeView(
                "PLACED",
                "files.orders.parquet",
                End(("Person", "Customer"), "files.customer.parquet", (("C_CUSTKEY", "o_custkey"),)),
                End(("Order",), "files.orders.parquet", (("o_orderkey", "O_ORDERKEY"),)),
                {"priority": "O_ORDERPRIORITY"},
            ),
        ),
        schema=order_type,
    )
    readers = {"files": FileViews("parquet", folder), "session": CatalogViews()}
    return ViewGraphSource(spark, readers, {"sales": spec}, hashed_ids=hashed).graph("sales")


_VIEW_SQL = """
    SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS n, max(o_totalprice) AS most
    FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2
"""


def _view_rows(graph):
    m = graph.match("c", ["Person", "Customer"])
    m = m.expand("c", "r", "o", types="PLACED", labels="Order", where=lambda m: m["o.status"] == "F")
    return m.df.groupBy(m["c.segment"].alias("segment"), m["r.priority"].alias("priority")).agg(
        agg.count_all().alias("n"), agg.largest(m["o.totalprice"]).alias("most")
    )


@query("sql_view_graph", _VIEW_SQL)
def sql_view_graph(spark, folder):
    """Nodes and edges given by views, columns in any case, ids serialized from the join columns."""
    return _view_rows(_view_graph(spark, folder))


@query("sql_view_graph_hashed", _VIEW_SQL)
def sql_view_graph_hashed(spark, folder):
    return _view_rows(_view_graph(spark, folder, hashed=True))


@query(
    "view_multi_label",
    "SELECT 'Customer:Person' AS labels, count(*) AS n FROM customer "
    "UNION ALL SELECT 'Person:Supplier', count(*) FROM supplier",
)
def view_multi_label(spark, folder):
    """MATCH (p:Person) RETURN labels(p), count(*): both label sets that contain Person"""
    m = _view_graph(spark, folder).match("p", "Person")
    return m.df.groupBy(F.array_join(m.labels("p"), ":").alias("labels")).agg(agg.count_all().alias("n"))


@query(
    "sql_records",
    """
    SELECT n_name AS nation, CAST(count(*) AS BIGINT) AS n FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1
    """,
)
def sql_records(spark, folder):
    """The result of SQL text as rows of graph types, and a node-edge join written in SQL."""
    table(spark, folder, "nation").createOrReplaceTempView("loom_nation")
    table(spark, folder, "supplier").createOrReplaceTempView("loom_supplier")
    return records(
        spark,
        "SELECT n_name AS nation, count(*) AS n FROM loom_nation JOIN loom_supplier ON s_nationkey = n_nationkey "
        "GROUP BY n_name",
    )




@query(
    "view_of_session_and_csv",
    """
    SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1
    """,
)
def view_of_session_and_csv(spark, folder):
    """Nodes given by a view of the session catalog, edges and far nodes by text files of a given schema."""
    table(spark, folder, "customer").createOrReplaceTempView("loom_view_customer")
    location = new_location(spark, "views")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    orders.write.option("header", "true").csv(f"{location}/orders.csv")
    spec = ViewGraph(
        nodes=(
            NodeView(("Customer",), "session.loom_view_customer", {"segment": "c_mktsegment"}, key=("c_custkey",)),
            NodeView(("Order",), "text.orders.csv", {"totalprice": "o_totalprice"}, key=("o_orderkey",)),
        ),
        edges=(
            EdgeView(
                "PLACED",
                "text.orders.csv",
                End(("Customer",), "session.loom_view_customer", (("c_custkey", "o_custkey"),)),
                End(("Order",), "text.orders.csv", (("o_orderkey", "o_orderkey"),)),
                key=("o_orderkey",),
            ),
        ),
    )
    text = FileViews("csv", location, schemas={"orders.csv": "o_orderkey long, o_custkey long, o_totalprice double"})
    source = CachedSource(ViewGraphSource(spark, {"session": CatalogViews(), "text": text}, {"sales": spec}))
    m = source.graph("sales").match("c", "Customer").expand("c", "r", "o", types="PLACED", labels="Order")
    return m.df.groupBy(m["c.segment"].alias("segment")).agg(
        agg.count_all().alias("n"), exact_sum(m["o.totalprice"]).alias("total")
    )


@query(
    "mapped_frames",
    """
    SELECT s_name AS supplier, n_name AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey
    """,
)
def mapped_frames(spark, folder):
    """Tables whose columns follow no convention, as a graph: which column is the id, an end, or a property is said for each."""
    graph = PropertyGraph.from_tables(
        NodeTable.mapped("Supplier", table(spark, folder, "supplier"), "s_suppkey", {"title": "s_name"}),
        NodeTable.mapped("Nation", table(spark, folder, "nation"), "n_nationkey", {"title": "n_name"}),
        RelTable.mapped("SEATED_IN", table(spark, folder, "supplier"), "s_suppkey", "s_suppkey", "s_nationkey", {}, ["Supplier"], ["Nation"]),
    )
    m = graph.match("s", "Supplier").expand("s", "r", "n", types="SEATED_IN", labels="Nation")
    return m.select(supplier="s.title", nation="n.title")
