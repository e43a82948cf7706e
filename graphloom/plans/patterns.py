"""Pattern queries on the shop graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import entities, lists
from graphloom.operators import aggregates as agg
from graphloom.operators.paging import page
from graphloom.plans.registry import query
from graphloom.plans.tables import activity_graph, exact_sum, money, shop_graph

EXACT = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


@query(
    "expand_directed",
    f"""
    SELECT c_custkey AS custkey, c_name AS name, count(*) AS n_orders, {EXACT.format('o_totalprice')} AS total
    FROM customer JOIN orders ON c_custkey = o_custkey
    WHERE o_totalprice > 100000 GROUP BY c_custkey, c_name
    """,
)
def expand_directed(spark, folder):
    """MATCH (c:Customer)-[:PLACED]->(o:Order) WHERE o.totalprice > 100000
    RETURN c.custkey, c.name, count(*), sum(o.totalprice)"""
    placed = shop_graph(spark, folder).match("c", "Customer").expand_aggregate(
        "c",
        types="PLACED",
        labels="Order",
        where=lambda m: m["node.totalprice"] > 100000,
        aggregates=lambda m: {"n_orders": agg.count_all(), "total": exact_sum(m["node.totalprice"])},
    )
    return placed.select("n_orders", "total", custkey="c.custkey", name="c.name")


@query(
    "node_scan_any",
    """
    SELECT 'Customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'Order', count(*) FROM orders
    UNION ALL SELECT 'Part', count(*) FROM part UNION ALL SELECT 'Supplier', count(*) FROM supplier
    UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'Region', count(*) FROM region
    """,
)
def node_scan_any(spark, folder):
    """MATCH (n) RETURN labels(n), count(*)"""
    m = shop_graph(spark, folder).match("n")
    return agg.group(m.with_column("label", F.array_join(m.labels("n"), ":")).df, ["label"], n=agg.count_all())


@query(
    "node_scan_label",
    "SELECT p_partkey AS partkey, p_name AS name, p_retailprice AS price FROM part "
    "WHERE p_type = 'PROMO' AND p_size < 25",
)
def node_scan_label(spark, folder):
    """MATCH (p:Part {kind: 'PROMO'}) WHERE p.size < 25 RETURN p.partkey, p.name, p.retailprice"""
    m = shop_graph(spark, folder).match("p", "Part", where={"kind": "PROMO"}).where(lambda m: m["p.size"] < 25)
    return m.select(partkey="p.partkey", name="p.name", price="p.retailprice")


@query("node_scan_exact", "SELECT s_suppkey AS suppkey, s_name AS name FROM supplier")
def node_scan_exact(spark, folder):
    """Nodes whose only label is Supplier."""
    m = shop_graph(spark, folder).match("s", "Supplier", exact=True)
    return m.select(suppkey="s.suppkey", name="s.name")


@query(
    "rel_scan_type",
    "SELECT l_quantity AS quantity, l_discount AS discount FROM lineitem WHERE l_quantity >= 49",
)
def rel_scan_type(spark, folder):
    """MATCH ()-[r:CONTAINS]->() WHERE r.quantity >= 49 RETURN r.quantity, r.discount"""
    m = shop_graph(spark, folder).match_relationships("r", "CONTAINS", where=lambda m: m["r.quantity"] >= 49)
    return m.select(quantity="r.quantity", discount="r.discount")


_EDGE_COUNTS = """
    SELECT 'PLACED' AS type, {0} * count(*) AS n FROM orders
    UNION ALL SELECT 'CONTAINS', {0} * count(*) FROM lineitem
    UNION ALL SELECT 'SUPPLIES', {0} * count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
    UNION ALL SELECT 'IN_NATION', {0} * ((SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier))
    UNION ALL SELECT 'IN_REGION', {0} * count(*) FROM nation
"""


@query("rel_scan_any", _EDGE_COUNTS.format(1))
def rel_scan_any(spark, folder):
    """MATCH ()-[e]->() RETURN type(e), count(*)"""
    m = shop_graph(spark, folder).match_relationships("e")
    return m.df.groupBy(m.type("e").alias("type")).agg(agg.count_all().alias("n"))


@query("anonymous_rel", _EDGE_COUNTS.format(2))
def anonymous_rel(spark, folder):
    """MATCH ()-[e]-() RETURN type(e), count(*): every relationship, both ways"""
    m = shop_graph(spark, folder).match_relationships("e", directed=False)
    return m.df.groupBy(m.type("e").alias("type")).agg(agg.count_all().alias("n"))


@query(
    "expand_undirected",
    """
    WITH e AS (
        SELECT 'Customer' AS a, c_custkey AS k, 'Nation' AS b, c_nationkey AS o FROM customer
        UNION ALL SELECT 'Supplier', s_suppkey, 'Nation', s_nationkey FROM supplier),
    both_ways AS (SELECT a AS near, b AS far FROM e UNION ALL SELECT b, a FROM e)
    SELECT near, far, count(*) AS n FROM both_ways GROUP BY near, far
    """,
)
def expand_undirected(spark, folder):
    """MATCH (a)-[:IN_NATION]-(b) RETURN labels(a), labels(b), count(*)"""
    m = shop_graph(spark, folder).match("a").expand("a", "r", "b", types="IN_NATION", direction="both")
    return m.df.groupBy(
        F.array_join(m.labels("a"), ":").alias("near"), F.array_join(m.labels("b"), ":").alias("far")
    ).agg(agg.count_all().alias("n"))


@query(
    "undirected_distinct",
    "SELECT DISTINCT c_mktsegment AS segment, o_orderpriority AS priority, o_orderstatus AS status "
    "FROM customer JOIN orders ON c_custkey = o_custkey",
)
def undirected_distinct(spark, folder):
    """MATCH (c:Customer)-[:PLACED]-(o:Order) RETURN DISTINCT c.segment, o.priority, o.status"""
    m = shop_graph(spark, folder).match("c", "Customer")
    m = m.expand("c", "r", "o", types="PLACED", labels="Order", direction="both")
    return m.select(segment="c.segment", priority="o.priority", status="o.status").distinct()


@query(
    "multi_hop",
    f"""
    SELECT c_mktsegment AS segment, p_brand AS brand, count(*) AS n, {EXACT.format('l_quantity')} AS quantity
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey
    WHERE o_orderstatus = 'F' AND l_returnflag = 'R' GROUP BY c_mktsegment, p_brand
    """,
)
def multi_hop(spark, folder):
    """MATCH (c:Customer)-[:PLACED]->(o:Order {status: 'F'})-[l:CONTAINS {returnflag: 'R'}]->(p:Part)
    RETURN c.segment, p.brand, count(*), sum(l.quantity)"""
    m = shop_graph(spark, folder).match("o", "Order", where={"status": "F"})
    m = m.expand("o", "l", "p", types="CONTAINS", labels="Part", where=lambda m: m["l.returnflag"] == "R")
    m = m.expand("o", "r", "c", types="PLACED", labels="Customer", direction="in")
    return m.df.groupBy(m["c.segment"].alias("segment"), m["p.brand"].alias("brand")).agg(
        agg.count_all().alias("n"), exact_sum(m["l.quantity"]).alias("quantity")
    )


@query(
    "multi_hop_region",
    f"""
    SELECT r_name AS region, count(*) AS n_orders, {EXACT.format('o_totalprice')} AS total
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey GROUP BY r_name
    """,
)
def multi_hop_region(spark, folder):
    """MATCH (g:Region)<-[:IN_REGION]-(n:Nation)<-[:IN_NATION]-(c:Customer)-[:PLACED]->(o:Order)
    RETURN g.name, count(*), sum(o.totalprice)"""
    m = shop_graph(spark, folder).match("c", "Customer").expand_aggregate(
        "c",
        types="PLACED",
        labels="Order",
        aggregates=lambda m: {"n": agg.count_all(), "price": F.sum(money(m["node.totalprice"]))},
    )
    m = m.expand("c", "i", "n", types="IN_NATION", labels="Nation").expand("n", "j", "g", types="IN_REGION")
    return m.df.groupBy(m["g.name"].alias("region")).agg(
        F.sum("n").alias("n_orders"), F.sum("price").cast("double").alias("total")
    )


@query(
    "optional_expand",
    """
    SELECT c_custkey AS custkey, o_orderkey AS orderkey, o_totalprice AS price FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 450000
    """,
)
def optional_expand(spark, folder):
    """MATCH (c:Customer) OPTIONAL MATCH (c)-[:PLACED]->(o:Order {priority: '1-URGENT'})
    WHERE o.totalprice > 450000 RETURN c.custkey, o.orderkey, o.totalprice"""
    m = shop_graph(spark, folder).match("c", "Customer").optional(
        "c", "r", "o", types="PLACED", labels="Order",
        where=lambda m: (m["o.priority"] == "1-URGENT") & (m["o.totalprice"] > 450000),
    )
    return m.select(custkey="c.custkey", orderkey="o.orderkey", price="o.totalprice")


@query(
    "optional_count",
    """
    SELECT p_partkey AS partkey, coalesce(n, 0) AS n_lines, CAST(q AS DOUBLE) AS quantity FROM part LEFT JOIN (
        SELECT l_partkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem
        WHERE l_quantity > 45 GROUP BY l_partkey) ON l_partkey = p_partkey
    """,
)
def optional_count(spark, folder):
    """MATCH (p:Part) OPTIONAL MATCH (p)<-[l:CONTAINS]-() WHERE l.quantity > 45
    RETURN p.partkey, count(l), sum(l.quantity)"""
    m = shop_graph(spark, folder).match("p", "Part").expand_aggregate(
        "p",
        types="CONTAINS",
        direction="in",
        optional=True,
        where=lambda m: m["rel.quantity"] > 45,
        aggregates=lambda m: {"n": agg.count_all(), "quantity": exact_sum(m["rel.quantity"])},
    )
    return m.select("quantity", partkey="p.partkey", n_lines=F.coalesce("n", F.lit(0)))


@query(
    "exists_pattern",
    """
    SELECT c_custkey AS custkey, c_name AS name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
    """,
)
def exists_pattern(spark, folder):
    """MATCH (c:Customer) WHERE (c)-[:PLACED]->({totalprice > 400000}) AND NOT (c)-[:PLACED]->({status: 'P'})
    RETURN c.custkey, c.name"""
    m = shop_graph(spark, folder).match("c", "Customer")
    m = m.exists("c", types="PLACED", where=lambda m: m["node.totalprice"] > 400000)
    m = m.exists("c", types="PLACED", where=lambda m: m["node.status"] == "P", negated=True)
    return m.select(custkey="c.custkey", name="c.name")


@query(
    "exists_flag",
    """
    SELECT c_mktsegment AS segment, k IS NOT NULL AS urgent, count(*) AS n FROM customer LEFT JOIN (
        SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT') ON k = c_custkey
    GROUP BY 1, 2
    """,
)
def exists_flag(spark, folder):
    """MATCH (c:Customer) RETURN c.segment, exists((c)-[:PLACED]->({priority: '1-URGENT'})), count(*)"""
    m = shop_graph(spark, folder).match("c", "Customer")
    m = m.with_exists("urgent", "c", types="PLACED", where=lambda m: m["node.priority"] == "1-URGENT")
    return m.df.groupBy(m["c.segment"].alias("segment"), "urgent").agg(agg.count_all().alias("n"))


@query(
    "var_length_1_2",
    """
    SELECT 'Nation' AS label, 1 AS hops, count(*) AS n FROM customer
    UNION ALL SELECT 'Region', 2, count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey
    """,
)
def var_length_1_2(spark, folder):
    """MATCH (c:Customer)-[p:IN_NATION|IN_REGION*1..2]->(x) RETURN labels(x), size(p), count(*)"""
    m = shop_graph(spark, folder).match("c", "Customer")
    m = m.expand_path("c", "p", "x", types=["IN_NATION", "IN_REGION"], max_hops=2)
    return m.df.groupBy(F.array_join(m.labels("x"), ":").alias("label"), F.size("p").alias("hops")).agg(
        agg.count_all().alias("n")
    )


@query(
    "value_join",
    """
    SELECT c_custkey AS custkey, c_name AS name, u AS userid FROM customer
    JOIN (SELECT DISTINCT user_id AS u FROM events) ON u = c_custkey
    """,
)
def value_join(spark, folder):
    """FROM GRAPH shop MATCH (c:Customer) FROM GRAPH activity MATCH (u:User) WHERE c.custkey = u.userid
    RETURN c.custkey, c.name, u.userid"""
    customers = shop_graph(spark, folder).match("c", "Customer")
    users = activity_graph(spark, folder).match("u", "User")
    m = customers.join(users, on=[("c.custkey", "u.userid")])
    return m.select(custkey="c.custkey", name="c.name", userid="u.userid")


@query(
    "group_entity_agg",
    f"""
    SELECT CAST(n_nationkey AS BIGINT) AS nationkey, n_name AS name, count(*) AS n, count(DISTINCT c_mktsegment) AS n_segments,
        min(c_acctbal) AS least, max(c_acctbal) AS most, {EXACT.format('c_acctbal')} AS total,
        CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name
    """,
)
def group_entity_agg(spark, folder):
    """MATCH (n:Nation)<-[:IN_NATION]-(c:Customer)
    RETURN n, count(*), count(DISTINCT c.segment), min, max, sum and avg of c.acctbal"""
    m = shop_graph(spark, folder).match("n", "Nation").expand_aggregate(
        "n",
        types="IN_NATION",
        labels="Customer",
        direction="in",
        aggregates=lambda m: {
            "n": agg.count_all(),
            "n_segments": agg.count_distinct(m["node.segment"]),
            "least": agg.smallest(m["node.acctbal"]),
            "most": agg.largest(m["node.acctbal"]),
            "total": exact_sum(m["node.acctbal"]),
        },
    )
    return m.select(
        F.col("n"), "n_segments", "least", "most", "total", (F.col("total") / F.col("n")).alias("mean"),
        nationkey="n.nationkey", name="n.name",
    )


@query(
    "group_by_entity",
    """
    SELECT n_name AS n_name, CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(n_nationkey AS BIGINT) * 128 + 5 AS n_id,
        o_orderstatus AS o_status, count(*) AS n_orders
    FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
    GROUP BY n_name, n_nationkey, o_orderstatus
    """,
)
def group_by_entity(spark, folder):
    """MATCH (n:Nation)<-[:IN_NATION]-(c:Customer)-[:PLACED]->(o:Order) RETURN n, o.status, count(*)"""
    m = shop_graph(spark, folder).match("o", "Order").expand("o", "r", "c", types="PLACED", direction="in")
    m = m.expand("c", "i", "n", types="IN_NATION", labels="Nation")
    return m.group(["n", "o.status"], n_orders=agg.count_all())


@query(
    "global_agg",
    f"""
    SELECT count(*) AS n, count(o_orderpriority) AS n_priority, count(DISTINCT o_custkey) AS n_customers,
        min(o_totalprice) AS least, max(o_totalprice) AS most, {EXACT.format('o_totalprice')} AS total,
        CAST(floor(avg(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS mean
    FROM orders
    """,
)
def global_agg(spark, folder):
    """MATCH (c)-[r:PLACED]->(o:Order) RETURN count(*), ... over everything"""
    m = shop_graph(spark, folder).match("o", "Order").expand("o", "r", None, types="PLACED", direction="in")
    price = m["o.totalprice"]
    return agg.group(
        m.df,
        n=agg.count_all(),
        n_priority=agg.count(m["o.priority"]),
        n_customers=agg.count_distinct(m.start_node("r")),
        least=agg.smallest(price),
        most=agg.largest(price),
        total=exact_sum(price),
        mean=F.floor(F.avg(money(price))).cast("bigint"),
    )


@query(
    "avg_as_type",
    "SELECT o_orderpriority AS priority, CAST(floor(avg(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS mean "
    "FROM orders GROUP BY 1",
)
def avg_as_type(spark, folder):
    """MATCH (o:Order) RETURN o.priority, toInteger(avg(o.totalprice))"""
    m = shop_graph(spark, folder).match("o", "Order")
    return agg.group(m.df, [m["o.priority"].alias("priority")], mean=agg.avg(money(m["o.totalprice"]), "bigint"))


@query(
    "collect_sorted",
    """
    SELECT name, string_agg(k, ',' ORDER BY k) AS counts, string_agg(segment, ',' ORDER BY segment) AS segments FROM (
        SELECT n_name AS name, c_mktsegment AS segment, count(*) AS k FROM nation
        JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY name
    """,
)
def collect_sorted(spark, folder):
    """MATCH (n:Nation)<-[:IN_NATION]-(c:Customer) WITH n, c.segment AS segment, count(*) AS k
    RETURN n.name, collect(k), collect(DISTINCT segment). What is collected is counted first, so a
    nation with very many customers still has as few values to collect as there are segments."""
    m = shop_graph(spark, folder).match("c", "Customer").expand("c", "r", "n", types="IN_NATION", labels="Nation")
    counted = agg.group(
        m.df, [m["n.name"].alias("name"), m["c.segment"].alias("segment")], k=agg.count_all()
    )
    return agg.group(
        counted,
        ["name"],
        counts=F.array_join(agg.collect(F.col("k")), ","),
        segments=F.array_join(agg.collect_distinct(F.col("segment")), ","),
    )


@query(
    "collect_counted",
    """
    SELECT segment, string_agg(status || 'x' || n, ',' ORDER BY status) AS statuses FROM (
        SELECT c_mktsegment AS segment, o_orderstatus AS status, count(*) AS n FROM customer
        JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) GROUP BY segment
    """,
)
def collect_counted(spark, folder):
    """MATCH (c:Customer)-[:PLACED]->(o:Order) RETURN c.segment, collect(o.status), repetitions counted"""
    m = shop_graph(spark, folder).match("o", "Order").expand("o", "r", "c", types="PLACED", direction="in")
    pairs = m.select(segment="c.segment", status="o.status")
    folded = agg.collect_counted(pairs, ["segment"], "status", "found")
    text = F.transform("found", lambda e: F.concat(e["value"], F.lit("x"), e["n"].cast("string")))
    return folded.select("segment", F.array_join(text, ",").alias("statuses"))


@query(
    "collect_segments",
    """
    SELECT status, segment, string_agg(orderkey, ',' ORDER BY orderkey) AS orderkeys FROM (
        SELECT o_orderstatus AS status, o_orderkey AS orderkey,
            CAST((row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1) // 500 AS BIGINT) AS segment FROM orders)
    GROUP BY status, segment
    """,
)
def collect_segments(spark, folder):
    """MATCH (o:Order) RETURN o.status, collect(o.orderkey), each list in segments of bounded length"""
    rows = shop_graph(spark, folder).match("o", "Order").select(status="o.status", orderkey="o.orderkey")
    segments = agg.collect_segments(rows, ["status"], "orderkey", "found", size=500)
    return segments.select("status", "segment", F.array_join("found", ",").alias("orderkeys"))


@query(
    "return_entity",
    """
    SELECT o_orderkey * 128 + 2 AS id, 'Order' AS labels, o_orderkey AS orderkey,
        'orderdate,orderkey,priority,status,totalprice' AS keys, o_totalprice AS totalprice,
        'PLACED' AS type, o_custkey * 128 + 1 AS start_id, o_orderkey * 128 + 2 AS end_id
    FROM orders
    """,
)
def return_entity(spark, folder):
    """MATCH ()-[r:PLACED]->(o:Order) RETURN o, r, with their parts taken from the values"""
    m = shop_graph(spark, folder).match("o", "Order")
    m = m.expand("o", "r", None, types="PLACED", direction="in")
    found = m.with_column("found_keys", m.keys("o")).select("o", "r", "found_keys")
    o, r = F.col("o"), F.col("r")
    return found.select(
        entities.entity_id(o).alias("id"),
        F.array_join(entities.labels(o), ":").alias("labels"),
        entities.properties(o)["orderkey"].alias("orderkey"),
        F.array_join("found_keys", ",").alias("keys"),
        entities.properties(o)["totalprice"].alias("totalprice"),
        entities.rel_type(r).alias("type"),
        entities.start_node(r).alias("start_id"),
        entities.end_node(r).alias("end_id"),
    )


@query(
    "order_by_page",
    "SELECT o_orderkey AS orderkey, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey "
    "LIMIT 100 OFFSET 50",
)
def order_by_page(spark, folder):
    """MATCH (o:Order) RETURN o.orderkey, o.totalprice ORDER BY o.totalprice DESC, o.orderkey SKIP 50 LIMIT 100"""
    rows = shop_graph(spark, folder).match("o", "Order").select(orderkey="o.orderkey", price="o.totalprice")
    return page(rows, F.col("price").desc(), F.col("orderkey"), skip=50, limit=100)


@query(
    "parameters",
    """
    SELECT o_orderkey AS orderkey, o_orderpriority AS priority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 300000 AND o_orderstatus = 'O'
    """,
)
def parameters(spark, folder):
    """MATCH (o:Order) WHERE o.priority IN $priorities AND o.totalprice > $limits.low AND o.status = $status
    RETURN o.orderkey, o.priority"""
    given = {"priorities": ["1-URGENT", "2-HIGH"], "limits": {"low": 300000}, "status": "O"}
    p = {name: lists.parameter(value) for name, value in given.items()}
    m = shop_graph(spark, folder).match("o", "Order")
    m = m.where(
        F.array_contains(p["priorities"], m["o.priority"])
        & (m["o.totalprice"] > p["limits"]["low"])
        & (m["o.status"] == p["status"])
    )
    return m.select(orderkey="o.orderkey", priority="o.priority")


@query(
    "update_nodes",
    """
    SELECT c_custkey AS custkey, 'Customer,Wealthy' AS labels, true AS vip, c_name AS name FROM customer
    WHERE c_acctbal > 9000
    """,
)
def update_nodes(spark, folder):
    """MATCH (c:Customer) WHERE c.acctbal > 9000, each node with a label and a property added"""
    m = shop_graph(spark, folder).match("c", "Customer", where=lambda m: m["c.acctbal"] > 9000)
    changed = entities.with_property(entities.with_label(F.col("c"), "Wealthy"), "vip", F.lit(True))
    return m.select("c").select(changed.alias("c")).select(
        F.col("c.properties.custkey").alias("custkey"),
        F.array_join("c.labels", ",").alias("labels"),
        F.col("c.properties.vip").alias("vip"),
        F.col("c.properties.name").alias("name"),
    )


@query(
    "closing_cycle",
    """
    SELECT c_custkey AS custkey, n_name AS nation, s_suppkey AS suppkey FROM customer
    JOIN nation ON n_nationkey = c_nationkey
    JOIN supplier ON s_suppkey = c_custkey AND s_nationkey = n_nationkey
    """,
)
def closing_cycle(spark, folder):
    """MATCH (c:Customer), (s:Supplier) WHERE s.suppkey = c.custkey
    MATCH (c)-[:IN_NATION]->(n:Nation)<-[:IN_NATION]-(s) RETURN c.custkey, n.name, s.suppkey"""
    graph = shop_graph(spark, folder)
    m = graph.match("c", "Customer").join(graph.match("s", "Supplier"), on=[("c.custkey", "s.suppkey")])
    m = m.expand("c", "i", "n", types="IN_NATION", labels="Nation")
    m = m.expand("n", "j", "s", types="IN_NATION", direction="in")
    return m.select(custkey="c.custkey", nation="n.name", suppkey="s.suppkey")


# -- inline predicates, chains of optional steps, paths between bound nodes ------------------------


@query(
    "inline_expand",
    """
    SELECT p_brand AS brand, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' AND p_size = 10 GROUP BY 1
    """,
)
def inline_expand(spark, folder):
    """MATCH (o:Order)-[l:CONTAINS {returnflag: 'R'}]->(p:Part {size: 10}) RETURN p.brand, count(*)"""
    m = shop_graph(spark, folder).match("o", "Order")
    m = m.expand("o", "l", "p", types="CONTAINS", labels="Part", rel_where={"returnflag": "R"}, node_where={"size": 10})
    return m.df.groupBy(m["p.brand"].alias("brand")).agg(agg.count_all().alias("n"))


_URGENT = "SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT'"


@query("inline_exists", f"SELECT c_custkey AS custkey FROM customer WHERE EXISTS ({_URGENT})")
def inline_exists(spark, folder):
    """MATCH (c:Customer) WHERE (c)-[:PLACED]->({priority: '1-URGENT'}) RETURN c.custkey"""
    m = shop_graph(spark, folder).match("c", "Customer")
    return m.exists("c", types="PLACED", node_where={"priority": "1-URGENT"}).select(custkey="c.custkey")


@query("inline_not_exists", f"SELECT c_custkey AS custkey FROM customer WHERE NOT EXISTS ({_URGENT})")
def inline_not_exists(spark, folder):
    m = shop_graph(spark, folder).match("c", "Customer")
    return m.exists("c", types="PLACED", node_where={"priority": "1-URGENT"}, negated=True).select(custkey="c.custkey")


@query(
    "optional_chain",
    """
    SELECT r_name AS region, count(*) AS n, count(c_custkey) AS n_customers, count(o_orderkey) AS n_orders FROM region
    LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
    LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY 1
    """,
)
def optional_chain(spark, folder):
    """MATCH (r:Region) OPTIONAL MATCH (r)<-[:IN_REGION]-(n:Nation) OPTIONAL MATCH (n)<-[:IN_NATION]-(c:Customer)
    OPTIONAL MATCH (c)-[:PLACED]->(o:Order {priority: '1-URGENT'}) RETURN r.name, count(*), count(c), count(o)"""
    m = shop_graph(spark, folder).match("r", "Region")
    m = m.optional("r", "x", "n", types="IN_REGION", labels="Nation", direction="in").next_pattern()
    m = m.optional("n", "y", "c", types="IN_NATION", labels="Customer", direction="in").next_pattern()
    m = m.optional("c", "z", "o", types="PLACED", labels="Order", node_where={"priority": "1-URGENT"})
    return m.df.groupBy(m["r.name"].alias("region")).agg(
        agg.count_all().alias("n"), agg.count(m.id("c")).alias("n_customers"), agg.count(m.id("o")).alias("n_orders")
    )


@query(
    "var_length_closing",
    """
    SELECT r_name AS region, 2 AS hops, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey GROUP BY 1
    """,
)
def var_length_closing(spark, folder):
    """MATCH (c:Customer)-[:IN_NATION]->(n)-[:IN_REGION]->(r) MATCH (c)-[p:IN_NATION|IN_REGION*1..2]->(r)
    RETURN r.name, size(p), count(*)"""
    m = shop_graph(spark, folder).match("c", "Customer").expand("c", "x", "n", types="IN_NATION")
    m = m.expand("n", "y", "r", types="IN_REGION").next_pattern()
    m = m.expand_path("c", "p", "r", types=["IN_NATION", "IN_REGION"], max_hops=2)
    return m.df.groupBy(m["r.name"].alias("region"), F.size("p").alias("hops")).agg(agg.count_all().alias("n"))


@query(
    "var_length_optional",
    """
    SELECT c_mktsegment AS segment, count(*) AS n, count(l_partkey) AS n_parts FROM customer
    LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
    LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def var_length_optional(spark, folder):
    """MATCH (c:Customer) OPTIONAL MATCH (c)-[:PLACED]->(o {priority: '1-URGENT'})
    OPTIONAL MATCH (o)-[p:CONTAINS*1..2]->(x:Part) RETURN c.segment, count(*), count(x)"""
    m = shop_graph(spark, folder).match("c", "Customer")
    m = m.optional("c", "r", "o", types="PLACED", node_where={"priority": "1-URGENT"}).next_pattern()
    m = m.expand_path("o", "p", "x", types="CONTAINS", labels="Part", max_hops=2, optional=True)
    return m.df.groupBy(m["c.segment"].alias("segment")).agg(
        agg.count_all().alias("n"), agg.count(m.id("x")).alias("n_parts")
    )
