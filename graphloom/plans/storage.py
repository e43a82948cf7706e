"""Graphs and results written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.model.graph import NodeTable, PropertyGraph
from graphloom.operators import aggregates as agg
from graphloom.plans.registry import query
from graphloom.plans.tables import exact_sum, shop_graph, table
from graphloom.session import new_location
from graphloom.sinks.tables import materialize, read_graph_tables, save_as_table, save_graph_tables, save_result
from graphloom.sources.edge_list import edge_list_graph
from graphloom.sources.graph_files import GraphFiles

_STORED_SQL = """
    SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS n,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2
"""


def _sales(spark, folder) -> PropertyGraph:
    """Customers, orders and who placed them."""
    graph = shop_graph(spark, folder)
    nodes = [*graph.node_tables("Customer"), *graph.node_tables("Order")]
    return PropertyGraph.from_tables(*[n.holding("PLACED") for n in nodes])


def _spending(graph):
    m = graph.match("c", "Customer").expand("c", "r", "o", types="PLACED", labels="Order")
    return m.df.groupBy(m["c.segment"].alias("segment"), m["o.priority"].alias("priority")).agg(
        agg.count_all().alias("n"), exact_sum(m["o.totalprice"]).alias("total")
    )


def _stored(spark, folder, format, **options):
    files = GraphFiles(spark, new_location(spark, "graphs"), format, **options)
    files.store("sales", _sales(spark, folder))
    return files.graph("sales")


@query("store_reload_parquet", _STORED_SQL)
def store_reload_parquet(spark, folder):
    return _spending(_stored(spark, folder, "parquet"))


@query("store_reload_orc", _STORED_SQL)
def store_reload_orc(spark, folder):
    return _spending(_stored(spark, folder, "orc"))


@query("store_reload_csv", _STORED_SQL)
def store_reload_csv(spark, folder):
    return _spending(_stored(spark, folder, "csv"))


@query(
    "graph_tables",
    """
    SELECT c_custkey AS custkey, c_name AS name, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE c_acctbal < 0 GROUP BY 1, 2
    """,
)
def graph_tables(spark, folder):
    """A graph saved as catalog tables, then a node table filtered and joined to an edge table in SQL."""
    location = new_location(spark, "database")
    database = f"loom_{location[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    save_graph_tables(_sales(spark, folder), "sales", database)
    return spark.sql(
        f"SELECT v.custkey, v.name, count(*) AS n FROM {database}.sales_vertex_customer v "
        f"JOIN {database}.sales_edge_placed e ON v.id = e.source WHERE v.acctbal < 0 GROUP BY v.custkey, v.name"
    )


@query(
    "graph_tables_in",
    """
    SELECT o_orderstatus AS status, count(*) AS n, count(DISTINCT o_custkey) AS n_sources FROM orders GROUP BY 1
    """,
)
def graph_tables_in(spark, folder):
    """MATCH (o:Order)<-[r:PLACED]-() on bucketed tables whose relationships are kept by target as well: no shuffle for the join."""
    location = new_location(spark, "database")
    database = f"loom_{location[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    graph = _sales(spark, folder)
    save_graph_tables(graph, "sales", database, buckets=8, reverse=True)
    saved = read_graph_tables(graph, "sales", database, direction="in")
    m = saved.match("o", "Order").expand("o", "r", types="PLACED", direction="in")
    return m.df.groupBy(m["o.status"].alias("status")).agg(
        agg.count_all().alias("n"), agg.count_distinct(F.col("r__source")).alias("n_sources")
    )


@query(
    "materialized_query",
    """
    SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1
    """,
)
def materialized_query(spark, folder):
    """A table defined by a graph query: saved, then read by name."""
    location = new_location(spark, "result")
    name = f"loom_result_{location[-32:]}"
    m = shop_graph(spark, folder).match("o", "Order")
    materialize(m.select(priority="o.priority", orderkey="o.orderkey"), name, location)
    return agg.group(spark.table(name), ["priority"], n=agg.count_all())


@query(
    "saved_result",
    "SELECT s_suppkey AS suppkey, s_name AS name FROM supplier",
)
def saved_result(spark, folder):
    m = shop_graph(spark, folder).match("s", "Supplier")
    path = save_result(m.select(suppkey="s.suppkey", name="s.name"), new_location(spark, "result"), "suppliers")
    return spark.read.parquet(path)


@query(
    "result_as_table",
    "SELECT p_partkey AS partkey, p_name AS name FROM part",
)
def result_as_table(spark, folder):
    """A result under a view name, and a managed table made of the view."""
    location = new_location(spark, "database")
    database = f"loom_{location[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    m = shop_graph(spark, folder).match("p", "Part")
    save_as_table(m.select(partkey="p.partkey", name="p.name"), f"view_{location[-32:]}", f"{database}.parts")
    return spark.table(f"{database}.parts")


@query(
    "edge_list_graph",
    """
    SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders UNION SELECT 10000000 + o_orderkey FROM orders)) AS n_nodes,
        count(*) AS n_edges, count(*) AS n_ids, count(DISTINCT o_custkey) AS n_sources FROM orders
    """,
)
def edge_list(spark, folder):
    """An edge list in text files, written from the orders, read as a graph."""
    path = new_location(spark, "edge-list")
    orders = table(spark, folder, "orders").select("o_custkey", F.col("o_orderkey") + 10_000_000)
    orders.write.option("sep", " ").csv(path)
    graph = edge_list_graph(spark, path)
    m = graph.match_relationships("e", "E")
    edges = agg.group(
        m.df,
        n_edges=agg.count_all(),
        n_ids=agg.count_distinct(m.id("e")),
        n_sources=agg.count_distinct(m.start_node("e")),
    )
    nodes = agg.group(graph.match("v", "V").df, n_nodes=agg.count_all())
    return edges.select("*", nodes.select("n_nodes").scalar().alias("n_nodes"))


@query(
    "external_tables",
    """
    SELECT o_orderstatus AS status, count(*) AS n, min(o_custkey) * 128 + 1 AS first_source FROM orders GROUP BY 1
    """,
)
def external_tables(spark, folder):
    """A graph stored in files, with external tables over them, queried by SQL text."""
    location = new_location(spark, "database")
    database = f"loom_{location[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    GraphFiles(spark, new_location(spark, "graphs"), "parquet", database=database).store("sales", _sales(spark, folder))
    return spark.sql(
        f"SELECT v.status, count(*) AS n, min(e.source) AS first_source FROM {database}.sales_vertex_Order v "
        f"JOIN {database}.sales_edge_PLACED e ON e.target = v.id GROUP BY v.status"
    )


_HARD_TEXT_SQL = """
    SELECT event_id AS eventid, CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL
        WHEN 2 THEN '  ' || event_type || ' "q", ' || chr(10) || ' ' WHEN 3 THEN chr(92) || 'n' || chr(92) || chr(13) || event_type
        ELSE event_type || chr(9) || chr(92) || 'N' END AS note, epoch_us(ts) + event_id % 1000 AS micros FROM events
"""


def _hard_text(spark, folder, format):
    """A graph of texts with blanks, quotes, backslashes and line breaks, and times to the microsecond."""
    kind = F.col("event_type")
    case = F.col("event_id") % 5
    note = (
        F.when(case == 0, F.lit(""))
        .when(case == 2, F.concat(F.lit("  "), kind, F.lit(' "q", \n ')))
        .when(case == 3, F.concat(F.lit("\\n\\\r"), kind))
        .when(case == 4, F.concat(kind, F.lit("\t\\N")))
    )
    micros = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 1000
    events = table(spark, folder, "events").select(
        F.col("event_id").cast("long").alias("id"), note.alias("note"), F.timestamp_micros(micros).alias("at")
    )
    files = GraphFiles(spark, new_location(spark, "graphs"), format)
    files.store("events", PropertyGraph.from_tables(NodeTable("Event", events)))
    files.store("events", files.graph("events"), overwrite=True)
    m = files.graph("events").match("e", "Event")
    return m.df.select(m.id("e").alias("eventid"), m["e.note"].alias("note"), F.unix_micros(m["e.at"]).alias("micros"))


@query("store_reload_csv_text", _HARD_TEXT_SQL)
def store_reload_csv_text(spark, folder):
    return _hard_text(spark, folder, "csv")


@query("store_reload_parquet_text", _HARD_TEXT_SQL)
def store_reload_parquet_text(spark, folder):
    return _hard_text(spark, folder, "parquet")


@query("store_reload_orc_text", _HARD_TEXT_SQL)
def store_reload_orc_text(spark, folder):
    return _hard_text(spark, folder, "orc")


@query("stored_file_count", _STORED_SQL)
def stored_file_count(spark, folder):
    """A graph stored in two files a table, and another deleted beside it."""
    files = GraphFiles(spark, new_location(spark, "graphs"), files_per_table=2)
    files.store("sales", _sales(spark, folder))
    files.store("other", _sales(spark, folder))
    files.delete("other")
    (name,) = files.graph_names()
    return _spending(files.graph(name))
