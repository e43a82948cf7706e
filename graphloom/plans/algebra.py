"""Table operations on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.model.types import normalize_types
from graphloom.operators import aggregates as agg
from graphloom.operators import ids, paging
from graphloom.operators import table as t
from graphloom.plans.registry import query
from graphloom.plans.tables import exact_sum, shop_graph, table


@query(
    "table_select_rename",
    """
    SELECT o_orderkey AS "order.key", o_orderstatus AS st, o_totalprice * 2 AS o_totalprice, 'x' AS extra
    FROM orders WHERE o_orderpriority = '5-LOW'
    """,
)
def table_select_rename(spark, folder):
    orders = t.filter_rows(table(spark, folder, "orders"), F.col("o_orderpriority") == "5-LOW")
    changed = t.with_columns(orders, {"o_totalprice": F.col("o_totalprice") * 2, "extra": F.lit("x")})
    kept = t.drop(changed, "o_custkey", "o_orderdate", "no_such_column")
    picked = t.select(kept, ("o_orderkey", "order.key"), "o_orderstatus", "o_totalprice", "extra")
    return t.rename(picked, {"o_orderstatus": "st"})


@query(
    "table_guarded_columns",
    "SELECT p_partkey AS pre_p_partkey, p_retailprice * 0.5 AS p_retailprice, upper(p_name) AS pre_shout, "
    "upper(p_brand) AS pre_p_brand FROM part",
)
def table_guarded_columns(spark, folder):
    part = t.drop_existing(table(spark, folder, "part"), "p_size", "p_type")
    added = t.add_columns(part, {"shout": F.upper("p_name")})
    replaced = t.replace_column(added, "p_retailprice", F.col("p_retailprice") * 0.5)
    changed = t.transform_columns(t.drop(replaced, "p_name"), ["p_brand"], F.upper)
    prefixed = t.prefix_columns(changed, "pre_")
    return t.rename(prefixed, {"pre_p_retailprice": "p_retailprice"})


@query(
    "table_skip",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
        SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
        FROM lineitem) WHERE rn > 1000
    """,
)
def table_skip(spark, folder):
    """Everything but the first thousand rows of a total order."""
    columns = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = t.select(table(spark, folder, "lineitem"), *columns)
    return t.drop(paging.skip(rows, 1000, *columns), "l_shipdate")


@query(
    "table_row_index",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_index FROM orders
    """,
)
def table_row_index(spark, folder):
    orders = t.select(table(spark, folder, "orders"), "o_orderkey", "o_totalprice")
    return t.drop(t.with_row_index(orders, F.col("o_totalprice").desc(), "o_orderkey"), "o_totalprice")


@query(
    "table_limit",
    "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20",
)
def table_limit(spark, folder):
    supplier = t.select(table(spark, folder, "supplier"), "s_suppkey", "s_acctbal")
    return t.limit(t.order_by(supplier, F.col("s_acctbal").desc(), "s_suppkey"), 20)


@query(
    "table_union_all",
    "SELECT c_name AS name, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier",
)
def table_union_all(spark, folder):
    customers = t.select(table(spark, folder, "customer"), ("c_name", "name"), ("c_acctbal", "acctbal"))
    suppliers = t.select(table(spark, folder, "supplier"), ("s_name", "name"), ("s_acctbal", "acctbal"))
    return t.union_all(customers, suppliers)


@query("table_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def table_distinct(spark, folder):
    return t.distinct(t.select(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus", "l_linenumber"))


@query(
    "table_distinct_on",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1
    """,
)
def table_distinct_on(spark, folder):
    """The cheapest order of each customer."""
    orders = t.select(table(spark, folder, "orders"), "o_custkey", "o_orderkey", "o_totalprice")
    return t.distinct_on(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"])


def _sides(spark, folder):
    """Customers with money, and what was spent per customer on urgent orders."""
    rich = t.select(table(spark, folder, "customer"), "c_custkey", "c_name", "c_acctbal").where("c_acctbal > 5000")
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    spent = agg.group(urgent, ["o_custkey"], spent=exact_sum(F.col("o_totalprice")))
    return rich, spent


_JOIN_SQL = """
    SELECT c_custkey, c_name, o_custkey, spent FROM (SELECT * FROM customer WHERE c_acctbal > 5000) {} JOIN (
        SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' GROUP BY o_custkey) ON c_custkey = o_custkey
"""


def _joined(spark, folder, how):
    return t.drop(t.join(*_sides(spark, folder), [("c_custkey", "o_custkey")], how), "c_acctbal")


@query("join_inner", _JOIN_SQL.format("INNER"))
def join_inner(spark, folder):
    return _joined(spark, folder, "inner")


@query("join_left", _JOIN_SQL.format("LEFT"))
def join_left(spark, folder):
    return _joined(spark, folder, "left")


@query("join_right", _JOIN_SQL.format("RIGHT"))
def join_right(spark, folder):
    return _joined(spark, folder, "right")


@query("join_full", _JOIN_SQL.format("FULL"))
def join_full(spark, folder):
    return _joined(spark, folder, "full")


@query("table_size", "SELECT count(*) AS n FROM lineitem")
def table_size(spark, folder):
    return agg.group(table(spark, folder, "lineitem"), n=agg.count_all())


@query(
    "table_normalized_types",
    """
    SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS n
    FROM lineitem GROUP BY l_linenumber
    """,
)
def table_normalized_types(spark, folder):
    """Small integers come out as 64-bit ones; the table is checked against its declared types."""
    lines = normalize_types(t.select(table(spark, folder, "lineitem"), "l_linenumber", "l_quantity"))
    checked = t.validate(lines, {"l_linenumber": T.LongType(), "l_quantity": T.DoubleType()})
    return agg.group(checked, ["l_linenumber"], total=agg.total(F.col("l_linenumber")), n=agg.count_all())


@query(
    "table_hex_ids",
    "SELECT c_custkey AS custkey, hex(c_name) AS name_hex, c_name AS name FROM customer",
)
def table_hex_ids(spark, folder):
    """Binary ids written as hex text, and read back."""
    named = table(spark, folder, "customer").select("c_custkey", F.col("c_name").cast("binary").alias("name"))
    coded = t.binary_to_hex(t.normalize_ids(named, "c_custkey", "name"))
    both = coded.withColumn("name_hex", F.col("name"))
    decoded = t.hex_to_binary(both, "name")
    return decoded.select(F.col("c_custkey").alias("custkey"), "name_hex", F.col("name").cast("string").alias("name"))


@query(
    "serialized_ids",
    """
    SELECT '3|' || length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey || length(CAST(l_partkey AS VARCHAR))
        || ':' || l_partkey || length(CAST(l_suppkey AS VARCHAR)) || ':' || l_suppkey
        || length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber AS id
    FROM lineitem
    """,
)
def serialized_ids(spark, folder):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return table(spark, folder, "lineitem").select(ids.serialized_id(3, keys).alias("id"))


@query("hashed_ids", "SELECT count(*) AS n, count(*) AS n_ids FROM orders")
def hashed_ids(spark, folder):
    hashed = table(spark, folder, "orders").select(ids.hashed_id("orders", ["Order"], ["o_orderkey"]).alias("id"))
    return agg.group(hashed, n=agg.count_all(), n_ids=agg.count_distinct(F.col("id")))


@query("packed_ids", "SELECT o_orderkey AS key, o_orderkey * 128 + 7 AS id FROM orders")
def packed_ids(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), ids.packed_id(7, "o_orderkey").alias("id")
    )


@query(
    "unique_ids",
    """
    SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS n,
        (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS n_ids
    """,
)
def unique_ids(spark, folder):
    """Generated ids do not repeat over two tables."""
    tables = [table(spark, folder, n).select(F.lit(n).alias("name")) for n in ("customer", "orders")]
    with_ids = ids.add_unique_ids(tables)
    return agg.group(
        t.union_all(*with_ids), n=agg.count_all(), n_ids=agg.count_distinct(F.col("id"))
    )


@query(
    "null_order",
    """
    SELECT c_custkey, row_number() OVER (ORDER BY spent NULLS FIRST, c_custkey) - 1 AS row_index FROM customer
    LEFT JOIN (
        SELECT o_custkey, max(o_totalprice) AS spent FROM orders
        WHERE o_orderstatus = 'P' AND o_totalprice > 400000 GROUP BY o_custkey) ON o_custkey = c_custkey
    """,
)
def null_order(spark, folder):
    """Nulls come first in ascending order."""
    m = shop_graph(spark, folder).match("c", "Customer").expand_aggregate(
        "c", types="PLACED", labels="Order", optional=True,
        where=lambda m: (m["node.status"] == "P") & (m["node.totalprice"] > 400000),
        aggregates=lambda m: {"spent": agg.largest(m["node.totalprice"])},
    )
    return t.drop(t.with_row_index(m.select("spent", c_custkey="c.custkey"), "spent", "c_custkey"), "spent")
