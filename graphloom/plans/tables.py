"""The order-management tables as graphs and as documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.model.graph import Held, NodeTable, PropertyGraph, RelTable
from graphloom.operators.documents import pack_documents
from graphloom.operators.ids import packed_id, serialized_id
from graphloom.sources.documents import DocumentStore

# Tags that keep the ids of different labels apart.
CUSTOMER, ORDER, PART, SUPPLIER, NATION, REGION, USER, EVENT = range(1, 9)

DATASOURCE = "shop"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(column: Column) -> Column:
    """Exact decimal, so that a sum does not depend on the order of its terms."""
    return column.cast("decimal(18,2)")


def exact_sum(column: Column) -> Column:
    return F.sum(money(column)).cast("double")


def _rel_id(kind: str, *columns: str) -> Column:
    return serialized_id(kind, columns)


def _node(df: DataFrame, label: str, tag: int, key: str, properties: dict[str, str], *held: _Key) -> NodeTable:
    columns = [packed_id(tag, key).alias("id"), *[F.col(c).alias(p) for p, c in properties.items()]]
    for fk in held:
        columns += [_rel_id(fk.kind, key).alias(f"@{fk.rel_type}"), packed_id(fk.tag, fk.column).alias(f"@{fk.column}")]
    return NodeTable(
        label,
        df.select(columns),
        [Held(fk.rel_type, fk.end, f"@{fk.column}", f"@{fk.rel_type}", frozenset([fk.label])) for fk in held],
    )


@dataclass(frozen=True)
class _Key:
    """A foreign key read as a relationship: the rows hold its `end`, the column leads to the other."""

    rel_type: str
    end: str
    column: str
    tag: int
    label: str
    kind: str


@lru_cache(maxsize=8)
def shop_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    """`(Customer)-[PLACED]->(Order)-[CONTAINS]->(Part)<-[SUPPLIES]-(Supplier)`, and customers and
    suppliers `-[IN_NATION]->(Nation)-[IN_REGION]->(Region)`. Foreign keys are held relationships."""
    customer, orders, part, supplier, nation, region, lineitem = (
        table(spark, folder, n)
        for n in ("customer", "orders", "part", "supplier", "nation", "region", "lineitem")
    )
    nodes = [
        _node(customer, "Customer", CUSTOMER, "c_custkey",
              {"custkey": "c_custkey", "name": "c_name", "acctbal": "c_acctbal", "segment": "c_mktsegment"},
              _Key("IN_NATION", "source", "c_nationkey", NATION, "Nation", "IN_NATION Customer")),
        _node(orders, "Order", ORDER, "o_orderkey",
              {"orderkey": "o_orderkey", "status": "o_orderstatus", "totalprice": "o_totalprice",
               "orderdate": "o_orderdate", "priority": "o_orderpriority"},
              _Key("PLACED", "target", "o_custkey", CUSTOMER, "Customer", "PLACED")),
        _node(part, "Part", PART, "p_partkey",
              {"partkey": "p_partkey", "name": "p_name", "brand": "p_brand", "kind": "p_type", "size": "p_size",
               "retailprice": "p_retailprice"}),
        _node(supplier, "Supplier", SUPPLIER, "s_suppkey",
              {"suppkey": "s_suppkey", "name": "s_name", "acctbal": "s_acctbal"},
              _Key("IN_NATION", "source", "s_nationkey", NATION, "Nation", "IN_NATION Supplier")),
        _node(nation, "Nation", NATION, "n_nationkey", {"nationkey": "n_nationkey", "name": "n_name"},
              _Key("IN_REGION", "source", "n_regionkey", REGION, "Region", "IN_REGION")),
        _node(region, "Region", REGION, "r_regionkey", {"regionkey": "r_regionkey", "name": "r_name"}),
    ]
    supplies = lineitem.select("l_suppkey", "l_partkey").distinct()
    rels = [
        RelTable(
            "CONTAINS",
            lineitem.select(
                _rel_id("CONTAINS", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
                packed_id(ORDER, "l_orderkey").alias("source"),
                packed_id(PART, "l_partkey").alias("target"),
                F.col("l_quantity").alias("quantity"),
                F.col("l_extendedprice").alias("price"),
                F.col("l_discount").alias("discount"),
                F.col("l_returnflag").alias("returnflag"),
                F.col("l_shipdate").alias("shipdate"),
            ),
            ["Order"], ["Part"],
        ),
        RelTable(
            "SUPPLIES",
            supplies.select(
                _rel_id("SUPPLIES", "l_suppkey", "l_partkey").alias("id"),
                packed_id(SUPPLIER, "l_suppkey").alias("source"),
                packed_id(PART, "l_partkey").alias("target"),
            ),
            ["Supplier"], ["Part"],
        ),
    ]
    return PropertyGraph.from_tables(*nodes, *rels)


@lru_cache(maxsize=8)
def activity_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    """`(User)-[DID]->(Event {kind, ts, value})` from the events table, which holds who did it."""
    events = table(spark, folder, "events")
    users = events.select("user_id").distinct()
    return PropertyGraph.from_tables(
        _node(users, "User", USER, "user_id", {"userid": "user_id"}),
        _node(events, "Event", EVENT, "event_id", {"kind": "event_type", "ts": "ts", "value": "value"},
              _Key("DID", "target", "user_id", USER, "User", "DID")),
    )


@lru_cache(maxsize=8)
def shop_documents(spark: SparkSession, folder: str) -> DocumentStore:
    """Customers and parts as vertex documents, orders as edge documents from customer to order."""
    customer, part, orders = (table(spark, folder, n) for n in ("customer", "part", "orders"))
    customers = pack_documents(
        customer, DATASOURCE, "customer", F.concat(F.lit("c"), F.col("c_custkey").cast("string")),
        {"name": "c_name", "acctbal": "c_acctbal", "segment": "c_mktsegment", "nation": "c_nationkey"},
    )
    parts = pack_documents(
        part, DATASOURCE, "part", F.concat(F.lit("p"), F.col("p_partkey").cast("string")),
        {"name": "p_name", "brand": "p_brand", "size": "p_size", "retailprice": "p_retailprice"},
    )
    placed = pack_documents(
        orders, DATASOURCE, "placed", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")),
        {"status": "o_orderstatus", "totalprice": "o_totalprice", "priority": "o_orderpriority"},
        timestamp=F.col("o_orderdate"),
        src=F.concat(F.lit("c"), F.col("o_custkey").cast("string")),
        dst=F.concat(F.lit("o"), F.col("o_orderkey").cast("string")),
    )
    return DocumentStore(customers.unionAll(parts), placed)
