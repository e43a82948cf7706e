"""Customers, parts and orders as documents with property lists."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions import structs
from graphloom.operators import aggregates as agg
from graphloom.operators import documents as d
from graphloom.operators import metadata as meta
from graphloom.operators import updates
from graphloom.operators.table import order_by
from graphloom.plans.registry import query
from graphloom.plans.tables import DATASOURCE, exact_sum, shop_documents, table
from graphloom.session import new_location
from graphloom.sources.documents import EDGE, VERTEX, DocumentStore

CUSTOMER_KEYS = {"acctbal": T.DoubleType(), "name": T.StringType(), "nation": T.IntegerType(), "segment": T.StringType()}
ORDER_KEYS = {"priority": T.StringType(), "status": T.StringType(), "totalprice": T.DoubleType()}


def _vertices(spark, folder):
    return shop_documents(spark, folder)._documents[VERTEX]


def _edges(spark, folder):
    return shop_documents(spark, folder)._documents[EDGE]


@query(
    "doc_scan",
    """
    SELECT id, label, n FROM (
        SELECT 'c' || c_custkey AS id, 'customer' AS label, 4 AS n FROM customer
        UNION ALL SELECT 'p' || p_partkey, 'part', 4 FROM part)
    """,
)
def doc_scan(spark, folder):
    docs = shop_documents(spark, folder).vertices(DATASOURCE)
    return docs.select("id", "label", F.size("properties").alias("n"))


@query("doc_scan_label", "SELECT 'p' || p_partkey AS id, p_name AS name FROM part")
def doc_scan_label(spark, folder):
    docs = shop_documents(spark, folder).vertices(DATASOURCE, "part")
    return docs.select("id", d.property_value(F.col("properties"), "name").alias("name"))


@query(
    "doc_scan_labels",
    "SELECT 'customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'part', count(*) FROM part",
)
def doc_scan_labels(spark, folder):
    docs = shop_documents(spark, folder).vertices(DATASOURCE, ["customer", "part", "unknown"])
    return agg.group(docs, ["label"], n=agg.count_all())


@query(
    "doc_edges",
    "SELECT 'o' || o_orderkey AS id, 'c' || o_custkey AS src, 'o' || o_orderkey AS dst FROM orders",
)
def doc_edges(spark, folder):
    return shop_documents(spark, folder).edges(DATASOURCE, "placed").select("id", "src", "dst")


@query(
    "doc_count",
    "SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS n_vertices, "
    "(SELECT count(*) FROM orders) AS n_edges, 'shop' AS datasource",
)
def doc_count(spark, folder):
    return shop_documents(spark, folder).datasources()


@query(
    "eav_explode_vertex",
    """
    SELECT 'c' || c_custkey AS id, 'c' || c_custkey AS id_, 'customer' AS label, c_acctbal AS acctbal,
        c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    """,
)
def eav_explode_vertex(spark, folder):
    docs = _vertices(spark, folder).where("datasource = 'shop' AND label = 'customer'")
    return d.explode_vertices(docs, CUSTOMER_KEYS).drop("timestamp", "datasource")


@query(
    "eav_explode_edge",
    """
    SELECT 'o' || o_orderkey AS id, 'c' || o_custkey AS source, 'o' || o_orderkey AS target,
        'c' || o_custkey AS src, 'o' || o_orderkey AS dst, o_orderpriority AS priority, o_orderstatus AS status,
        o_totalprice AS totalprice, CAST(o_orderdate AS DATE) AS day FROM orders
    """,
)
def eav_explode_edge(spark, folder):
    docs = _edges(spark, folder).where("datasource = 'shop' AND label = 'placed'")
    rows = d.explode_edges(docs, ORDER_KEYS).withColumn("day", F.to_date("timestamp"))
    return rows.drop("timestamp", "datasource", "label", "id_")


def _regraded(spark, folder):
    """Documents of all vertices, where debtors have a second segment and large parts two sizes more."""
    docs = _vertices(spark, folder)
    debtor = d.property_value(F.col("properties"), "acctbal").try_cast("double") < 0
    large = d.property_value(F.col("properties"), "size").try_cast("int") > 40
    more = F.when(debtor, F.array(d.document_property("segment", F.lit("DEBTOR"), T.StringType())))
    more = more.when(large, F.array(*[d.document_property("size", F.lit(n), T.IntegerType()) for n in (0, 1)]))
    return docs.withColumn("properties", F.concat("properties", F.coalesce(more, F.array().cast(T.ArrayType(d.PROPERTY)))))


_REPEATED = {"segment": T.StringType(), "size": T.IntegerType()}


@query(
    "eav_repeated_keys",
    """
    SELECT 'c' || c_custkey AS id, c_mktsegment || CASE WHEN c_acctbal < 0 THEN ',DEBTOR' ELSE '' END AS segments, CAST(0 AS INT) AS n_sizes,
        NULL AS size_sum FROM customer
    UNION ALL SELECT 'p' || p_partkey, '', CASE WHEN p_size > 40 THEN 3 ELSE 1 END, CASE WHEN p_size > 40 THEN p_size + 1 ELSE p_size END FROM part
    """,
)
def eav_repeated_keys(spark, folder):
    """All values of keys that documents may repeat, as lists."""
    rows = d.explode_vertices(_regraded(spark, folder), _REPEATED, repeated=d.ALL)
    total = F.aggregate("size", F.lit(0), lambda a, x: a + x)
    sizes = F.size("size")
    return rows.select("id", F.array_join("segment", ",").alias("segments"), sizes.alias("n_sizes"), F.when(sizes > 0, total).alias("size_sum"))


@query(
    "eav_repeated_rows",
    """
    SELECT 'c' || c_custkey AS id, c_mktsegment AS segment, NULL AS size FROM customer
    UNION ALL SELECT 'c' || c_custkey, 'DEBTOR', NULL FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'p' || p_partkey, NULL, p_size FROM part
    UNION ALL SELECT 'p' || p_partkey, NULL, n FROM part, (SELECT unnest([0, 1]) AS n) WHERE p_size > 40
    """,
)
def eav_repeated_rows(spark, folder):
    """A row for each value of keys that documents may repeat."""
    return d.explode_vertices(_regraded(spark, folder), _REPEATED, repeated=d.ROWS).select("id", "segment", "size")


@query(
    "doc_bad_values",
    "SELECT c_mktsegment AS segment, count(*) AS n, CAST(0 AS BIGINT) AS n_numbers FROM customer GROUP BY 1",
)
def doc_bad_values(spark, folder):
    """A key declared with a type its values do not have reads as null; the rows stay."""
    docs = _vertices(spark, folder).where("label = 'customer'")
    rows = d.explode_vertices(docs, {"segment": T.StringType(), "name": T.LongType()})
    return agg.group(rows, ["segment"], n=agg.count_all(), n_numbers=agg.count(F.col("name")))


@query(
    "doc_repeated_keys",
    "SELECT 'c' || c_custkey AS id, 'name' AS key, 2 AS n FROM customer WHERE c_acctbal < 0",
)
def doc_repeated_keys(spark, folder):
    docs = _vertices(spark, folder)
    balance = d.property_value(F.col("properties"), "acctbal").cast("double")
    doubled = docs.withColumn(
        "properties",
        F.when(balance < 0, F.array_append("properties", F.col("properties")[0])).otherwise(F.col("properties")),
    )
    return d.repeated_keys(doubled)


@query(
    "doc_graph",
    """
    SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1
    """,
)
def doc_graph(spark, folder):
    """The graph of a datasource, with types found in its documents:
    MATCH (c:customer)-[r:placed]->() RETURN c.segment, count(*), sum(r.totalprice)"""
    graph = shop_documents(spark, folder).graph(DATASOURCE, {"placed": ("customer", None)})
    m = graph.match("c", "customer").expand("c", "r", types="placed")
    return m.df.groupBy(m["c.segment"].alias("segment")).agg(
        agg.count_all().alias("n"), exact_sum(m["r.totalprice"]).alias("total")
    )


# -- metadata -------------------------------------------------------------------------------------

_LABELS = """
    SELECT 'customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'part', count(*) FROM part
"""


@query(
    "meta_datasources",
    "SELECT 'shop' AS datasource, (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS n",
)
def meta_datasources(spark, folder):
    return meta.datasources(_vertices(spark, folder))


@query("meta_labels", f"SELECT 'shop' AS datasource, label, n FROM ({_LABELS})")
def meta_labels(spark, folder):
    return meta.labels(_vertices(spark, folder), DATASOURCE)


_KEYS = """
    SELECT 'customer' AS label, key, type, n FROM (SELECT unnest(['acctbal', 'name', 'nation', 'segment']) AS key,
        unnest(['java.lang.Double', 'java.lang.String', 'java.lang.Integer', 'java.lang.String']) AS type),
        (SELECT count(*) AS n FROM customer)
    UNION ALL SELECT 'part', key, type, n FROM (SELECT unnest(['brand', 'name', 'retailprice', 'size']) AS key,
        unnest(['java.lang.String', 'java.lang.String', 'java.lang.Double', 'java.lang.Integer']) AS type),
        (SELECT count(*) AS n FROM part)
"""


@query("meta_keys", f"SELECT 'shop' AS datasource, label, key, n FROM ({_KEYS})")
def meta_keys(spark, folder):
    return meta.keys(_vertices(spark, folder), DATASOURCE)


@query(
    "meta_keytypes",
    """
    SELECT 'shop' AS datasource, 'customer' AS label, 'level' AS key,
        CASE WHEN n_neg > n - n_neg THEN 'java.lang.Integer' ELSE 'java.lang.String' END AS type,
        greatest(n_neg, n - n_neg) AS n_type, n AS n_key, n_neg > 0 AND n_neg < n AS mixed_types, n < n_all AS nullable
    FROM (SELECT count(*) FILTER (c_mktsegment <> 'BUILDING') AS n,
        count(*) FILTER (c_mktsegment <> 'BUILDING' AND c_acctbal < 0) AS n_neg, count(*) AS n_all FROM customer)
    """,
)
def meta_keytypes(spark, folder):
    """A key that some documents lack and others hold with either of two types."""
    customer = table(spark, folder, "customer")
    level = F.when(
        F.col("c_acctbal") < 0, d.document_property("level", F.lit(0), T.IntegerType())
    ).otherwise(d.document_property("level", F.lit("rich"), T.StringType()))
    docs = customer.select(
        F.lit("shop").alias("datasource"),
        F.lit("customer").alias("label"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.array(level)).otherwise(F.array()).alias("properties"),
    )
    return meta.key_types(docs, DATASOURCE, "customer")


_META_SCAN_SQL = f"""
SELECT 'vertex' AS kind, 'shop' AS datasource, label, n AS n_docs, key, type, n AS n_type, n AS n_key,
    false AS mixed_types FROM ({_KEYS})
UNION ALL SELECT 'edge', 'shop', 'placed', n, key, type, n, n, false FROM (
    SELECT unnest(['priority', 'status', 'totalprice']) AS key,
        unnest(['java.lang.String', 'java.lang.String', 'java.lang.Double']) AS type),
    (SELECT count(*) AS n FROM orders)
"""


@query("meta_scan", _META_SCAN_SQL)
def meta_scan(spark, folder):
    return shop_documents(spark, folder).scan()


# -- exploded properties --------------------------------------------------------------------------


_ENTRIES = """
    SELECT id, label, p_key, p_type, p_value FROM (
        SELECT 'p' || p_partkey AS id, 'part' AS label, unnest(['name', 'brand', 'size', 'retailprice']) AS p_key,
            unnest(['java.lang.String', 'java.lang.String', 'java.lang.Integer', 'java.lang.Double']) AS p_type,
            unnest([p_name, p_brand, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR)]) AS p_value FROM part
        UNION ALL SELECT 'c' || c_custkey, 'customer', unnest(['name', 'acctbal', 'segment', 'nation']),
            unnest(['java.lang.String', 'java.lang.Double', 'java.lang.String', 'java.lang.Integer']),
            unnest([c_name, CAST(c_acctbal AS VARCHAR), c_mktsegment, CAST(c_nationkey AS VARCHAR)]) FROM customer)
"""


@query(
    "hive_explode",
    _ENTRIES,
)
def hive_explode(spark, folder):
    return d.explode_properties(_vertices(spark, folder))


@query(
    "hive_typed_values",
    "SELECT 'p' || p_partkey AS id, 'part' AS label, p_size AS size FROM part ORDER BY size DESC",
)
def hive_typed_values(spark, folder):
    rows = d.typed_values(_vertices(spark, folder).where("label = 'part'"), "size", "int", "size")
    return order_by(rows, F.col("size").desc())


@query(
    "property_regroup",
    """
    SELECT 'p' || p_partkey AS id, 'part' AS label,
        'brand:' || p_brand || ',name:' || p_name || ',retailprice:' || p_retailprice || ',size:' || p_size AS regrouped
    FROM part
    UNION ALL SELECT 'c' || c_custkey, 'customer',
        'acctbal:' || c_acctbal || ',name:' || c_name || ',nation:' || c_nationkey || ',segment:' || c_mktsegment
    FROM customer
    """,
)
def property_regroup(spark, folder):
    exploded = d.explode_properties(_vertices(spark, folder))
    regrouped = d.regroup_properties(d.property_structs(exploded))
    text = F.transform("arr_properties", lambda p: F.concat(p["key"], F.lit(":"), p["value"]))
    return regrouped.select("id", "label", F.array_join(text, ",").alias("regrouped"))


@query(
    "property_regroup_in_place",
    """
    SELECT 'c' || c_custkey AS id, 'customer' AS label, 'acctbal,name,nation,segment' AS keys FROM customer
    UNION ALL SELECT 'p' || p_partkey, 'part', 'brand,name,retailprice,size' FROM part
    """,
)
def property_regroup_in_place(spark, folder):
    docs = d.distinct_properties(_vertices(spark, folder))
    return docs.select("id", "label", F.array_join(structs.field_of_each(F.col("arr_properties"), "key"), ",").alias("keys"))


@query(
    "property_struct",
    f"SELECT id, p_value AS value, p_type AS type FROM ({_ENTRIES})",
)
def property_struct(spark, folder):
    exploded = d.explode_properties(_vertices(spark, folder))
    return d.property_structs(exploded).select("id", "new_property.value", "new_property.type")


@query(
    "struct_columns",
    """
    SELECT c_custkey AS id, 'shop/' || c_mktsegment AS url, c_name AS picture, c_mktsegment AS first_tag,
        2 AS n_tags FROM customer
    """,
)
def struct_columns(spark, folder):
    """Documents with a struct column and a list of texts."""
    docs = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.concat(F.lit("shop/"), F.col("c_mktsegment")).alias("url"), F.col("c_name").alias("picture")
        ).alias("links"),
        F.array("c_mktsegment", "c_name").alias("tags"),
    )
    return docs.select(
        "id", "links.url", "links.picture", F.col("tags")[0].alias("first_tag"), F.size("tags").alias("n_tags")
    )


@query(
    "table_counts",
    "SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders",
)
def table_counts(spark, folder):
    return d.table_counts(customer=table(spark, folder, "customer"), orders=table(spark, folder, "orders"))


@query(
    "property_lookup",
    """
    SELECT 'c' || c_custkey AS id, c_mktsegment AS segment, c_mktsegment AS by_sql, CAST(NULL AS VARCHAR) AS missing,
        true AS has_name, 'name,acctbal,segment,nation' AS keys FROM customer
    UNION ALL SELECT 'p' || p_partkey, NULL, NULL, NULL, true, 'name,brand,size,retailprice' FROM part
    """,
)
def property_lookup(spark, folder):
    structs.register_sql_functions(spark)
    properties = F.col("properties")
    docs = _vertices(spark, folder)
    return docs.select(
        "id",
        d.property_value(properties, "segment").alias("segment"),
        F.expr("property_get(properties, 'segment')").alias("by_sql"),
        d.property_value(properties, "unknown").alias("missing"),
        d.has_property(properties, "name").alias("has_name"),
        F.array_join(structs.field_of_each(properties, "key"), ",").alias("keys"),
    )


# -- changes --------------------------------------------------------------------------------------


def _timed(docs, day):
    return docs.withColumn("timestamp", F.to_timestamp(F.lit(day)))


@query(
    "upsert_docs",
    """
    SELECT 'c' || c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS segment FROM customer
    UNION ALL SELECT 'n' || s_suppkey, 'NEW' FROM supplier UNION ALL SELECT 'p' || p_partkey, NULL FROM part
    """,
)
def upsert_docs(spark, folder):
    """Customers in debt get a new segment, suppliers come in as new documents. Every change comes
    twice, and the later one stays."""
    old = _timed(_vertices(spark, folder), "2024-01-01")
    in_debt = old.where(d.property_value(F.col("properties"), "acctbal").cast("double") < 0)
    first = _timed(updates.set_property(in_debt, "segment", F.lit("LATE"), T.StringType()), "2024-02-01")
    second = _timed(updates.set_property(in_debt, "segment", F.lit("DEBTOR"), T.StringType()), "2024-03-01")
    added = d.pack_documents(
        table(spark, folder, "supplier").withColumn("segment", F.lit("NEW")),
        DATASOURCE, "customer", F.concat(F.lit("n"), F.col("s_suppkey").cast("string")), {"segment": "segment"},
    )
    changed = updates.upsert(old, second.unionAll(first).unionAll(_timed(added, "2024-03-01")))
    return changed.select("id", d.property_value(F.col("properties"), "segment").alias("segment"))


@query(
    "soft_delete_docs",
    "SELECT 'p' || p_partkey AS id, p_name AS name FROM part WHERE NOT p_size > 40 "
    "UNION ALL SELECT 'c' || c_custkey, c_name FROM customer",
)
def soft_delete_docs(spark, folder):
    docs = updates.add_column(_vertices(spark, folder), "deleted", F.lit(updates.LIVE))
    size = d.property_value(F.col("properties"), "size").try_cast("int")
    marked = updates.soft_delete(docs, size > 40)
    return updates.live(marked).select("id", d.property_value(F.col("properties"), "name").alias("name"))


@query(
    "copy_docs",
    "SELECT 'o' || o_orderkey AS id, 'N' AS deleted, 3 AS n FROM orders",
)
def copy_docs(spark, folder):
    docs = updates.add_column(_edges(spark, folder), "deleted", F.lit(updates.LIVE))
    return docs.select("id", "deleted", F.size("properties").alias("n"))


@query(
    "set_property_docs",
    """
    SELECT 'p' || p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN p_size + 1 ELSE p_size END AS size,
        'brand,retailprice,size' AS keys FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT 'p' || p_partkey, p_size, 'brand,retailprice,size' FROM part WHERE p_type <> 'PROMO'
    UNION ALL SELECT 'c' || c_custkey, NULL, 'acctbal,nation,segment' FROM customer
    """,
)
def set_property_docs(spark, folder):
    """Sizes of promoted parts grow by one, and names are removed."""
    promoted = table(spark, folder, "part").where("p_type = 'PROMO'").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("promo_id")
    )
    docs = _vertices(spark, folder).join(promoted, F.col("id") == F.col("promo_id"), "left")
    size = d.property_value(F.col("properties"), "size").cast("int")
    grown = updates.set_property(docs, "size", size + 1, T.IntegerType(), F.col("promo_id").isNotNull())
    changed = updates.remove_property(grown, "name")
    return changed.select(
        "id",
        d.property_value(F.col("properties"), "size").cast("int").alias("size"),
        F.array_join(F.array_sort(structs.field_of_each(F.col("properties"), "key")), ",").alias("keys"),
    )


@query(
    "document_edits",
    """
    SELECT 'c' || c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS segment FROM customer
    UNION ALL SELECT 'n' || s_suppkey, 'NEW' FROM supplier
    UNION ALL SELECT 'p' || p_partkey, NULL FROM part WHERE NOT p_size > 40
    """,
)
def document_edits(spark, folder):
    """Insert, upsert, soft delete, and a new version of the collection written and read back."""
    root = new_location(spark, "documents")
    store = shop_documents(spark, folder)
    store.save(root)
    store = DocumentStore.load(spark, root)
    old = store.vertices(DATASOURCE)
    in_debt = old.where(d.property_value(F.col("properties"), "acctbal").cast("double") < 0)
    debtors = _timed(updates.set_property(in_debt, "segment", F.lit("DEBTOR"), T.StringType()), "2024-03-01")
    large = updates.soft_delete(old, d.property_value(F.col("properties"), "size").try_cast("int") > 40)
    added = d.pack_documents(
        table(spark, folder, "supplier").withColumn("segment", F.lit("NEW")),
        DATASOURCE, "customer", F.concat(F.lit("n"), F.col("s_suppkey").cast("string")), {"segment": "segment"},
    )
    changes = debtors.unionByName(large.where("deleted = 'Y'")).unionByName(added, allowMissingColumns=True)
    store.upsert(vertices=changes)
    rows = DocumentStore.load(spark, root).vertices(DATASOURCE)
    return rows.select("id", d.property_value(F.col("properties"), "segment").alias("segment"))


@query(
    "doc_scan_saved_label",
    """
    SELECT 'p' || p_partkey AS id, p_brand AS brand, CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS size FROM part
    """,
)
def doc_scan_saved_label(spark, folder):
    """A label of a saved collection after changes to some of its documents: other labels are in other folders."""
    root = new_location(spark, "documents")
    shop_documents(spark, folder).save(root)
    saved = DocumentStore.load(spark, root)
    size = d.property_value(F.col("properties"), "size").try_cast("int")
    large = updates.set_property(saved.vertices(DATASOURCE, "part").where(size > 40), "size", F.lit(0), T.IntegerType())
    saved = saved.upsert(vertices=_timed(large, "2024-03-01"))
    return saved.read_vertices(DATASOURCE, "part").select("id", "brand", "size")


@query("meta_scan_saved", _META_SCAN_SQL)
def meta_scan_saved(spark, folder):
    """The metadata tree of a saved collection, added up from the counts of its buckets, after a property was dropped from some
    documents and put back."""
    root = new_location(spark, "documents")
    store = shop_documents(spark, folder)
    store.save(root)
    saved = DocumentStore.load(spark, root)
    debtor = d.property_value(F.col("properties"), "acctbal").try_cast("double") < 0
    without = updates.remove_property(saved.vertices(DATASOURCE, "customer").where(debtor), "acctbal")
    saved = saved.upsert(vertices=_timed(without, "2024-03-01"))
    saved = saved.upsert(vertices=_timed(store.vertices(DATASOURCE, "customer").where(debtor), "2024-04-01"))
    return saved.scan()


@query(
    "label_table_schema",
    """
    SELECT unnest(['timestamp', 'datasource', 'id', 'label', 'acctbal', 'name', 'nation', 'segment']) AS name,
        unnest(['timestamp', 'string', 'string', 'string', 'double', 'string', 'int', 'string']) AS type
    """,
)
def label_table_schema(spark, folder):
    """The table schema of a label, from the types found in its documents."""
    schema = shop_documents(spark, folder).label_schema(DATASOURCE, "customer")
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "name string, type string")
