from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from graphloom import NodeTable, PropertyGraph, RelTable


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def friends(spark):
    """Four persons and four friendships."""
    persons = spark.createDataFrame(
        [(0, "Alice", 10), (1, "Bob", 20), (2, "Carol", 15), (3, "Carol's Mom", 55)], "id long, name string, age int"
    )
    friend_of = spark.createDataFrame(
        [(0, 0, 1, "23/01/1987"), (1, 1, 2, "12/12/2009"), (2, 3, 2, "02/04/1982"), (3, 3, 0, "22/08/1976")],
        "id long, source long, target long, since string",
    )
    return PropertyGraph.from_tables(
        NodeTable("Person", persons), RelTable("FRIEND_OF", friend_of, ["Person"], ["Person"])
    )


MODERN_VERTICES = [
    ("modern_1", "person", {"name": ("String", "marko"), "age": ("Integer", "29"), "country": ("String", "USA")}),
    ("modern_2", "person", {"name": ("String", "vadas"), "age": ("Integer", "27"), "country": ("String", "USA")}),
    ("modern_3", "software", {"name": ("String", "lop"), "lang": ("String", "java")}),
    ("modern_4", "person", {"name": ("String", "josh"), "age": ("Integer", "32"), "country": ("String", "USA")}),
    ("modern_5", "software", {"name": ("String", "ripple"), "lang": ("String", "java")}),
    ("modern_6", "person", {"name": ("String", "peter"), "age": ("Integer", "35"), "country": ("String", "UK")}),
]
MODERN_EDGES = [
    ("modern_7", "knows", "modern_1", "modern_2", {"weight": ("Double", "0.5")}),
    ("modern_8", "knows", "modern_1", "modern_4", {"weight": ("Double", "1.0")}),
    ("modern_9", "created", "modern_1", "modern_3", {"weight": ("Double", "0.4")}),
    ("modern_10", "created", "modern_4", "modern_5", {"weight": ("Double", "1.0")}),
    ("modern_11", "created", "modern_4", "modern_3", {"weight": ("Double", "0.4")}),
    ("modern_12", "created", "modern_6", "modern_3", {"weight": ("Double", "0.2")}),
]


def _entries(properties):
    return [(k, f"java.lang.{t}", v) for k, (t, v) in properties.items()]


@pytest.fixture(scope="session")
def modern(spark):
    """A document store with the small graph `modern`, and one stray document of another datasource."""
    from graphloom.operators.documents import EDGE_DOCUMENT, VERTEX_DOCUMENT
    from graphloom.sources.documents import DocumentStore

    vertices = [(None, "modern", i, label, _entries(p)) for i, label, p in MODERN_VERTICES]
    vertices.append((None, "other", "other_1", "person", _entries({"name": ("String", "nobody")})))
    edges = [(None, "modern", i, label, s, t, _entries(p)) for i, label, s, t, p in MODERN_EDGES]
    return DocumentStore(
        spark.createDataFrame(vertices, VERTEX_DOCUMENT), spark.createDataFrame(edges, EDGE_DOCUMENT)
    )


PRODUCTS_SCHEMA = """{
  "version": "1.0",
  "labelPropertyMap": [
    {"labels": ["Product"], "properties": {"title": "STRING", "rank": "INTEGER", "category": "STRING"}},
    {"labels": ["Customer"], "properties": {"name": "STRING"}}
  ],
  "relTypePropertyMap": [
    {"relType": "BOUGHT", "properties": {"rating": "INTEGER", "helpful": "INTEGER", "votes": "INTEGER"}}
  ]
}"""
PRODUCTS_TABLES = {
    "nodes/Customer": [(2006, "josh"), (2007, "marko"), (2008, "peter"), (2011, "vadas"), (2012, "Peggy")],
    "nodes/Product": [
        (1001, "Book", 246, "1984"),
        (1002, "Book", 842, "Cryptonomicon"),
        (1005, "DVD", 102, "Terminator 2"),
        (1006, "DVD", 820, "Die Hard 3"),
        (1009, "Video", 832, "Jurassic Park"),
        (1013, "Music", 886, "Shakira"),
    ],
    "relationships/BOUGHT": [
        (10001, 2011, 1001, 7, 4, 10),
        (10002, 2011, 1005, 8, 5, 10),
        (10003, 2006, 1009, 7, 4, 10),
        (10004, 2008, 1013, 8, 5, 10),
        (10005, 2007, 1002, 7, 4, 10),
        (10006, 2007, 1006, 8, 5, 10),
    ],
}


@pytest.fixture(scope="session")
def products_root(tmp_path_factory):
    """A folder with the graph `products` as text files without header, and its schema."""
    root = tmp_path_factory.mktemp("graphs")
    for name, rows in PRODUCTS_TABLES.items():
        path = root / "products" / name
        path.mkdir(parents=True)
        (path / "table.csv").write_text("\n".join(",".join(str(v) for v in row) for row in rows) + "\n")
    (root / "products" / "propertyGraphSchema.json").write_text(PRODUCTS_SCHEMA)
    return str(root)


def row_key(row):
    return [str(v) for v in row]


def values(df, *columns):
    """Rows as a list of tuples in the order of their texts."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=row_key)
