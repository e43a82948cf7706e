from __future__ import annotations

from collections import namedtuple
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom import GraphCatalog, GraphSchema, NodeTable, PropertyGraph, RelTable
from graphloom.errors import GraphError, GraphExistsError, GraphNotFoundError, GraphSchemaError
from graphloom.model.types import parse_type_name
from graphloom.operators.multigraph import Create, CreateNode, construct, union_graphs
from graphloom.session import CHECKPOINT_SETTING, dropped, passing_tables, shared_folder, written
from graphloom.sinks import tables as sinks
from graphloom.sources import frames
from graphloom.sources.catalog import CachedSource
from graphloom.sources.edge_list import edge_list_graph
from graphloom.sources.graph_files import GraphFiles, canonical_nodes, folder_name, property_columns
from graphloom.sources.views import CatalogViews, EdgeView, End, FileViews, FrameViews, JdbcViews, NodeView, ViewGraph, ViewGraphSource
from tests.conftest import row_key, values

KNOWS = [(0, 0, 1, "23/01/1987"), (1, 1, 2, "12/12/2009")]


@dataclass
class Person:
    id: int
    name: str
    age: int


@dataclass
class Friend:
    __rel_type__ = "FRIEND_OF"
    id: int
    source: int
    target: int
    since: str


Town = namedtuple("Town", "id name")


def test_graph_from_typed_rows(spark):
    graph = frames.graph_from_rows(spark, [Person(0, "Alice", 10), Person(1, "Bob", 20)], [Friend(0, 0, 1, "1987")])
    assert graph.schema.labels == {"Person"} and graph.schema.relationship_types == {"FRIEND_OF"}
    assert values(graph.match("a", "Person").expand("a", "r", "b").select("a.name", "b.name")) == [("Alice", "Bob")]
    assert frames.nodes_from_rows(spark, [Town(1, "x")]).labels == {"Town"}
    for wrong in ([], [Person(0, "A", 1), Town(1, "x")], [object()]):
        with pytest.raises(GraphSchemaError):
            frames.nodes_from_rows(spark, wrong)


def test_graph_from_frames_by_convention(spark):
    nodes = spark.createDataFrame([(0, "Alice", 42), (1, "Bob", 23), (2, "Eve", 84)], "id long, name string, age long")
    rels = spark.createDataFrame(KNOWS, "id long, source long, target long, since string")
    graph = frames.graph_from_frames({"Person": nodes}, {"KNOWS": rels})
    assert graph.match("a").expand("a", "r", "b", types="KNOWS").df.count() == 2
    with pytest.raises(GraphSchemaError):
        NodeTable("Person", nodes.drop("id"))
    with pytest.raises(GraphSchemaError):
        RelTable("KNOWS", rels.drop("target"))


def test_graph_from_frames_by_mapping(spark):
    people = spark.createDataFrame([("Alice", 42, "Alice"), ("Bob", 23, "Bob"), ("Eve", 84, "Eve")], "FIRST_NAME string, AGE long, ID string")
    since = spark.sql("SELECT 0L AS REL_ID, 'Alice' AS SOURCE_ID, 'Bob' AS TARGET_ID, date'1987-01-23' AS CONNECTED_SINCE")
    graph = PropertyGraph.from_tables(
        NodeTable.mapped("Person", people, "ID", {"name": "FIRST_NAME", "age": "AGE"}),
        RelTable.mapped("FRIEND_OF", since, "REL_ID", "SOURCE_ID", "TARGET_ID", {"since": "CONNECTED_SINCE"}),
    )
    assert values(graph.match("n", "Person").select("n.name")) == [("Alice",), ("Bob",), ("Eve",)]
    assert graph.schema.relationship_property_keys("FRIEND_OF") == {"since": T.DateType()}


def test_same_labels_are_unioned(spark):
    graph = PropertyGraph.from_tables(
        NodeTable("A", spark.sql("SELECT 1L AS id, 1 AS x")), NodeTable("A", spark.sql("SELECT 2L AS id, 2.5D AS x, 'y' AS y"))
    )
    assert values(graph.match("a", "A").select("a.x", "a.y")) == [(1.0, None), (2.5, "y")]


def test_schema_checks(spark):
    with pytest.raises(GraphSchemaError):
        PropertyGraph.from_tables(
            NodeTable(["A", "B"], spark.sql("SELECT 1L AS id, 1 AS x")), NodeTable("A", spark.sql("SELECT 2L AS id, 'y' AS x"))
        )
    declared = GraphSchema().with_node(["A"], {"x": T.StringType()})
    with pytest.raises(GraphSchemaError):
        PropertyGraph.from_tables(NodeTable("A", spark.sql("SELECT 1L AS id, 1 AS x")), schema=declared)
    with pytest.raises(GraphSchemaError):
        PropertyGraph.from_tables(NodeTable("A", spark.sql("SELECT 1L AS id, 1 AS y")), schema=declared)


def test_schema_questions():
    schema = (
        GraphSchema()
        .with_node(["A"], {"x": T.LongType()})
        .with_node(["A", "B"], {"x": T.DoubleType(), "y": T.StringType()})
        .with_relationship("R", {"w": T.LongType()})
        .with_pattern(["A"], "R", ["B"])
        .with_node_key("A", ["x"])
        .with_relationship_key("R", ["w"])
    )
    assert schema.labels == {"A", "B"}
    assert schema.combinations_for(["A"]) == {frozenset("A"), frozenset("AB")}
    assert schema.implied_labels(["B"]) == {"A", "B"}
    assert schema.node_property_keys_for(["A"]) == {"x": T.DoubleType(), "y": T.StringType()}
    assert schema.node_property_type(["A"], "y") == T.StringType()
    assert schema.relationship_property_type(["R"], "w") == T.LongType()
    assert len(schema.patterns_for(source=["A"])) == 1 and not schema.patterns_for(source=["B"])
    assert schema.for_nodes(["B"]).label_combinations == {frozenset("AB")}
    assert schema.for_relationships(["R"]).relationship_types == {"R"}
    assert schema.without_properties(["A"]).node_property_keys(["A"]) == {}
    assert GraphSchema.from_json(schema.to_json()) == schema
    assert (schema + schema) == schema and GraphSchema().is_empty
    assert "(:A)-[:R]->(:B)" in schema.pretty()
    assert parse_type_name("LIST<INTEGER>") == T.ArrayType(T.LongType())
    assert parse_type_name("STRING?") == T.StringType()


def test_catalog(spark, friends, products_root):
    catalog = GraphCatalog(spark)
    catalog.store("friends", friends)
    catalog.register("purchases", GraphFiles(spark, products_root, "csv"))
    assert catalog.graph_names() == ["purchases.products", "session.emptyGraph", "session.friends"]
    assert catalog.graph("friends") is catalog.graph("session.friends")
    assert catalog.graph("purchases.products").match("c", "Customer").df.count() == 5
    assert catalog.graph("emptyGraph").match("n").df.count() == 0
    with pytest.raises(GraphExistsError):
        catalog.store("friends", friends)
    with pytest.raises(GraphNotFoundError):
        catalog.graph("nothing")
    with pytest.raises(GraphNotFoundError):
        catalog.source("nowhere")
    with pytest.raises(GraphError):
        catalog.register("purchases", CachedSource(catalog.source("purchases")))
    catalog.drop("friends")
    assert "session.friends" not in catalog.graph_names()
    catalog.deregister("purchases")
    assert catalog.namespaces == ["session"]


def test_cached_source(spark, products_root):
    source = CachedSource(GraphFiles(spark, products_root, "csv"))
    graph = source.graph("products")
    assert all(n.df.storageLevel.useMemory for n in graph.nodes)
    assert source.graph("products") is graph and source.graph_names() == ["products"]
    source._release("products")
    assert not any(n.df.storageLevel.useMemory for n in graph.nodes)


def test_stored_text_graph_without_listing(spark, products_root):
    graph = GraphFiles(spark, products_root, "csv").graph("products")
    m = graph.match("c", "Customer").expand("c", "b", "p", types="BOUGHT", labels="Product")
    assert ("vadas", "1984", 4) in values(m.select("c.name", "p.title", "b.rating"))
    assert graph.schema.node_property_keys(["Product"])["rank"] == T.LongType()
    with pytest.raises(GraphNotFoundError):
        GraphFiles(spark, products_root, "csv").graph("nothing")


@pytest.mark.parametrize("format", ["parquet", "orc", "csv", "json"])
def test_store_and_reload(spark, tmp_path, format):
    nodes = spark.sql(
        "SELECT cast('k1' as binary) AS id, 'x' AS Name, array(1L) AS list, 2.5D AS `odd@name`, date'2020-01-02' AS day, "
        "named_struct('a', 1L) AS s"
    )
    if format == "json":
        nodes = nodes.withColumn("id", F.lit("k1"))
    rels = nodes.select(F.col("id"), F.col("id").alias("source"), F.col("id").alias("target"), F.lit(True).alias("Sure"))
    graph = PropertyGraph.from_tables(NodeTable(["B", "A"], nodes), RelTable("LIKES", rels, ["A", "B"], ["A"]))
    files = GraphFiles(spark, str(tmp_path), format, files_per_table=1)
    files.store("g", graph)
    again = files.graph("g")
    assert files.graph_names() == ["g"] and files.has_graph("g")
    assert again.schema.to_json() == graph.schema.to_json()
    picked = ["Name", "list", "odd@name", "day", "s", "id"]
    before = graph.match("n").df.select(*[f"`n__{c}`" for c in picked]).collect()
    assert again.match("n").df.select(*[f"`n__{c}`" for c in picked]).collect() == before
    assert again.match("n").expand("n", "r", "m").select("r.Sure", "m.Name").first()[:] == (True, "x")
    with pytest.raises(GraphExistsError):
        files.store("g", graph)
    files.store("g", again, overwrite=True)
    assert files.graph("g").match("n").df.select(*[f"`n__{c}`" for c in picked]).collect() == before
    files.delete("g")
    assert files.graph_names() == []


def test_a_failing_table_fails_the_store(spark, tmp_path, friends):
    bad = friends.map_tables(lambda df: df.withColumn("name", F.raise_error(F.lit("broken")).cast("string")) if "name" in df.columns else df)
    files = GraphFiles(spark, str(tmp_path))
    with pytest.raises(Exception, match="broken"):
        files.store("g", bad)
    assert files.graph_names() == []


def test_one_type_between_several_labels_is_stored_apart(spark, tmp_path):
    ids = spark.sql("SELECT 1L AS id")
    rel = spark.sql("SELECT 1L AS id, 1L AS source, 1L AS target")
    graph = PropertyGraph.from_tables(
        NodeTable("A", ids), NodeTable("B", ids), RelTable("R", rel, ["A"], ["B"]), RelTable("R", rel, ["B"], ["A"])
    )
    files = GraphFiles(spark, str(tmp_path))
    files.store("g", graph)
    assert files.graph("g").match("a", "A").expand("a", "r", "b", types="R").df.count() == 1
    assert files.graph("g").schema.patterns == graph.schema.patterns


def test_canonical_tables(spark):
    table = NodeTable("A", spark.sql("SELECT 'z' AS zeta, 1L AS id, 'b' AS Beta"))
    assert canonical_nodes(table).columns == ["id", "beta", "zeta"]
    with pytest.raises(GraphSchemaError):
        property_columns(["name", "Name"])
    assert folder_name([]) == "__NO_LABEL__" and folder_name(["B", "A"]) == "A_B"
    assert folder_name(["a/b"]) != folder_name(["a_b"])


def test_catalog_tables(spark, friends, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS people LOCATION '{tmp_path}/people'")
    names = sinks.save_graph_tables(friends, "friends", "people")
    assert names == ["people.friends_vertex_person", "people.friends_edge_friend_of"]
    sinks.save_graph_tables(friends, "friends", "people")
    joined = spark.sql(
        "SELECT v.name, e.since FROM people.friends_vertex_person v JOIN people.friends_edge_friend_of e ON v.id = e.source "
        "WHERE v.age > 30"
    )
    assert values(joined) == [("Carol's Mom", "02/04/1982"), ("Carol's Mom", "22/08/1976")]
    sinks.drop_graph_tables(spark, names)
    assert spark.sql("SHOW TABLES IN people").where("NOT isTemporary").count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, friends, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}/bucketed'")
    person, friend_of = sinks.save_graph_tables(friends, "f", "bucketed", buckets=4)
    graph = PropertyGraph.from_tables(
        NodeTable("Person", spark.table(person)), RelTable("FRIEND_OF", spark.table(friend_of), ["Person"], ["Person"])
    )
    m = graph.match("a").expand("a", "r")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = m.select("a.name", "r.since")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert m.df.count() == 4
    sinks.drop_graph_tables(spark, [person, friend_of])


def test_external_tables_over_stored_files(spark, friends, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored")
    files = GraphFiles(spark, str(tmp_path), "parquet", database="stored")
    files.store("friends", friends)
    assert spark.table("stored.friends_vertex_person").count() == 4
    assert spark.table("stored.friends_edge_friend_of").where("source = 3").count() == 2
    files.delete("friends")
    assert spark.sql("SHOW TABLES IN stored").where("NOT isTemporary").count() == 0


def test_results(spark, friends, tmp_path):
    df = friends.match("a").select(name="a.name", age="a.age")
    path = sinks.save_result(df, str(tmp_path), "people")
    assert path.endswith("people.parquet") and spark.read.parquet(path).count() == 4
    schema = sinks.materialize(df, "people_table", str(tmp_path))
    assert T.StructType.fromJson(__import__("json").loads(schema)).fieldNames() == ["name", "age"]
    sinks.materialize(df.where("age > 18"), "people_table", str(tmp_path))
    assert spark.table("people_table").count() == 2
    Named = namedtuple("Named", "name age")
    assert sorted(sinks.as_rows(df, Named)) [0] == Named("Alice", 10)
    entity = friends.match("a").select("a").first()["a"]
    assert set(sinks.non_null_properties(entity)["properties"]) == {"name", "age"}
    entities = friends.match("a").expand("a", "r", "b").select("a", "b")
    assert spark.read.parquet(sinks.save_result(entities, str(tmp_path), "pairs")).select("a.properties.name").count() == 4


def test_edge_lists(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("0 1\n1 2\n2 2\n")
    graph = edge_list_graph(spark, str(tmp_path / "edges.txt"))
    assert values(graph.match("v", "V").df.select("v__id")) == [(0,), (1,), (2,)]
    assert graph.match_relationships("e", "E").df.count() == 3
    (tmp_path / "tabbed.txt").write_text("# c\n5\t6\n")
    tabbed = edge_list_graph(spark, str(tmp_path / "tabbed.txt"), sep="\t", comment="#")
    assert tabbed.match("v").expand("v", "e", "w").df.select("v__id", "w__id").collect()[0][:] == (5, 6)


RESIDENTS = "CITY_NAME,FIRST_NAME,LAST_NAME,PERSON_NUMBER,REGION\nTreeside,Deena,Whalen,KUD4236102,West\nNewtown,Jo,Medders,MDA4966171,North\nBywater,Marlys,Fisher,HCP4828770,North\n"
TOWNS = "CITY_NAME,REGION\nNewtown,North\nTreeside,West\nBywater,North\nGreendale,North\n"
DOGS = "CITY_NAME,LICENCE_DATE,LICENCE_NUMBER,NAME,PERSON_NUMBER,REGION\nNewtown,1993-9-16,240350820,Kirsty,MDA4966171,North\nTreeside,1991-2-4,197101639,Jack,KUD4236102,West\n"


@pytest.fixture
def census(spark, tmp_path):
    for name, text in (("residents", RESIDENTS), ("town", TOWNS), ("licensed_dogs", DOGS)):
        (tmp_path / f"{name}.csv").write_text(text)
    town = End(("Town",), "csv.town.csv", (("REGION", "REGION"), ("CITY_NAME", "CITY_NAME")))
    resident = End(("Resident", "Person"), "csv.residents.csv", (("PERSON_NUMBER", "person_number"),))
    dog = End(("LicensedDog",), "csv.licensed_dogs.csv", (("LICENCE_NUMBER", "LICENCE_NUMBER"),))
    return ViewGraph(
        nodes=(
            NodeView(("Resident", "Person"), "csv.residents.csv", {"first_name": "FIRST_NAME", "last_name": "last_name"}),
            NodeView(("Town",), "csv.town.csv"),
            NodeView(("LicensedDog",), "csv.licensed_dogs.csv", {"licence_number": "LICENCE_NUMBER"}),
        ),
        edges=(
            EdgeView("PRESENT_IN", "csv.residents.csv", resident, town),
            EdgeView("PRESENT_IN", "csv.licensed_dogs.csv", dog, town),
            EdgeView("LICENSED_BY", "csv.licensed_dogs.csv", dog, resident, {"date_of_licence": "licence_date"}),
        ),
        schema=GraphSchema().with_node(["LicensedDog"], {"licence_number": T.LongType()}).with_relationship(
            "LICENSED_BY", {"date_of_licence": T.StringType()}
        ),
    )


@pytest.mark.parametrize("hashed", [False, True])
def test_graph_over_views(spark, tmp_path, census, hashed):
    source = ViewGraphSource(spark, {"csv": FileViews("csv", str(tmp_path))}, {"census": census}, hashed_ids=hashed)
    graph = source.graph("census")
    m = graph.match("d", "LicensedDog").expand("d", "l", "p", types="LICENSED_BY", labels="Person")
    m = m.expand("p", "i", "t", types="PRESENT_IN", labels="Town").expand("d", "j", "t", types="PRESENT_IN")
    assert values(m.select("d.licence_number", "p.first_name", "t.CITY_NAME")) == [
        (197101639, "Deena", "Treeside"), (240350820, "Jo", "Newtown"),
    ]
    assert graph.match("p", "Person").exists("p", labels="Town").df.count() == 3
    assert source.graph_names() == ["census"]
    with pytest.raises(GraphNotFoundError):
        source.graph("nothing")


def test_view_readers(spark, friends, census):
    jdbc = JdbcViews("jdbc:x://host/db", "org.x.Driver", {"user": "me"})
    assert jdbc.reader_options("S.V") == {
        "url": "jdbc:x://host/db", "driver": "org.x.Driver", "fetchSize": "100", "user": "me", "dbtable": "S.V",
    }
    assert JdbcViews("u", "d", {"fetchSize": "7"}).reader_options("v")["fetchSize"] == "7"
    assert FileViews("csv", "/data/").location("x.csv") == "/data/x.csv"
    assert FileViews("csv").location("hdfs://n/x.csv") == "hdfs://n/x.csv"
    with pytest.raises(GraphError):
        FileViews("csv").location("x.csv")
    friends.nodes[0].df.createOrReplaceTempView("people_view")
    spec = ViewGraph((NodeView(("P",), "hive.people_view", {"name": "NAME"}, key=("id",)),))
    assert ViewGraphSource(spark, {"hive": CatalogViews()}, {"g": spec}).graph("g").match("p").df.count() == 4
    with pytest.raises(GraphError):
        ViewGraphSource(spark, {}, {"g": spec}).graph("g")
    with pytest.raises(GraphNotFoundError):
        FrameViews({}).read(spark, "x")
    frame = FrameViews({"v": friends.nodes[0].df})
    with pytest.raises(GraphSchemaError):
        wrong = ViewGraph((NodeView(("P",), "f.v", {"x": "no_such_column"}),))
        ViewGraphSource(spark, {"f": frame}, {"g": wrong}).graph("g")


def test_one_graph_type_for_two_graphs(spark):
    """The same views under other names give another graph of the same type."""

    def interactions(suffix):
        customer = NodeView(("Customer",), f"db.customers_{suffix}", {"customerName": "customerName"})
        interaction = NodeView(("Interaction",), f"db.interactions_{suffix}", {"outcome": "outcomeScore"})
        has = EdgeView(
            "HAS_CUSTOMER", f"db.has_customers_{suffix}",
            End(("Interaction",), f"db.interactions_{suffix}", (("interactionId", "interactionId"),)),
            End(("Customer",), f"db.customers_{suffix}", (("customerIdx", "customerIdx"),)),
        )
        return ViewGraph((customer, interaction), (has,))

    data = {}
    for suffix, n in (("seed", 3), ("delta", 2)):
        data[f"customers_{suffix}"] = spark.range(n).selectExpr("id as CUSTOMERIDX", "concat('c', id) as customerName")
        data[f"interactions_{suffix}"] = spark.range(2 * n).selectExpr("id as interactionId", "'ok' as outcomeScore")
        data[f"has_customers_{suffix}"] = spark.range(2 * n).selectExpr("id as interactionId", f"id % {n} as customerIdx")
    source = ViewGraphSource(spark, {"db": FrameViews(data)}, {s: interactions(s) for s in ("seed", "delta")})
    counts = {}
    for name in source.graph_names():
        m = source.graph(name).match("i", "Interaction").expand("i", "h", "c", types="HAS_CUSTOMER", labels="Customer")
        counts[name] = m.df.count()
    assert counts == {"seed": 6, "delta": 4}


def test_null_keys_make_no_edges(spark):
    frames_ = {
        "owners": spark.sql("SELECT * FROM VALUES (1, 'x'), (2, 'y') AS t(owner, name)"),
        "dogs": spark.sql("SELECT * FROM VALUES (7, 1), (8, null), (9, 3) AS t(dog, owner)"),
        "walks": spark.sql("SELECT * FROM VALUES (7, 1), (8, null), (9, 2) AS t(dog, walker)"),
    }
    dog = End(("Dog",), "db.dogs", (("dog", "dog"),))
    spec = ViewGraph(
        (NodeView(("Owner",), "db.owners", {"name": "name"}), NodeView(("Dog",), "db.dogs", {"dog": "dog"})),
        (
            EdgeView("OWNED_BY", "db.dogs", dog, End(("Owner",), "db.owners", (("owner", "owner"),))),
            EdgeView("WALKED_BY", "db.walks", dog, End(("Owner",), "db.owners", (("owner", "walker"),))),
        ),
    )
    graph = ViewGraphSource(spark, {"db": FrameViews(frames_)}, {"g": spec}).graph("g")
    assert graph.node_tables("Dog")[0].held[0].rel_type == "OWNED_BY"
    assert values(graph.match("d", "Dog").expand("d", "o", "p", types="OWNED_BY").select("d.dog", "p.name")) == [(7, "x")]
    assert values(graph.match("p").expand("p", "o", "d", types="WALKED_BY", direction="in").select("d.dog", "p.name")) == [
        (7, "x"), (9, "y"),
    ]
    assert graph.match_relationships("r", "WALKED_BY").df.count() == 2


def test_records_have_graph_types(spark):
    assert frames.records(spark, "SELECT 1 AS a").schema["a"].dataType == T.LongType()


def test_union_keeps_members_apart(friends):
    both = union_graphs(friends, friends)
    assert both.match("n").df.count() == 8 and both.match("n").df.select("n__id").distinct().count() == 8
    assert both.match("a").expand("a", "r", "b").df.count() == 8
    nested = union_graphs(both, friends)
    assert nested.match("a").expand("a", "r", "b").df.count() == 12
    assert nested.match("n").df.select("n__id").distinct().count() == 12


def test_recommendations_on_a_constructed_graph(spark, modern, products_root):
    catalog = GraphCatalog(spark)
    catalog.register("docs", modern)
    catalog.register("purchases", GraphFiles(spark, products_root, "csv"))
    social, shop = catalog.graph("docs.modern"), catalog.graph("purchases.products")
    same = social.match("p", "person").join(shop.match("c", "Customer"), on=[("p.name", "c.name")])
    graph = construct([social, shop], same, [Create("IS", ("p", 0), ("c", 1))])
    assert values(graph.match("p", "person").expand("p", "i", "c", types="IS").select("p.name", "c.name")) == [
        ("josh", "josh"), ("marko", "marko"), ("peter", "peter"), ("vadas", "vadas"),
    ]
    m = graph.match("person", "person").expand("person", "k", "friend", types="knows", labels="person", direction="both")
    m = m.expand("friend", "i", "customer", types="IS", labels="Customer")
    m = m.expand("customer", "b", "product", types="BOUGHT", labels="Product")
    found = m.df.select(m["product.title"].alias("recommendation"), m["person.name"].alias("for")).distinct()
    assert values(found) == sorted(
        [
            ("1984", "marko"), ("Terminator 2", "marko"), ("Jurassic Park", "marko"),
            ("Cryptonomicon", "josh"), ("Die Hard 3", "josh"), ("Cryptonomicon", "vadas"), ("Die Hard 3", "vadas"),
        ],
        key=row_key,
    )
    files = GraphFiles(spark, shared_folder(spark) + f"/{id(m)}-recommendation", "parquet")
    files.store("recommendation", graph)
    assert files.graph("recommendation").match_relationships("r", "IS").df.count() == 4


def test_created_nodes(friends):
    m = friends.match("a", where=lambda m: m["a.age"] > 18)
    graph = construct(
        [friends], m, [CreateNode("t", ["Ticket"], {"owner": m["a.name"]}), Create("OWNS", ("a", 0), "t", {"n": F.lit(1)})]
    )
    owned = graph.match("a", "Person").expand("a", "o", "t", types="OWNS", labels="Ticket")
    assert values(owned.select("a.name", "t.owner", "o.n")) == [("Bob", "Bob", 1), ("Carol's Mom", "Carol's Mom", 1)]
    assert graph.match("a", "Person").expand("a", "r", "b", types="FRIEND_OF").df.count() == 4


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark).startswith(spark.conf.get(CHECKPOINT_SETTING).rstrip("/") + "/graphloom-")
    assert shared_folder(spark) == shared_folder(spark)


def test_walking_in_needs_no_shuffle_with_a_reverse_copy(spark, friends):
    spark.sql("CREATE DATABASE IF NOT EXISTS reversed")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = sinks.save_graph_tables(friends, "g", "reversed", buckets=4, reverse=True)
        assert names == ["reversed.g_vertex_person", "reversed.g_edge_friend_of", "reversed.g_edge_friend_of_in"]
        for direction in ("out", "in"):
            for walk in ("out", "in"):
                graph = sinks.read_graph_tables(friends, "g", "reversed", direction)
                walked = graph.match("a", "Person").expand("a", "r", types="FRIEND_OF", direction=walk)
                plain = friends.match("a", "Person").expand("a", "r", types="FRIEND_OF", direction=walk)
                assert values(walked.select("a.name", "r.since")) == values(plain.select("a.name", "r.since"))
                shuffles = walked.df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                assert (shuffles == 0) == (walk == direction)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        sinks.drop_graph_tables(spark, names)
    with pytest.raises(GraphSchemaError):
        sinks.save_graph_tables(friends, "g", "reversed", reverse=True)


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_a_stored_graph_is_there_at_any_time(spark, friends, tmp_path, monkeypatch, format):
    files = GraphFiles(spark, str(tmp_path), format)
    files.store("f", friends)
    adults = PropertyGraph.from_tables(NodeTable("Person", friends.node_tables("Person")[0].df.where("age > 18")))
    for step in ("write_text", "rename", "publish"):
        with monkeypatch.context() as lost:
            lost.setattr(type(files._files), step, lambda *_: (_ for _ in ()).throw(GraphError("lost")))
            with pytest.raises(GraphError):
                files.store("f", adults, overwrite=True)
        assert files.graph("f").match("a").df.count() == 4 and files.graph_names() == ["f"]
    old = files.graph("f")
    files.store("f", adults, overwrite=True)
    assert files.graph("f").match("a").df.count() == 2 and old.match("a").df.count() == 4
    files.store("f", files.graph("f"), overwrite=True)  # over the one it is read from
    files.clear("f")
    assert files.graph("f").match("a").df.count() == 2 and files.graph_names() == ["f"]
    assert len(list((tmp_path / "f").glob("version-*"))) == 1 and not (tmp_path / "f" / "nodes").exists()
    files.clear("f")
    files.delete("f")
    assert files.graph_names() == [] and not files.has_graph("f")


def test_dropped_tables_leave_no_files(spark):
    import os

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    kept, gone = written(spark.range(5), "kept"), written(spark.range(6), "gone")
    dropped(gone)
    assert len(set(os.listdir(folder)) - before) == 1 and kept.count() == 5
    with pytest.raises(KeyError):
        dropped(spark.range(1))
    with passing_tables() as tables:
        a, b = written(spark.range(3), "a"), written(spark.range(4), "b")
        tables.remove(b)
    assert len(set(os.listdir(folder)) - before) == 2 and b.count() == 4 and a is not b


def test_graph_counts(friends):
    assert values(friends.counts()) == [("node", "Person", 4), ("relationship", "FRIEND_OF", 4)]
