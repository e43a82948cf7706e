from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphError, GraphNotFoundError
from graphloom.functions import structs
from graphloom.model.types import java_class_type
from graphloom.operators import documents as d
from graphloom.operators import metadata as meta
from graphloom.operators import updates
from graphloom.sources.documents import DocumentStore
from graphloom.sources.files import SharedFiles
from tests.conftest import row_key, values


def test_scans_filter_by_datasource_and_label(modern):
    assert modern.vertices("modern").count() == 6
    assert modern.vertices("modern", "person").count() == 4
    assert modern.vertices("modern", ["person", "software"]).count() == 6
    assert modern.edges("modern", "knows").count() == 2
    assert modern.count("modern") == 12
    assert modern.vertices("nothing").count() == 0


def test_properties_become_typed_columns(modern):
    persons = modern.read_vertices("modern", "person")
    assert persons.columns == ["timestamp", "datasource", "label", "id", "id_", "age", "country", "name"]
    assert persons.schema["age"].dataType == T.IntegerType()
    assert values(persons, "id", "name", "age")[0] == ("modern_1", "marko", 29)
    knows = modern.read_edges("modern", "knows")
    assert knows.columns[4:9] == ["source", "target", "id_", "src", "dst"]
    assert values(knows, "source", "target", "weight") == [("modern_1", "modern_2", 0.5), ("modern_1", "modern_4", 1.0)]
    with pytest.raises(GraphNotFoundError):
        modern.read_vertices("modern", "nothing")


def test_no_shuffle_to_type_properties(modern):
    plan = modern.read_vertices("modern", "person")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_documents_keep_their_rows(spark):
    docs = spark.createDataFrame(
        [
            (None, "d", "1", "x", [("n", "java.lang.Integer", "5"), ("n", "java.lang.Integer", "4")]),
            (None, "d", "2", "x", [("n", "java.lang.Integer", "five")]),
            (None, "d", "3", "x", []),
            (None, "d", "4", "x", None),
        ],
        d.VERTEX_DOCUMENT,
    )
    rows = d.explode_vertices(docs, {"n": T.IntegerType()})
    assert values(rows, "id", "n") == [("1", 5), ("2", None), ("3", None), ("4", None)]
    assert values(d.repeated_keys(docs)) == [("1", "n", 2)]


def test_stated_rows_of_modern(modern):
    """(a:person)-[b]-(c:person) over persons of one country who know each other, distinct."""
    graph = modern.graph("modern", {"knows": ("person", "person"), "created": ("person", "software")})
    m = graph.match("a", "person").expand("a", "b", "c", labels="person", direction="both")
    rows = m.df.select(
        m["a.id_"], m["a.name"], m["a.age"], m["a.country"], m.type("b"), m["c.name"]
    ).distinct()
    assert values(rows) == sorted(
        [
            ("modern_1", "marko", 29, "USA", "knows", "josh"),
            ("modern_4", "josh", 32, "USA", "knows", "marko"),
            ("modern_1", "marko", 29, "USA", "knows", "vadas"),
            ("modern_2", "vadas", 27, "USA", "knows", "marko"),
        ],
        key=row_key,
    )
    undeclared = modern.graph("modern")
    again = undeclared.match("a", "person").expand("a", "b", "c", labels="person", direction="both")
    assert again.select("a.name", "c.name").distinct().count() == 4


def test_metadata(modern):
    assert values(modern.datasources()) == [("modern", 6, 6), ("other", 1, 0)]
    assert values(modern.labels("modern"), "kind", "label", "n") == [
        ("edge", "created", 4), ("edge", "knows", 2), ("vertex", "person", 4), ("vertex", "software", 2),
    ]
    assert modern.graph_names() == ["modern", "other"]
    tree = values(modern.scan().where("datasource = 'modern' AND label = 'person'"), "n_docs", "key", "type", "n_key")
    assert tree == [
        (4, "age", "java.lang.Integer", 4), (4, "country", "java.lang.String", 4), (4, "name", "java.lang.String", 4),
    ]
    assert modern.label_schema("modern", "person")["age"].dataType == T.IntegerType()
    assert modern.scan().where("datasource = 'other'").count() == 1


def test_dominant_types(spark):
    docs = spark.createDataFrame(
        [("d", "x", [("k", "A", "1")]), ("d", "x", [("k", "B", "1")]), ("d", "x", [("k", "B", "2"), (None, "B", "2")]), ("d", "x", [])],
        T.StructType(
            [T.StructField("datasource", T.StringType()), T.StructField("label", T.StringType()), d.VERTEX_DOCUMENT["properties"]]
        ),
    )
    assert values(meta.key_types(docs)) == [("d", "x", "k", "B", 2, 3, True, True)]
    assert values(meta.keys(docs).where("key IS NOT NULL")) == [("d", "x", "k", 3)]
    empty = meta.scan(docs, docs.limit(0)).where("n_docs IS NOT NULL")
    assert empty.first()["n_docs"] == 4


def test_upserted_documents_are_live(spark):
    old = spark.createDataFrame([("a", 1, "N"), ("b", 1, "Y"), ("c", 1, None)], "id string, timestamp int, deleted string")
    new = spark.createDataFrame([("a", 2), ("d", 2)], "id string, timestamp int")
    assert values(updates.live(updates.upsert(old, new)), "id") == [("a",), ("c",), ("d",)]
    marked = updates.soft_delete(old, F.col("id") == "c")
    assert values(updates.live(marked), "id") == [("a",)]


def test_unknown_classes_are_texts():
    assert java_class_type("java.lang.Long") == T.LongType()
    assert java_class_type("java.util.List") == T.StringType()
    assert meta.label_schema({"a": "java.sql.Date"})["a"].dataType == T.DateType()


def test_explode_and_regroup(modern):
    docs = modern.vertices("modern", "person")
    exploded = d.explode_properties(docs)
    assert exploded.count() == 12
    again = d.regroup_properties(d.property_structs(exploded))
    joined = again.join(docs.select("id", F.array_sort("properties").alias("sorted")), "id")
    assert joined.where("arr_properties = sorted").count() == 4
    assert values(d.distinct_properties(docs)) == values(again)
    ages = d.typed_values(docs, "age", "int", "age")
    assert sorted((r["age"] for r in ages.collect()), reverse=True) == [35, 32, 29, 27]


def test_edits(spark, modern):
    docs = updates.add_column(modern.vertices("modern"), "deleted", F.lit("N"))
    docs = docs.withColumn("timestamp", F.to_timestamp(F.lit("2024-01-01")))
    thomas = spark.createDataFrame(
        [(None, "modern", "modern_101", "person", [("name", "java.lang.String", "Thomas")], "N")], docs.schema
    ).withColumn("timestamp", F.to_timestamp(F.lit("2024-02-01")))
    added = updates.upsert(docs, thomas)
    assert added.count() == 7
    aged = updates.set_property(added.where("id = 'modern_101'"), "age", F.lit(44), T.IntegerType())
    aged = aged.withColumn("timestamp", F.to_timestamp(F.lit("2024-03-01")))
    changed = updates.upsert(added, aged.unionAll(thomas))
    entry = changed.where("id = 'modern_101'").select(d.property_value(F.col("properties"), "age").alias("age"))
    assert changed.count() == 7 and entry.first()["age"] == "44"
    assert modern.with_changes(vertices=thomas.drop("deleted")).count("modern") == 13
    gone = updates.soft_delete(changed, F.col("id") == "modern_101")
    assert updates.live(gone).count() == 6 and gone.count() == 7
    bare = updates.remove_property(docs, "age", F.col("id") == "modern_1")
    assert bare.where(d.has_property(F.col("properties"), "age")).count() == 3


def test_documents_in_files(spark, modern, tmp_path):
    modern.vertices("modern").write.partitionBy("datasource", "label").parquet(str(tmp_path / "v"))
    modern.edges("modern").write.partitionBy("datasource", "label").parquet(str(tmp_path / "e"))
    store = DocumentStore.read(spark, str(tmp_path / "v"), str(tmp_path / "e"))
    plan = store.vertices("modern", "person")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datasource" in plan
    assert values(store.read_vertices("modern", "person"), "name") == values(modern.read_vertices("modern", "person"), "name")


def test_list_functions(spark):
    df = spark.sql(
        "SELECT array('1','22','333','4444') AS a, cast(null as array<string>) AS n, "
        "array(named_struct('f', 2, 'g', 'x'), named_struct('f', null, 'g', 'y'), named_struct('f', 1, 'g', 'z')) AS s, "
        "named_struct('f', 1, 'g', 'x') AS l, named_struct('f', 1, 'g', 'w') AS r"
    )
    row = df.select(
        structs.total_text_length(F.col("a")).alias("total"),
        structs.total_text_length(F.col("n")).alias("none"),
        structs.contains_text(F.array(F.lit("a"), F.lit("b")), F.lit("b")).alias("has"),
        structs.field_of_each(structs.array_struct_sort(F.col("s"), "f"), "g").alias("ordered"),
        structs.struct_diff(df, F.col("l"), F.col("r")).alias("changed"),
        structs.struct_diff(df, F.col("l"), F.col("l")).alias("same"),
    ).first()
    assert (row["total"], row["none"], row["has"], row["ordered"], row["same"]) == (10, None, True, ["y", "z", "x"], None)
    assert [c.asDict() for c in row["changed"]] == [{"field": "g", "value": "w"}]


def test_functions_for_sql(spark):
    names = structs.register_sql_functions(spark)
    assert "sum_list_string_length" in names
    assert spark.sql("SELECT sum_list_string_length(array('1','22','333','4444')) AS n").first()["n"] == 10
    structs.register_function(spark, "shout", lambda s: s.upper(), "string")
    assert spark.sql("SELECT shout('abc') AS s").first()["s"] == "ABC"


def test_struct_and_list_columns(spark):
    artists = spark.createDataFrame([(1, "art01", ("http://art01.com", "art01.png"))], "id long, name string, links struct<url string, picture string>")
    pictures = spark.createDataFrame([(1001, "sun-raise", ["a", "b", "c", "d"])], "id long, name string, links array<string>")
    assert artists.select("links.url").first()["url"] == "http://art01.com"
    assert pictures.select(F.explode("links")).count() == 4
    assert values(d.table_counts(artists=artists, pictures=pictures)) == [("artists", 1), ("pictures", 1)]


def test_all_values_of_repeated_keys(spark):
    entry = lambda k, v: (k, "java.lang.String", v)
    docs = spark.createDataFrame(
        [
            (None, "s", "a", "x", [entry("k", "1"), entry("k", "zwei"), entry("o", "p"), entry("k", None), entry("o", "q")]),
            (None, "s", "b", "x", [entry(None, "1")]), (None, "s", "c", "x", None),
        ],
        d.VERTEX_DOCUMENT,
    )
    keys = {"k": T.IntegerType(), "o": T.StringType()}
    lists = {r["id"]: (r["k"], r["o"]) for r in d.explode_vertices(docs, keys, repeated=d.ALL).collect()}
    assert lists == {"a": ([1, None, None], ["p", "q"]), "b": ([], []), "c": ([], [])}
    rows = sorted(((r["id"], r["k"], r["o"]) for r in d.explode_vertices(docs, keys, repeated=d.ROWS).collect()), key=repr)
    assert rows == sorted([("a", k, o) for k in (1, None, None) for o in "pq"] + [("b", None, None), ("c", None, None)], key=repr)
    firsts = {r["id"]: (r["k"], r["o"]) for r in d.explode_vertices(docs, keys).collect()}
    assert firsts == {"a": (1, "p"), "b": (None, None), "c": (None, None)}
    edges = docs.select("timestamp", "datasource", "id", "label", F.lit("x").alias("src"), F.lit("y").alias("dst"), "properties")
    assert d.explode_edges(edges, keys, repeated=d.ROWS).count() == 8
    with pytest.raises(GraphError):
        d.explode_vertices(docs, keys, repeated="some")


# -- saved collections ----------------------------------------------------------------------------


def _documents(spark, rows):
    """Vertex documents of `(datasource, id, label, name)`, with a time that orders versions."""
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, n + 1), source, i, label, [("name", "java.lang.String", name)]) for n, (source, i, label, name) in enumerate(rows)],
        d.VERTEX_DOCUMENT,
    )


def _named(docs):
    return sorted((r["id"], r["datasource"], r["label"], r["properties"][0]["value"]) for r in docs.collect())


@pytest.fixture
def saved(spark, modern, tmp_path):
    modern.save(str(tmp_path / "docs"), buckets=4)
    return DocumentStore.load(spark, str(tmp_path / "docs"))


def test_a_saved_collection_is_the_collection(saved, modern):
    for labels in (None, "person", ["person", "software"]):
        assert _named(saved.vertices("modern", labels)) == _named(modern.vertices("modern", labels))
    assert saved.edges("modern", "knows").count() == 2 and saved.count("modern") == 12 and saved.count("nobody") == 0
    for answer in ("scan", "datasources"):
        assert values(getattr(saved, answer)()) == values(getattr(modern, answer)())
    assert values(saved.labels("modern")) == values(modern.labels("modern"))
    assert values(saved.key_types("modern", "person")) == values(modern.key_types("modern", "person"))
    assert saved.graph_names() == modern.graph_names() and saved.label_schema("modern", "person") == modern.label_schema("modern", "person")
    assert saved.graph("modern").match("a", "person").expand("a", "r", "b", types="knows").df.count() == 2


def test_scans_read_folders_of_their_labels_and_metadata_reads_counts(saved):
    plan = saved.vertices("modern", "person")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "at_source" in filters and "at_label" in filters
    files = [f for frame in (saved.scan(), saved.labels("modern")) for f in frame.inputFiles()]
    assert files and all("/counts/" in f for f in files)


def test_an_upsert_leaves_other_buckets_alone(spark, saved):
    before = dict(saved.manifest.folders["vertex"])
    changed = _documents(spark, [("modern", "modern_1", "person", "Marko"), ("modern", "modern_1", "person", "Mark")])
    after = saved.upsert(vertices=changed)
    moved = {b for b, folder in after.manifest.folders["vertex"].items() if before.get(b) != folder}
    assert len(moved) == 1 and after.manifest.folders["edge"] == saved.manifest.folders["edge"]
    assert after.manifest.version == saved.manifest.version + 1
    assert ("modern_1", "modern", "person", "Mark") in _named(after.vertices("modern")) and after.vertices("modern").count() == 6
    assert ("modern_1", "modern", "person", "marko") in _named(saved.vertices("modern"))  # the version it was opened at
    assert values(after.key_types("modern", "person").where("key = 'name'"), "n_key") == [(4,)]
    assert values(after.key_types("modern", "person").where("key = 'age'"), "n_key", "nullable") == [(3, True)]
    after.clear()
    assert _named(DocumentStore.load(spark, after._root).vertices("modern")) == _named(after.vertices("modern"))
    assert len(after._files.files(f"{after._root}/manifests")) == 1
    with pytest.raises(GraphError):
        saved.clear()


def test_a_lost_write_leaves_the_version_before(spark, saved, monkeypatch):
    changed = _documents(spark, [("modern", "modern_1", "person", "Mark")])
    with monkeypatch.context() as lost:
        lost.setattr(SharedFiles, "rename", lambda *_: (_ for _ in ()).throw(GraphError("lost")))
        with pytest.raises(GraphError):
            saved.upsert(vertices=changed)
    again = DocumentStore.load(spark, saved._root)
    assert again.manifest == saved.manifest and _named(again.vertices("modern")) == _named(saved.vertices("modern"))
    first = again.upsert(vertices=changed)
    with pytest.raises(GraphError):  # second to the same version
        saved.upsert(vertices=changed)
    assert DocumentStore.load(spark, saved._root).manifest == first.manifest


def test_odd_names_deleted_and_empty_collections(spark, tmp_path):
    odd = [("", "a", "", "x"), (None, "b", None, "x"), ("s/1=2", "c", "l%41 é", "x"), ("7", "e", "07", "x"), ("s", "f", "person", "x")]
    docs = _documents(spark, odd)
    edges = spark.createDataFrame([], d.EDGE_DOCUMENT)
    DocumentStore(updates.soft_delete(docs, F.col("id") == "f"), edges).save(str(tmp_path / "odd"), buckets=3)
    store = DocumentStore.load(spark, str(tmp_path / "odd"))
    for source, i, label, name in odd[:4]:
        if source is not None:
            assert _named(store.vertices(source, label)) == _named(store.vertices(source)) == [(i, source, label, name)]
    assert store.vertices("s").count() == 0 and store.scan().count() == 4 and store.edges("s").count() == 0
    assert sorted(r["id"] for r in store._documents["vertex"].collect()) == ["a", "b", "c", "e", "f"]
    gone = store.upsert(vertices=updates.soft_delete(docs, F.lit(True)))
    assert gone.scan().count() == 0 and gone.count("7") == 0 and gone.upsert(vertices=docs.limit(0)).scan().count() == 0
    DocumentStore(docs.limit(0), edges).save(str(tmp_path / "none"))
    none = DocumentStore.load(spark, str(tmp_path / "none"))
    assert none.scan().count() == 0 and none.upsert(vertices=docs).vertices("7").count() == 1
    with pytest.raises(GraphNotFoundError):
        DocumentStore.load(spark, str(tmp_path / "nothing"))
