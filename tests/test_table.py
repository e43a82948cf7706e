from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphError, GraphSchemaError, GraphTypeError
from graphloom.model.types import normalize_types
from graphloom.operators import aggregates as agg
from graphloom.operators import ids, paging
from graphloom.operators import table as t
from tests.conftest import row_key, values


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, i % 3, f"v{i}") for i in range(10)], "`a.id` int, g int, v string")


def test_projection_by_exact_name(rows):
    assert t.select(rows, ("a.id", "id"), "g").columns == ["id", "g"]
    with pytest.raises(GraphSchemaError):
        t.select(rows, "nothing")


def test_columns_are_replaced_in_place(rows):
    assert t.with_columns(rows, {"g": F.col("g") + 1, "w": F.lit(1)}).columns == ["a.id", "g", "v", "w"]
    assert t.drop(rows, "v", "nothing").columns == ["a.id", "g"]
    with pytest.raises(GraphSchemaError):
        t.add_columns(rows, {"g": F.lit(1)})
    with pytest.raises(GraphSchemaError):
        t.replace_column(rows, "nothing", F.lit(1))
    with pytest.raises(GraphSchemaError):
        t.drop_existing(rows, "nothing")
    assert t.replace_column(rows, "v", F.lit(1)).columns == rows.columns


def test_renaming_refuses_collisions(rows):
    assert t.rename(rows, {"g": "h", "v": "g"}).columns == ["a.id", "h", "g"]
    with pytest.raises(GraphSchemaError):
        t.rename(rows, {"g": "v"})
    assert t.remove_prefix(t.prefix_columns(rows, "x_"), "x_").columns == rows.columns


@pytest.mark.parametrize("n", [0, 1, 7, 100, 1000])
def test_skip_leaves_out_the_first_rows(spark, n):
    df = spark.range(500, numPartitions=7).selectExpr("id", "(id * 37) % 11 as k")
    kept = paging.skip(df, n, "k", "id")
    expected = sorted(((r["k"], r["id"]) for r in df.collect()))[n:]
    assert sorted((r["k"], r["id"]) for r in kept.collect()) == expected


def test_row_numbers_have_no_gaps_even_when_all_rows_tie(spark):
    df = spark.range(1000, numPartitions=8).select(F.lit(1).alias("k"), F.col("id"))
    numbered = t.with_row_index(df, "k")
    assert sorted(r["row_index"] for r in numbered.collect()) == list(range(1000))


def test_pages(spark):
    df = spark.range(100, numPartitions=5).selectExpr("id", "(id * 17) % 101 as k")
    small = paging.page(df, "k", skip=10, limit=20)
    expected = sorted(((r["k"], r["id"]) for r in df.collect()))[10:30]
    assert sorted((r["k"], r["id"]) for r in small.collect()) == expected


def test_sorting_puts_nulls_first_and_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "k int")
    assert [r["k"] for r in t.order_by(df, "k").collect()] == [None, 1, 2]
    assert [r["k"] for r in t.order_by(df, F.col("k").desc()).collect()] == [2, 1, None]
    with pytest.raises(GraphError):
        t.limit(df, 2**31)


def test_union_needs_equal_types(spark, rows):
    assert t.union_all(rows, rows).count() == 20
    with pytest.raises(GraphSchemaError):
        t.union_all(rows, rows.select("v", "g", "v"))
    with pytest.raises(GraphSchemaError):
        t.union_all(rows, rows.select("g"))


def test_distinct_on_takes_the_first(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 1), (2, None, 9)], "k int, v string, w int")
    assert values(t.distinct_on(df, ["k"], ["v"])) == [(1, "a", 3), (2, None, 9)]
    assert t.distinct_on(df, ["k"]).count() == 2


def test_joins_refuse_shared_names(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "a int, l string")
    right = spark.createDataFrame([(2, "p"), (3, "q")], "b int, r string")
    pairs = [("a", "b")]
    assert values(t.join(left, right, pairs)) == [(2, "y", 2, "p")]
    assert values(t.join(left, right, pairs, "left")) == [(1, "x", None, None), (2, "y", 2, "p")]
    assert values(t.join(left, right, pairs, "right")) == sorted([(2, "y", 2, "p"), (None, None, 3, "q")], key=row_key)
    assert t.join(left, right, pairs, "full").count() == 3
    with pytest.raises(GraphSchemaError):
        t.join(left, left, [("a", "a")])
    with pytest.raises(GraphError):
        t.join(left, right, pairs, "left_semi")


def test_types_widen_and_unknown_ones_are_refused(spark):
    df = spark.range(1).selectExpr(
        "cast(1 as tinyint) a", "cast(1 as smallint) b", "1 c", "cast(1 as float) d", "array(1) e",
        "named_struct('x', 1, 'y', 'z') f", "cast(1 as decimal(5,2)) g",
    )
    assert [f.dataType.simpleString() for f in normalize_types(df).schema.fields] == [
        "bigint", "bigint", "bigint", "double", "array<bigint>", "struct<x:bigint,y:string>", "decimal(5,2)",
    ]
    with pytest.raises(GraphTypeError):
        normalize_types(spark.sql("SELECT make_ym_interval(1, 2) AS i"))


def test_id_types(spark):
    df = spark.range(1).selectExpr("1 as i", "'x' as s", "cast('x' as binary) as b", "1.5D as d")
    assert [f.dataType.simpleString() for f in t.normalize_ids(df, "i", "s", "b").schema.fields][:3] == [
        "bigint", "string", "binary",
    ]
    with pytest.raises(GraphTypeError):
        t.normalize_ids(df, "d")
    coded = t.hex_to_binary(t.binary_to_hex(df), "b")
    assert bytes(coded.first()["b"]) == b"x"


def test_validation(spark):
    df = spark.range(1).selectExpr("id", "'x' as s")
    assert t.validate(df, {"id": T.LongType(), "s": T.StringType()}) is df
    assert t.validate(df, {"id": T.DoubleType()}) is df
    with pytest.raises(GraphSchemaError):
        t.validate(df, {"nothing": T.LongType()})
    with pytest.raises(GraphSchemaError):
        t.validate(df, {"s": T.LongType()})


def test_looking_at_tables(spark, rows):
    assert t.size(rows) == 10
    assert t.column_type(rows, "g") == T.LongType()
    assert len(list(t.rows(rows))) == 10
    seen = spark.sparkContext.accumulator(0)
    t.for_each_partition(rows, lambda part: seen.add(sum(1 for _ in part)))
    assert seen.value == 10
    cached = t.cache(rows)
    assert cached.storageLevel.useMemory
    cached.unpersist()
    assert t.unit(spark).count() == 1
    assert t.empty(spark, T.StructType([T.StructField("x", T.LongType())])).count() == 0


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 5)], "g string, v int")
    v = F.col("v")
    got = agg.group(
        df, ["g"], n=agg.count_all(), some=agg.count(v), different=agg.count_distinct(v), low=agg.smallest(v),
        high=agg.largest(v), total=agg.total(v), mean=agg.avg(v, "int"), every=agg.collect(v),
        each=agg.collect_distinct(v),
    )
    assert values(got) == [
        ("a", 3, 2, 1, 1, 1, 2, 1, [1, 1], [1]),
        ("b", 1, 1, 1, 5, 5, 5, 5, [5], [5]),
    ]
    assert agg.group(df, n=agg.count_all()).first()["n"] == 4
    counted = agg.collect_counted(df, ["g"], "v", "found")
    assert values(counted.select("g", agg.repeated(F.col("found")))) == [("a", [1, 1]), ("b", [5])]
    structs = agg.group(df, ["g"], s=agg.collect_structs(v.alias("v"))).where("g = 'b'")
    assert structs.first()["s"][0]["v"] == 5


def test_segments_hold_whole_groups_in_bounded_lists(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, id, 0) % 50 as g", "(id * 7) % 1000 as v")
    segments = agg.collect_segments(df, ["g"], "v", "found", size=64).collect()
    assert max(len(r["found"]) for r in segments) <= 64
    got = {}
    for r in sorted(segments, key=lambda r: (r["g"], r["segment"])):
        got.setdefault(r["g"], []).extend(r["found"])
    expected = {}
    for r in df.collect():
        expected.setdefault(r["g"], []).append(r["v"])
    assert got == {g: sorted(vs) for g, vs in expected.items()}


def test_sum_overflow_is_an_error(spark):
    df = spark.createDataFrame([(2**63 - 1,), (1,)], "v long")
    with pytest.raises(Exception, match="overflow"):
        agg.group(df, s=agg.total(F.col("v"))).collect()


def test_serialized_ids_never_meet(spark):
    df = spark.createDataFrame(
        [("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None), ("", "abc"), ("~", "abc"), ("1:a", ""), (None, None)],
        "x string, y string",
    )
    keyed = df.select(ids.serialized_id("k'\\", ["x", "y"]).alias("id"))
    assert keyed.distinct().count() == df.count()
    assert keyed.where("id is null").count() == 0


def test_generated_and_packed_ids(spark):
    frames = ids.add_unique_ids([spark.range(100, numPartitions=3).toDF("x"), spark.range(50).toDF("x")], "id")
    both = frames[0].unionAll(frames[1])
    assert both.select("id").distinct().count() == 150
    packed = spark.range(5).select(ids.packed_id(1, "id").alias("p"), ids.packed_id(2, "id").alias("q"))
    assert {r["p"] for r in packed.collect()} & {r["q"] for r in packed.collect()} == set()
    too_big = spark.range(1).selectExpr("cast(1 as bigint) << 60 as id").select(ids.packed_id(1, "id").alias("p"))
    with pytest.raises(Exception, match="overflow"):
        too_big.collect()
    hashed = spark.range(1000).select(ids.hashed_id("v", ["L"], ["id"]).alias("h"))
    assert hashed.distinct().count() == 1000
    with pytest.raises(GraphError):
        ids.serialized_id("k", [])


def test_hashed_ids_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None), ("a|", "a"), ("", "a")], "x string, y string")
    assert df.select(ids.hashed_id("v", ["L"], ["x", "y"]).alias("id")).distinct().count() == 6


def test_copies_are_numbered_where_they_are(spark):
    from graphloom.operators.table import with_copy_index

    rows = [(1, "a")] * 500 + [(2, None)] * 3 + [(3, "c"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "k long, v string").repartition(7).withColumn("m", F.create_map(F.lit("x"), F.rand()))
    for by, key in ((None, lambda r: (r.k, r.v)), (["k"], lambda r: r.k)):
        found = {}
        for r in with_copy_index(df, by, "copy").collect():
            found.setdefault(key(r), []).append(r["copy"])
        assert {k: sorted(v) for k, v in found.items()} == {k: list(range(len(v))) for k, v in found.items()}
        assert sum(map(len, found.values())) == len(rows)
    with pytest.raises(GraphSchemaError):
        with_copy_index(df, name="k")


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins_split_a_hot_key(spark, how):
    """Half of the rows of both sides have one key, some have none; no task of the join reads much more than another."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    session = spark.newSession()
    for name, value in settings.items():
        session.conf.set(name, value)
    n = 30_000
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id"))
    big = session.range(n, numPartitions=8).repartition(8).select(key.alias("k"), F.col("id").alias("v"))
    few = session.createDataFrame([(7, "seven"), (9, "nine"), (None, "none"), (-1, "no")], "f long, name string")
    left, right, pairs = (few, big, [("f", "k")]) if how != "right" else (big, few, [("k", "f")])
    for names in ((left, right, pairs), (right, left, [(b, a) for a, b in pairs])):
        plain = names[0].join(names[1], F.col(names[2][0][0]) == F.col(names[2][0][1]), how)
        found = t.join(*names, how)
        assert found.columns == plain.columns
        same = lambda df: df.groupBy("name", "k", "f").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
        assert same(found).exceptAll(same(plain)).isEmpty() and same(plain).exceptAll(same(found)).isEmpty()
    joined = t.join(left, right, pairs, how)
    per_task = [r["n"] for r in joined.select("v", F.spark_partition_id().alias("task")).groupBy("task").agg(F.count("v").alias("n")).collect()]
    assert sum(per_task) >= n // 2 and max(per_task) < n // 4


def test_outer_joins_of_rows_that_change(spark):
    left = spark.range(200).select(F.floor(F.rand() * 100).cast("long").alias("a"), "id")
    right = spark.range(50).select(F.col("id").alias("b"))
    rows = t.join(left, right, [("a", "b")], "full")
    assert rows.where("id is not null").count() == 200


ORDERS = lambda: [
    ["k", "v"], [F.col("k").desc(), "v"], [F.col("v").desc_nulls_first(), F.col("k").asc_nulls_last()], [F.upper("v"), F.col("d").desc()],
    ["at", F.col("day").desc()], ["d", "b"], ["same"], [F.struct("k", "v")],
]


@pytest.mark.parametrize("place", range(8))
def test_pages_of_any_order(spark, place):
    """Pages next to numbering all rows; nothing is lost, whatever the order, and pages follow each other."""
    order = ORDERS()[place]
    n = 3000
    rows = spark.range(n).select(
        "id", F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("k"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id") % 11)).alias("v"),
        (F.col("id") % 13 / 8 - 1).alias("d"), (F.col("id") % 2 == 0).alias("b"), F.lit(1).alias("same"),
        F.timestamp_seconds(F.col("id") % 90 * 100_000).alias("at"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 9).cast("int")).alias("day"),
    ).repartition(5)
    numbered = sorted((r["@row"], r["id"]) for r in t.with_row_index(rows, *order, name="@row").select("@row", "id").collect())
    expected = [i for _, i in numbered]
    for first, limit in ((0, 10), (1490, 40), (2995, 50), (5000, 5), (100, 2000)):
        found = sorted(r["id"] for r in paging.page(rows, *order, skip=first, limit=limit).collect())
        assert found == sorted(expected[first : first + limit])
    assert sorted(r["id"] for r in paging.skip(rows, 1234, *order).collect()) == sorted(expected[1234:])
    assert paging.page(rows.limit(0), *order, limit=5).collect() == []


def test_only_ranges_that_a_page_cuts_are_written(spark, monkeypatch):
    rows = spark.range(20_000).withColumn("k", F.col("id") % 1000)
    written, kept = t.written, []
    monkeypatch.setattr(t, "written", lambda df, name: kept.append(df.count()) or written(df, name))
    assert paging.page(rows, "k", skip=9_990, limit=20).count() == 20
    assert paging.skip(rows, 15_000, F.col("k").desc()).count() == 5_000
    assert kept and sum(kept) < 3 * 20_000 / 16
