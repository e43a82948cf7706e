"""Scalar expressions on whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from graphloom.functions import entities, lists, numeric, predicates, strings, structs, temporal
from graphloom.operators import aggregates as agg
from graphloom.operators.ids import append_to_path, generated_id
from graphloom.plans.registry import query
from graphloom.plans.tables import shop_graph, table


def rounded(column):
    return F.round(column, 6)


@query(
    "string_fns",
    """
    SELECT p_partkey AS k, CAST(length(p_name) AS BIGINT) AS size, p_name || p_size AS plus_number,
        p_name || p_brand AS plus_text, trim('  ' || p_name || ' ') AS trimmed, ltrim('  ' || p_name) AS left_trimmed,
        rtrim(p_name || '  ') AS right_trimmed, upper(p_name) AS up, lower(p_brand) AS low,
        replace(p_name, 'ol', 'XYZ') AS replaced, translate(p_name, 'ol', 'XY') AS translated,
        substr(p_name, 3) AS tail, substr(p_name, 2, 4) AS middle
    FROM part
    """,
)
def string_fns(spark, folder):
    part = table(spark, folder, "part")
    name = F.col("p_name")
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    return part.select(
        F.col("p_partkey").alias("k"),
        strings.size(name).alias("size"),
        numeric.plus(part, name, F.col("p_size")).alias("plus_number"),
        strings.concat(name, F.col("p_brand")).alias("plus_text"),
        strings.trim(padded).alias("trimmed"),
        strings.ltrim(F.concat(F.lit("  "), name)).alias("left_trimmed"),
        strings.rtrim(F.concat(name, F.lit("  "))).alias("right_trimmed"),
        strings.to_upper(name).alias("up"),
        strings.to_lower(F.col("p_brand")).alias("low"),
        strings.replace(name, F.lit("ol"), F.lit("XYZ")).alias("replaced"),
        strings.translate(name, "ol", "XY").alias("translated"),
        strings.substring(name, F.lit(2)).alias("tail"),
        strings.substring(name, F.lit(1), F.lit(4)).alias("middle"),
    )


@query(
    "predicates",
    """
    SELECT o_orderkey AS k, o_orderpriority = '1-URGENT' AS eq, NOT (o_orderstatus = 'F') AS neg,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END IS NULL AS absent,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END IS NOT NULL AS present,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AND o_totalprice > 200000 AS both,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END OR o_totalprice > 200000 AS either,
        o_totalprice < 100000 AS lt, o_totalprice <= 100000 AS le, o_totalprice > 300000 AS gt,
        o_totalprice >= 300000 AS ge, o_orderstatus IN ('F', NULL) AS within,
        starts_with(o_orderpriority, '1-') AS starts, suffix(o_orderpriority, 'LOW') AS ends,
        contains(o_orderpriority, 'IGH') AS has, regexp_matches(o_orderpriority, '[0-9]-[HM]') AS found,
        regexp_full_match(o_orderpriority, '[0-9]-[A-Z]+') AS covered,
        CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' END AS band,
        coalesce(CASE WHEN o_orderstatus = 'F' THEN 'f' END, 'other') AS first_known, false AS mixed
    FROM orders
    """,
)
def predicates_(spark, folder):
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    known = F.when(status != "P", status)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"),
        predicates.equals(priority, F.lit("1-URGENT")).alias("eq"),
        predicates.not_(status == "F").alias("neg"),
        predicates.is_null(known).alias("absent"),
        predicates.exists(known).alias("present"),
        predicates.all_of([known == "F", price > 200000]).alias("both"),
        predicates.any_of([known == "F", price > 200000]).alias("either"),
        predicates.less(price, F.lit(100000)).alias("lt"),
        predicates.less_or_equal(price, F.lit(100000)).alias("le"),
        predicates.greater(price, F.lit(300000)).alias("gt"),
        predicates.greater_or_equal(price, F.lit(300000)).alias("ge"),
        predicates.in_list(status, F.array(F.lit("F"), F.lit(None))).alias("within"),
        predicates.starts_with(priority, F.lit("1-")).alias("starts"),
        predicates.ends_with(priority, F.lit("LOW")).alias("ends"),
        predicates.contains(priority, F.lit("IGH")).alias("has"),
        predicates.matches(priority, "[0-9]-[HM]").alias("found"),
        predicates.matches(priority, "[0-9]-[A-Z]+", full=True).alias("covered"),
        predicates.case([(price < 100000, F.lit("low")), (price < 300000, F.lit("mid"))]).alias("band"),
        predicates.coalesce(F.when(status == "F", "f"), F.lit("other")).alias("first_known"),
        F.coalesce(predicates.equals_as(priority, F.col("o_orderkey"), "bigint"), F.lit(False)).alias("mixed"),
    )


@query(
    "math_fns",
    """
    SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_linenumber AS n,
        l_quantity + l_tax AS plus, l_quantity - l_discount AS minus, l_quantity * 3 AS times,
        l_extendedprice / l_quantity AS quotient, CAST(l_orderkey // 7 AS BIGINT) AS whole,
        CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS by_zero,
        round(sqrt(l_quantity), 6) AS root, round(ln(l_quantity), 6) AS log, round(log10(l_extendedprice), 6) AS log10,
        round(exp(l_discount), 6) AS exp, abs(l_tax - 1) AS abs, CAST(ceil(l_extendedprice) AS DOUBLE) AS up,
        CAST(floor(l_extendedprice) AS DOUBLE) AS down, CAST(round(l_quantity / 4) AS DOUBLE) AS near,
        CAST(sign(l_discount - 0.05) AS INTEGER) AS sign
    FROM lineitem
    """,
)
def math_fns(spark, folder):
    lines = table(spark, folder, "lineitem")
    quantity, price, discount, tax = (
        F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    return lines.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        F.col("l_linenumber").alias("n"),
        (quantity + tax).alias("plus"),
        (quantity - discount).alias("minus"),
        numeric.times(quantity, F.lit(3)).alias("times"),
        numeric.divide(lines, price, quantity).alias("quotient"),
        numeric.divide(lines, F.col("l_orderkey"), F.lit(7)).alias("whole"),
        numeric.divide(lines, quantity, discount).alias("by_zero"),
        rounded(numeric.sqrt(quantity)).alias("root"),
        rounded(numeric.log(quantity)).alias("log"),
        rounded(numeric.log10(price)).alias("log10"),
        rounded(numeric.exp(discount)).alias("exp"),
        numeric.abs_(tax - 1).alias("abs"),
        numeric.ceil(price).alias("up"),
        numeric.floor(price).alias("down"),
        numeric.round_(quantity / 4).alias("near"),
        numeric.sign(discount - F.lit(0.05)).alias("sign"),
    )


@query(
    "trig_fns",
    """
    SELECT DISTINCT l_discount AS x, round(acos(l_discount), 6) AS acos, round(asin(l_discount), 6) AS asin,
        round(atan(l_discount), 6) AS atan, round(atan2(l_discount, l_quantity), 6) AS atan2, l_quantity AS y,
        round(cos(l_quantity), 6) AS cos, round(cot(l_quantity), 6) AS cot, round(sin(l_quantity), 6) AS sin,
        round(tan(l_quantity), 6) AS tan, round(degrees(l_quantity), 6) AS degrees,
        round(radians(l_quantity), 6) AS radians, round((1 - cos(l_quantity)) / 2, 6) AS haversin,
        round(exp(1.0), 6) AS e, round(pi(), 6) AS pi
    FROM lineitem
    """,
)
def trig_fns(spark, folder):
    x, y = F.col("l_discount"), F.col("l_quantity")
    pairs = table(spark, folder, "lineitem").select("l_discount", "l_quantity").distinct()
    return pairs.select(
        x.alias("x"),
        rounded(numeric.acos(x)).alias("acos"),
        rounded(numeric.asin(x)).alias("asin"),
        rounded(numeric.atan(x)).alias("atan"),
        rounded(numeric.atan2(x, y)).alias("atan2"),
        y.alias("y"),
        rounded(numeric.cos(y)).alias("cos"),
        rounded(numeric.cot(y)).alias("cot"),
        rounded(numeric.sin(y)).alias("sin"),
        rounded(numeric.tan(y)).alias("tan"),
        rounded(numeric.degrees(y)).alias("degrees"),
        rounded(numeric.radians(y)).alias("radians"),
        rounded(numeric.haversin(y)).alias("haversin"),
        rounded(numeric.e()).alias("e"),
        rounded(numeric.pi()).alias("pi"),
    )


@query(
    "bit_fns",
    """
    SELECT o_orderkey AS k, o_orderkey & 255 AS band, o_orderkey | 4096 AS bor, o_orderkey << 3 AS shl,
        o_orderkey >> 2 AS shr FROM orders
    """,
)
def bit_fns(spark, folder):
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        k.alias("k"),
        numeric.bit_and(k, F.lit(255)).alias("band"),
        numeric.bit_or(k, F.lit(4096)).alias("bor"),
        numeric.shift_left(k, 3).alias("shl"),
        numeric.shift_right_unsigned(k, 2).alias("shr"),
    )


@query(
    "cast_fns",
    """
    SELECT p_partkey AS k, TRY_CAST(p_name AS DOUBLE) AS no_number, CAST(p_size AS DOUBLE) AS to_float,
        CAST(CAST(p_partkey AS VARCHAR) AS BIGINT) AS to_integer, CAST(p_size AS VARCHAR) AS to_string,
        p_size % 2 = 1 AS to_boolean, CAST(NULL AS BOOLEAN) AS no_boolean
    FROM part
    """,
)
def cast_fns(spark, folder):
    size, name = F.col("p_size"), F.col("p_name")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("k"),
        numeric.to_float(name).alias("no_number"),
        numeric.to_float(size).alias("to_float"),
        numeric.to_integer(numeric.to_string(F.col("p_partkey"))).alias("to_integer"),
        numeric.to_string(size).alias("to_string"),
        numeric.to_boolean(F.when(size % 2 == 1, "true").otherwise("false")).alias("to_boolean"),
        numeric.to_boolean(name).alias("no_boolean"),
    )


@query(
    "list_map_fns",
    """
    SELECT s_suppkey AS k, s_name AS second, CAST(NULL AS VARCHAR) AS outside, CAST(3 AS BIGINT) AS size,
        CAST(NULL AS BIGINT) AS no_size, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS no_key,
        array_to_string(range(s_nationkey, s_nationkey + 5, 2), ',') AS odd,
        array_to_string(range(s_nationkey, s_nationkey - 3, -1), ',') AS down, '' AS none,
        'balance,name' AS keys, s_suppkey || ',' || s_nationkey || ',99' AS appended
    FROM supplier
    """,
)
def list_map_fns(spark, folder):
    supplier = table(spark, folder, "supplier")
    nation = F.col("s_nationkey")
    texts = lists.list_of(F.lit("a"), F.col("s_name"), F.lit("c"))
    made = lists.map_of({"name": F.col("s_name"), "balance": F.col("s_acctbal"), "gone": lists.null_of("string")})
    keys = lists.list_of(F.col("s_suppkey"), nation.cast("bigint"))
    return supplier.select(
        F.col("s_suppkey").alias("k"),
        lists.at(texts, F.lit(1)).alias("second"),
        lists.at(texts, F.lit(7)).alias("outside"),
        lists.size(texts).alias("size"),
        lists.size(lists.null_of("array<string>")).alias("no_size"),
        lists.map_value(supplier, made, "balance").alias("balance"),
        lists.map_value(supplier, made, "missing").cast("string").alias("no_key"),
        F.array_join(lists.range_(nation, nation + 4, 2), ",").alias("odd"),
        F.array_join(lists.range_(nation, nation - 2, -1), ",").alias("down"),
        F.array_join(lists.range_(nation, nation - 2), ",").alias("none"),
        F.array_join(lists.map_keys(supplier, made), ",").alias("keys"),
        F.array_join(append_to_path(keys, F.lit(99).cast("bigint")), ",").alias("appended"),
    )


@query(
    "unwind",
    """
    SELECT word, count(*) AS n FROM (
        SELECT unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_size > 10) GROUP BY word
    """,
)
def unwind(spark, folder):
    """MATCH (p:Part) UNWIND split(p.name) AS word RETURN word, count(*); a null list has no rows."""
    m = shop_graph(spark, folder).match("p", "Part")
    words = F.when(m["p.size"] > 10, F.split(m["p.name"], " "))
    return agg.group(m.df.select(lists.unwind(words).alias("word")), ["word"], n=agg.count_all())


@query(
    "temporal_fns",
    """
    SELECT o_orderkey AS k, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m,
        week(o_orderdate) AS w, day(o_orderdate) AS d, dayofyear(o_orderdate) AS od, isoyear(o_orderdate) AS wy,
        date_diff('day', date_trunc('quarter', o_orderdate), o_orderdate) + 1 AS dq, isodow(o_orderdate) AS dw,
        CAST(o_orderdate AS DATE) AS day, make_date(year(o_orderdate), month(o_orderdate), 1) AS first_of_month,
        CAST(date_trunc('week', make_date(year(o_orderdate), 1, 4)) AS DATE) + 9 AS week_two,
        CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS plus_month,
        strftime(o_orderdate + INTERVAL 14 DAY, '%Y-%m-%d') AS plus_fortnight
    FROM orders
    """,
)
def temporal_fns(spark, folder):
    moment = F.col("o_orderdate")
    day = moment.cast("date")
    names = {"y": "year", "q": "quarter", "m": "month", "w": "week", "d": "day", "od": "ordinalDay",
             "wy": "weekYear", "dq": "dayOfQuarter", "dw": "dayOfWeek"}
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"),
        *[temporal.accessor(moment, name).alias(alias) for alias, name in names.items()],
        temporal.date(F.date_format(moment, "yyyy-MM-dd")).alias("day"),
        temporal.date({"year": F.year(moment), "month": F.month(moment)}).alias("first_of_month"),
        temporal.date({"year": F.year(moment), "week": 2, "dayOfWeek": 3}).alias("week_two"),
        temporal.date_plus(day, temporal.duration("P1M")).alias("plus_month"),
        F.date_format(temporal.date_plus(day, temporal.duration("P2WT5H")), "yyyy-MM-dd").alias("plus_fortnight"),
    )


@query(
    "time_fns",
    """
    SELECT event_id AS k, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s,
        millisecond(ts) % 1000 AS ms, microsecond(ts) % 1000000 AS us,
        strftime(make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 30.25), '%Y-%m-%d %H:%M:%S.%f') AS half
    FROM events
    """,
)
def time_fns(spark, folder):
    ts = F.col("ts")
    names = {"h": "hour", "mi": "minute", "s": "second", "ms": "millisecond", "us": "microsecond"}
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
             "minute": F.minute(ts), "second": 30, "millisecond": 250}
    return table(spark, folder, "events").select(
        F.col("event_id").alias("k"),
        *[temporal.accessor(ts, name).alias(alias) for alias, name in names.items()],
        F.date_format(temporal.local_datetime(parts), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("half"),
    )


@query(
    "duration_fns",
    """
    WITH d AS (SELECT o_orderkey AS k, o_orderkey % 40 AS months, o_orderkey % 30 AS days,
        (o_orderkey % 50) * 3600000000 + (o_orderkey % 7777) * 1000 AS micros, CAST(o_orderdate AS DATE) AS day
        FROM orders),
    e AS (SELECT *, days + micros // 86400000000 AS all_days, micros % 86400000000 AS below FROM d)
    SELECT k, months // 12 AS years, months // 3 AS quarters, months, all_days // 7 AS weeks, all_days AS days,
        below // 3600000000 AS hours, below // 60000000 AS minutes, below // 1000000 AS seconds,
        below // 1000 AS milliseconds, below AS microseconds, (months // 3) % 4 AS quartersofyear,
        months % 3 AS monthsofquarter, months % 12 AS monthsofyear, all_days % 7 AS daysofweek,
        (below // 60000000) % 60 AS minutesofhour, (below // 1000000) % 60 AS secondsofminute,
        (below // 1000) % 1000 AS millisecondsofsecond, below % 1000000 AS microsecondsofsecond,
        CAST(day + to_months(CAST(months AS INTEGER)) AS DATE) + CAST(all_days AS INTEGER) AS later,
        CAST(day - to_months(CAST(months AS INTEGER)) AS DATE) - CAST(all_days AS INTEGER) AS earlier
    FROM e
    """,
)
def duration_fns(spark, folder):
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        key.alias("k"),
        F.col("o_orderdate").cast("date").alias("day"),
        temporal.duration(
            {"months": key % 40, "days": key % 30, "hours": key % 50, "milliseconds": key % 7777}
        ).alias("span"),
    )
    names = [
        "years", "quarters", "months", "weeks", "days", "hours", "minutes", "seconds", "milliseconds",
        "microseconds", "quartersofyear", "monthsofquarter", "monthsofyear", "daysofweek", "minutesofhour",
        "secondsofminute", "millisecondsofsecond", "microsecondsofsecond",
    ]
    return rows.select(
        "k",
        *[temporal.duration_accessor(F.col("span"), n).alias(n) for n in names],
        numeric.plus(rows, F.col("day"), F.col("span")).alias("later"),
        numeric.minus(rows, F.col("day"), F.col("span")).alias("earlier"),
    )


@query(
    "entity_fns",
    """
    SELECT c_custkey AS custkey, 'Customer' AS labels, true AS is_customer, false AS is_order,
        'acctbal,custkey,name,segment' AS keys, CAST(NULL AS VARCHAR) AS missing, c_name AS name,
        c_custkey * 128 + 1 AS id
    FROM customer
    """,
)
def entity_fns(spark, folder):
    """MATCH (c:Customer) RETURN id(c), labels(c), c:Customer, c:Order, keys(c), c.missing, properties(c).name"""
    m = shop_graph(spark, folder).match("c", "Customer")
    return m.df.select(
        m["c.custkey"].alias("custkey"),
        F.array_join(m.labels("c"), ":").alias("labels"),
        m.has_label("c", "Customer").alias("is_customer"),
        m.has_label("c", "Order").alias("is_order"),
        F.array_join(m.keys("c"), ",").alias("keys"),
        m["c.missing"].cast("string").alias("missing"),
        m.properties("c")["name"].alias("name"),
        m.id("c").alias("id"),
    )


@query(
    "flag_fns",
    """
    SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'Done,Large'
        WHEN o_orderstatus = 'F' THEN 'Done' WHEN o_totalprice > 200000 THEN 'Large' ELSE '' END AS labels,
        CASE WHEN o_orderstatus = 'F' THEN 'FILLED' WHEN o_orderstatus = 'O' THEN 'OPEN' END AS type
    FROM orders
    """,
)
def flag_fns(spark, folder):
    """Labels and type of elements kept as one boolean column per label or type."""
    status = F.col("o_orderstatus")
    labels = entities.labels_from_flags({"Large": F.col("o_totalprice") > 200000, "Done": status == "F"})
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.array_join(labels, ",").alias("labels"),
        entities.type_from_flags({"FILLED": status == "F", "OPEN": status == "O"}).alias("type"),
    )


@query(
    "sql_functions",
    """
    SELECT p_partkey AS k, CAST(octet_length(encode(p_name)) + octet_length(encode(p_brand)) AS INTEGER) AS bytes,
        p_type = 'PROMO' AS promo FROM part
    """,
)
def sql_functions(spark, folder):
    """Functions registered for SQL text, called from it."""
    structs.register_sql_functions(spark)
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS k",
        "sum_list_string_length(array(p_name, p_brand)) AS bytes",
        "array_contains_text(array('PROMO', p_name), p_type) AS promo",
    )


@query(
    "array_struct_sort",
    """
    SELECT p_partkey AS k, CASE WHEN p_size <= 25 THEN p_size || ',25' ELSE '25,' || p_size END AS sizes FROM part
    """,
)
def array_struct_sort(spark, folder):
    pair = F.array(
        F.struct(F.lit("z").alias("name"), F.lit(25).alias("size")),
        F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")),
    )
    ordered = structs.array_struct_sort(pair, "size")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("k"),
        F.array_join(F.transform(structs.field_of_each(ordered, "size"), lambda s: s.cast("string")), ",").alias("sizes"),
    )


@query(
    "struct_diff",
    """
    SELECT o_orderkey AS k, nullif(concat_ws(',', CASE WHEN o_orderstatus <> 'F' THEN 'status=F' END,
        CASE WHEN o_orderpriority <> '1-URGENT' THEN 'priority=1-URGENT' END), '') AS changed FROM orders
    """,
)
def struct_diff(spark, folder):
    orders = table(spark, folder, "orders")
    held = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    wanted = F.struct(F.lit("F").alias("status"), F.lit("1-URGENT").alias("priority"))
    changed = structs.struct_diff(orders, held, wanted)
    text = F.transform(changed, lambda c: F.concat(c["field"], F.lit("="), c["value"]))
    return orders.select(F.col("o_orderkey").alias("k"), F.array_join(text, ",").alias("changed"))


@query(
    "generated_values",
    "SELECT count(*) AS n, count(*) AS n_ids, count(*) AS n_in_range, count(*) AS n_timed, count(*) AS n_dated FROM orders",
)
def generated_values(spark, folder):
    """Generated ids differ, random numbers lie between 0 and 1, and there is a time and a date."""
    made = table(spark, folder, "orders").select(
        generated_id().alias("id"),
        numeric.rand().alias("x"),
        temporal.timestamp().alias("seconds"),
        temporal.date().alias("today"),
        temporal.local_datetime().alias("now"),
    )
    return agg.group(
        made,
        n=agg.count_all(),
        n_ids=agg.count_distinct(F.col("id")),
        n_in_range=F.count_if((F.col("x") >= 0) & (F.col("x") < 1)),
        n_timed=F.count_if(F.col("seconds") == F.unix_timestamp("now")),
        n_dated=F.count_if(F.col("today") == F.to_date("now")),
    )


@query(
    "registered_function",
    "SELECT p_partkey AS k, reverse(upper(p_name)) AS turned FROM part WHERE reverse(upper(p_name)) > 'M'",
)
def registered_function(spark, folder):
    """A user's own function in SQL text: vectorized, over a whole table."""

    @F.pandas_udf("string")
    def turned(texts: pd.Series) -> pd.Series:
        return texts.str.upper().str[::-1]

    structs.register_function(spark, "turned", turned)
    table(spark, folder, "part").createOrReplaceTempView("parts_to_turn")
    return spark.sql("SELECT p_partkey AS k, turned(p_name) AS turned FROM parts_to_turn WHERE turned(p_name) > 'M'")
