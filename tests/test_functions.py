from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from graphloom.errors import GraphTypeError
from graphloom.functions import entities, lists, numeric, predicates, strings, temporal


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(one, column):
    return one.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2020-02-29", dt.date(2020, 2, 29)),
        ("20200229", dt.date(2020, 2, 29)),
        ("2020-02", dt.date(2020, 2, 1)),
        ("2020", dt.date(2020, 1, 1)),
        ("2020-W53-4", dt.date(2020, 12, 31)),
        ("2020-Q2-30", dt.date(2020, 4, 30)),
        ("2020-060", dt.date(2020, 2, 29)),
    ],
)
def test_dates_from_text(one, text, expected):
    assert value(one, temporal.date(text)) == expected


def test_dates_from_parts(one):
    assert value(one, temporal.date({"year": 2021, "week": 1, "dayOfWeek": 1})) == dt.date(2021, 1, 4)
    assert value(one, temporal.date({"year": 2021, "quarter": 3})) == dt.date(2021, 7, 1)
    assert value(one, temporal.date({"year": 2021, "ordinalDay": 365})) == dt.date(2021, 12, 31)
    assert value(one, temporal.date(None)) is None
    assert value(one, temporal.date(F.lit("no date"))) is None
    assert isinstance(value(one, temporal.date()), dt.date)
    for wrong in ("2020-13x", "yesterday"):
        with pytest.raises(GraphTypeError):
            temporal.date(wrong)
    with pytest.raises(GraphTypeError):
        temporal.date({"year": 2020, "moon": 1})


def test_date_times(one):
    assert value(one, temporal.local_datetime("2020-01-02T03:04:05.123456")) == dt.datetime(2020, 1, 2, 3, 4, 5, 123456)
    assert value(one, temporal.local_datetime("2020-01-02T0304")) == dt.datetime(2020, 1, 2, 3, 4)
    parts = {"year": 2020, "month": 5, "hour": 7, "second": 9, "millisecond": 10, "microsecond": 11}
    assert value(one, temporal.local_datetime(parts)) == dt.datetime(2020, 5, 1, 7, 0, 9, 10011)
    assert value(one, temporal.local_datetime(None)) is None
    for fine in ("2020-01-02T03:04:05.123456789", {"year": 2020, "nanosecond": 5}):
        with pytest.raises(GraphTypeError):
            temporal.local_datetime(fine)


def test_dates_move_by_durations(one):
    day = temporal.date("2020-01-31")
    assert value(one, temporal.date_plus(day, temporal.duration("P1M"))) == dt.date(2020, 2, 29)
    assert value(one, temporal.date_plus(day, temporal.duration("P1DT25H"))) == dt.date(2020, 2, 2)
    assert value(one, temporal.date_minus(day, temporal.duration("P2M1D"))) == dt.date(2019, 11, 29)
    assert value(one, temporal.date_plus(day, temporal.duration(None))) is None
    assert value(one, numeric.plus(one, day, temporal.duration({"weeks": 1}))) == dt.date(2020, 2, 7)
    assert value(one, numeric.minus(one, day, temporal.duration({"years": 1}))) == dt.date(2019, 1, 31)
    moved = temporal.local_datetime("2020-01-01T00:00") + temporal.to_interval(temporal.duration("P1MT90M"))
    assert value(one, moved) == dt.datetime(2020, 2, 1, 1, 30)


def test_parts_of_durations(one):
    span = temporal.duration("P1Y5M10DT49H3M4.5S")
    expected = {
        "years": 1, "quarters": 5, "months": 17, "weeks": 1, "days": 12, "hours": 1, "minutes": 63, "seconds": 3784,
        "milliseconds": 3784500, "microseconds": 3784500000, "quartersOfYear": 1, "monthsOfQuarter": 2,
        "monthsOfYear": 5, "daysOfWeek": 5, "minutesOfHour": 3, "secondsOfMinute": 4, "millisecondsOfSecond": 500,
        "microsecondsOfSecond": 500000,
    }
    got = {name: value(one, temporal.duration_accessor(span, name)) for name in expected}
    assert got == expected
    negative = temporal.duration({"hours": -25})
    assert value(one, temporal.duration_accessor(negative, "days")) == -1
    assert value(one, temporal.duration_accessor(negative, "hours")) == -1
    with pytest.raises(GraphTypeError):
        temporal.duration_accessor(span, "decades")
    for wrong in ("1Y", "P", "PT", "P1X"):
        with pytest.raises(GraphTypeError):
            temporal.duration(wrong)


def test_parts_of_dates(one):
    day = temporal.date("2021-01-03")
    got = {n: value(one, temporal.accessor(day, n)) for n in ("year", "week", "weekYear", "dayOfWeek", "dayOfQuarter", "ordinalDay")}
    assert got == {"year": 2021, "week": 53, "weekYear": 2020, "dayOfWeek": 7, "dayOfQuarter": 3, "ordinalDay": 3}
    moment = temporal.local_datetime("2020-01-02T03:04:05.123456")
    assert value(one, temporal.accessor(moment, "millisecond")) == 123
    assert value(one, temporal.accessor(moment, "microsecond")) == 123456
    with pytest.raises(GraphTypeError):
        temporal.accessor(day, "moon")
    assert value(one, temporal.timestamp()) > 1_700_000_000


def test_ranges(one):
    assert value(one, lists.range_(F.lit(1), F.lit(5), 2)) == [1, 3, 5]
    assert value(one, lists.range_(F.lit(5), F.lit(1))) == []
    assert value(one, lists.range_(F.lit(5), F.lit(1), -2)) == [5, 3, 1]
    assert value(one, lists.range_(F.lit(1), F.lit(5), -1)) == []
    assert value(one, lists.range_(F.lit(3), F.lit(3))) == [3]
    assert value(one, lists.range_(F.lit(None).cast("int"), F.lit(3))) is None
    with pytest.raises(Exception, match="step"):
        value(one, lists.range_(F.col("id"), F.lit(3), F.col("id")))


def test_lists_and_maps(one):
    texts = lists.list_literal(["a", "b"], "string")
    assert value(one, lists.at(texts, F.lit(1))) == "b"
    assert value(one, lists.at(texts, F.lit(9))) is None
    assert value(one, lists.size(lists.null_of("array<int>"))) is None
    assert value(one, lists.append(F.array(F.lit(1)), F.lit(2))) == [1, 2]
    made = lists.map_of({"k": F.lit(1), "n": lists.null_of("int")})
    assert value(one, lists.map_value(one, made, "k")) == 1
    assert value(one, lists.map_value(one, made, "x")) is None
    assert value(one, lists.map_keys(one, made)) == ["k"]
    assert value(one, lists.map_at(F.create_map(F.lit("a"), F.lit(1)), F.lit("b"))) is None
    assert one.select(lists.unwind(lists.null_of("array<int>"))).count() == 0
    nested = value(one, lists.parameter({"a": [1, 2], "b": {"c": "x"}, "d": None}))
    assert nested.asDict(recursive=True) == {"a": [1, 2], "b": {"c": "x"}, "d": None}


def test_three_valued_logic(one):
    null = lists.null_of("boolean")
    assert value(one, predicates.all_of([])) is True
    assert value(one, predicates.any_of([])) is False
    assert value(one, predicates.all_of([null, F.lit(False)])) is False
    assert value(one, predicates.any_of([null, F.lit(False)])) is None
    assert value(one, predicates.in_list(F.lit(3), F.array(F.lit(1), F.lit(None)))) is None
    assert value(one, predicates.in_list(F.lit(1), F.array(F.lit(1), F.lit(None)))) is True
    assert value(one, predicates.equals_as(F.lit("a"), F.lit(1), "bigint")) is None
    assert value(one, predicates.case([(F.lit(False), F.lit(1))])) is None
    assert value(one, predicates.case([(F.lit(False), F.lit(1))], F.lit(2))) == 2
    assert value(one, predicates.matches(F.lit("xabcx"), "a.c")) is True
    assert value(one, predicates.matches(F.lit("xabcx"), "a.c", full=True)) is False
    assert value(one, predicates.is_not_null(null)) is False


def test_arithmetic(one):
    assert value(one, numeric.divide(one, F.lit(-7), F.lit(2))) == -3
    assert value(one, numeric.divide(one, F.lit(7), F.lit(0))) is None
    assert value(one, numeric.divide(one, F.lit(7.0), F.lit(2))) == 3.5
    assert value(one, numeric.divide(one, F.lit(7.0), F.lit(0))) is None
    assert value(one, numeric.remainder(F.lit(-7), F.lit(2))) == -1
    assert value(one, numeric.remainder(F.lit(7), F.lit(0))) is None
    assert value(one, numeric.plus(one, F.lit(1), F.lit("a"))) == "1a"
    assert value(one, numeric.plus(one, F.lit("a"), F.lit("b"))) == "ab"
    assert value(one, numeric.plus(one, F.lit(1), F.lit(2))) == 3
    with pytest.raises(GraphTypeError):
        numeric.plus(one, F.array(F.lit(1)), F.lit(2))
    assert value(one, numeric.round_(F.lit(2.5))) == 3.0
    assert value(one, numeric.sign(F.lit(-2.5))) == -1
    assert value(one, numeric.shift_right_unsigned(F.lit(-1).cast("long"), 60)) == 15
    assert abs(value(one, numeric.haversin(F.lit(1.0))) - 0.22984884706593015) < 1e-12
    assert 0 <= value(one, numeric.rand(1)) < 1


def test_conversions(one):
    assert value(one, numeric.to_integer(F.lit("9000000000"))) == 9_000_000_000
    assert value(one, numeric.to_integer(F.lit("x"))) is None
    assert value(one, numeric.to_float(F.lit("x"))) is None
    assert value(one, numeric.to_boolean(F.lit("true"))) is True
    assert value(one, numeric.to_boolean(F.lit("perhaps"))) is None


def test_texts(one):
    assert value(one, strings.replace(F.lit("ba"), F.lit("ab"), F.lit("x"))) == "ba"
    assert value(one, strings.translate(F.lit("ba"), "ab", "x")) == "x"
    assert value(one, strings.substring(F.lit("hello"), F.lit(1))) == "ello"
    assert value(one, strings.substring(F.lit("hello"), F.lit(9))) == ""
    assert value(one, strings.substring(F.lit("hello"), F.lit(0), F.lit(2))) == "he"
    assert value(one, strings.size(lists.null_of("string"))) is None


def test_flags(one):
    assert value(one, entities.labels_from_flags({"B": F.lit(True), "A": F.lit(True), "C": F.lit(False)})) == ["A", "B"]
    assert value(one, entities.type_from_flags({"R": F.lit(False), "S": F.lit(True)})) == "S"
    assert value(one, entities.keys_of({})) == []
