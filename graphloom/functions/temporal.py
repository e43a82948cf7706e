"""Dates, local date-times and durations.

A duration is a struct `{months, days, micros}`: unlike Spark's interval it can be written to files
and collected. As in the interval arithmetic it stands for, whole days within `micros` count as days.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphTypeError

DURATION = T.StructType(
    [
        T.StructField("months", T.LongType()),
        T.StructField("days", T.LongType()),
        T.StructField("micros", T.LongType()),
    ]
)


def is_duration(data_type: T.DataType) -> bool:
    return data_type.simpleString() == DURATION.simpleString()


MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

# Parts of a duration, as (unit it is kept in, size in that unit).
DURATION_PARTS = {
    "years": ("months", 12),
    "quarters": ("months", 3),
    "months": ("months", 1),
    "weeks": ("days", 7),
    "days": ("days", 1),
    "hours": ("micros", MICROS_PER_HOUR),
    "minutes": ("micros", MICROS_PER_MINUTE),
    "seconds": ("micros", MICROS_PER_SECOND),
    "milliseconds": ("micros", 1_000),
    "microseconds": ("micros", 1),
}

Part = int | str | Column


def _int(value: Part) -> Column:
    return value.cast("int") if isinstance(value, Column) else F.lit(int(value))


def _long(value: Part) -> Column:
    return value.cast("long") if isinstance(value, Column) else F.lit(int(value)).cast("long")


def _div(value: Column, by: int) -> Column:
    """Integer quotient, cut toward zero."""
    return F.call_function("div", value, F.lit(by).cast("long"))


def _parts(value: Mapping[str, Part], known: set[str]) -> dict[str, Part]:
    parts = {k.lower(): v for k, v in value.items()}
    unknown = sorted(set(parts) - known)
    if unknown:
        raise GraphTypeError(f"unknown part(s) {unknown}")
    return parts


# -- dates and date-times -------------------------------------------------------------------------

_DATE_PARTS = {"year", "month", "day", "week", "dayofweek", "quarter", "dayofquarter", "ordinalday"}
_TIME_PARTS = {"hour", "minute", "second", "millisecond", "microsecond", "nanosecond"}
_DATE_TEXT = re.compile(
    r"(?P<year>\d{4})"
    r"(?:-?W(?P<week>\d{2})(?:-?(?P<dayofweek>\d))?"
    r"|-?Q(?P<quarter>\d)(?:-?(?P<dayofquarter>\d{2}))?"
    r"|-(?P<ordinalday>\d{3})|(?P<ordinalday2>\d{3})"
    r"|-(?P<month>\d{2})(?:-(?P<day>\d{2}))?|(?P<month2>\d{2})(?P<day2>\d{2})|(?P<month3>\d{2}))?$"
)
_TIME_TEXT = re.compile(
    r"(?P<hour>\d{2})(?::?(?P<minute>\d{2})(?::?(?P<second>\d{2})(?:\.(?P<fraction>\d{1,9}))?)?)?$"
)


def _date_parts(text: str) -> dict[str, int]:
    found = _DATE_TEXT.match(text.strip())
    if not found:
        raise GraphTypeError(f"'{text}' is no date")
    return {k.rstrip("23"): int(v) for k, v in found.groupdict().items() if v is not None}


def _time_parts(text: str) -> dict[str, int]:
    found = _TIME_TEXT.match(text.strip())
    if not found:
        raise GraphTypeError(f"'{text}' is no time")
    parts = {k: v for k, v in found.groupdict().items() if v is not None}
    nanos = int(parts.pop("fraction", "").ljust(9, "0") or 0)
    if nanos % 1_000:
        raise GraphTypeError("times are kept in microseconds; nanoseconds do not fit")
    return {**{k: int(v) for k, v in parts.items()}, "microsecond": nanos // 1_000}


def _date_from(parts: Mapping[str, Part]) -> Column:
    year = _int(parts["year"])
    if "week" in parts:
        # ISO week 1 holds 4 January; its Monday starts the count
        first_monday = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
        days = (_int(parts["week"]) - 1) * 7 + _int(parts.get("dayofweek", 1)) - 1
        return F.date_add(first_monday, days)
    if "quarter" in parts:
        first = F.make_date(year, (_int(parts["quarter"]) - 1) * 3 + 1, F.lit(1))
        return F.date_add(first, _int(parts.get("dayofquarter", 1)) - 1)
    if "ordinalday" in parts:
        return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), _int(parts["ordinalday"]) - 1)
    return F.make_date(year, _int(parts.get("month", 1)), _int(parts.get("day", 1)))


def date(value: str | Mapping[str, Part] | Column | None = ...) -> Column:
    """Date from ISO text, from parts, or from a text column; today without an argument.

    Parts are year with month and day, week and dayOfWeek, quarter and dayOfQuarter, or ordinalDay.
    """
    if value is ...:
        return F.current_date()
    if value is None:
        return F.lit(None).cast("date")
    if isinstance(value, Column):
        return value.try_cast("date")
    if isinstance(value, str):
        return _date_from(_date_parts(value))
    return _date_from(_parts(value, _DATE_PARTS))


def local_datetime(value: str | Mapping[str, Part] | Column | None = ...) -> Column:
    """Date-time from ISO text, from date and time parts, or from a text column; now without an
    argument. Anything finer than a microsecond is refused."""
    if value is ...:
        return F.current_timestamp()
    if value is None:
        return F.lit(None).cast("timestamp")
    if isinstance(value, Column):
        return value.try_cast("timestamp")
    if isinstance(value, str):
        day, _, time = value.strip().partition("T")
        parts: dict[str, Part] = {**_date_parts(day), **(_time_parts(time) if time else {})}
    else:
        parts = _parts(value, _DATE_PARTS | _TIME_PARTS)
    nanos = parts.get("nanosecond", 0)
    if isinstance(nanos, Column) or int(nanos) % 1_000:
        raise GraphTypeError("times are kept in microseconds; nanoseconds do not fit")
    day = _date_from(parts)
    micros = (
        _long(parts.get("millisecond", 0)) * 1_000 + _long(parts.get("microsecond", 0)) + F.lit(int(nanos) // 1_000)
    )
    seconds = _long(parts.get("second", 0)) + micros / F.lit(1_000_000.0)
    return F.make_timestamp(
        F.year(day), F.month(day), F.dayofmonth(day), _int(parts.get("hour", 0)), _int(parts.get("minute", 0)),
        seconds.cast("decimal(16,6)"),
    )


def timestamp() -> Column:
    """Seconds since the epoch, now."""
    return F.current_timestamp().cast("long")


_ACCESSORS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "week": F.weekofyear,
    "day": F.dayofmonth,
    "ordinalday": F.dayofyear,
    "weekyear": lambda c: F.extract(F.lit("YEAROFWEEK"), c),
    "dayofquarter": lambda c: F.datediff(c.cast("date"), F.trunc(c.cast("date"), "quarter")) + 1,
    "dayofweek": lambda c: F.weekday(c) + 1,
    "weekday": lambda c: F.weekday(c) + 1,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "millisecond": lambda c: _div(_micros_of_second(c), 1_000),
    "microsecond": lambda c: _micros_of_second(c),
}


def _micros_of_second(moment: Column) -> Column:
    fraction = F.extract(F.lit("SECOND"), moment)
    return ((fraction - F.floor(fraction)) * F.lit(1_000_000)).cast("long")


def accessor(value: Column, name: str) -> Column:
    """Component of a date or date-time: year, quarter, month, week, day, ordinalDay, weekYear,
    dayOfQuarter, dayOfWeek, hour, minute, second, millisecond, microsecond. Weeks are ISO weeks."""
    if name.lower() not in _ACCESSORS:
        raise GraphTypeError(f"dates have no '{name}'")
    return _ACCESSORS[name.lower()](value).cast("long")


# -- durations ------------------------------------------------------------------------------------

_DURATION_TEXT = re.compile(
    r"P(?:(?P<years>-?\d+)Y)?(?:(?P<months>-?\d+)M)?(?:(?P<weeks>-?\d+)W)?(?:(?P<days>-?\d+)D)?"
    r"(?:T(?:(?P<hours>-?\d+)H)?(?:(?P<minutes>-?\d+)M)?(?:(?P<sign>-)?(?P<seconds>\d+)(?:\.(?P<fraction>\d{1,9}))?S)?)?$"
)


def duration(value: str | Mapping[str, Part] | None) -> Column:
    """Duration from ISO text such as `P1Y2M10DT2H30M`, or from parts such as `{'months': 5}`."""
    if value is None:
        return F.lit(None).cast(DURATION)
    if isinstance(value, str):
        found = _DURATION_TEXT.match(value.strip())
        if not found or value.strip() in ("P", "PT"):
            raise GraphTypeError(f"'{value}' is no duration")
        parts: dict[str, Part] = {k: v for k, v in found.groupdict().items() if v is not None}
        sign = -1 if parts.pop("sign", None) else 1
        fraction = str(parts.pop("fraction", ""))
        if "seconds" in parts:
            parts["seconds"] = sign * int(parts["seconds"])
        if fraction:
            parts["microseconds"] = sign * (int(fraction.ljust(9, "0")) // 1_000)
    else:
        parts = _parts(value, set(DURATION_PARTS))
    units: dict[str, Column] = {u: F.lit(0).cast("long") for u in ("months", "days", "micros")}
    for name, amount in parts.items():
        unit, size = DURATION_PARTS[name]
        units[unit] = units[unit] + _long(amount) * F.lit(size).cast("long")
    return F.struct(*[units[u].alias(u) for u in ("months", "days", "micros")])


def to_interval(value: Column) -> Column:
    """The duration as a Spark interval, for arithmetic with timestamps."""
    seconds = (value["micros"] / F.lit(1_000_000)).cast("decimal(18,6)")
    interval = F.make_interval(months=value["months"].cast("int"), days=value["days"].cast("int"), secs=seconds)
    return F.when(value.isNotNull(), interval)


def _all_days(value: Column) -> Column:
    return value["days"] + _div(value["micros"], MICROS_PER_DAY)


def _below_day(value: Column) -> Column:
    return value["micros"] - _div(value["micros"], MICROS_PER_DAY) * F.lit(MICROS_PER_DAY)


def date_plus(day: Column, value: Column) -> Column:
    """Date moved by a duration: months first, kept within the month reached, then whole days."""
    return F.date_add(F.add_months(day, value["months"].cast("int")), _all_days(value).cast("int"))


def date_minus(day: Column, value: Column) -> Column:
    return F.date_sub(F.add_months(day, (-value["months"]).cast("int")), _all_days(value).cast("int"))


_TOTALS = {"months": lambda d: d["months"], "days": _all_days, "micros": _below_day}


def duration_accessor(value: Column, name: str) -> Column:
    """Component of a duration: a part such as `hours`, or one within the next larger, such as `minutesOfHour`. Months,
    days and what is below a day are separate groups: hours, for one, leave out whole days."""
    part, of, whole = name.lower().partition("of")
    unit, size = DURATION_PARTS.get(part, (None, None))
    whole_unit, whole_size = DURATION_PARTS.get(f"{whole}s", (None, None))
    if unit is None or (of and (whole_unit != unit or whole_size <= size)):
        raise GraphTypeError(f"durations have no '{name}'")
    total = _div(_TOTALS[unit](value), size)
    return (total % (whole_size // size) if of else total).cast("long")
