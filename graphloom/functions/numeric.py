"""Numbers: arithmetic, roots, trigonometry, bits, conversions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphTypeError
from graphloom.functions import temporal

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_INTEGERS, T.FloatType, T.DoubleType, T.DecimalType)


def _types(df: DataFrame, *columns: Column) -> list[T.DataType]:
    schema = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).schema
    return [f.dataType for f in schema.fields]


def plus(df: DataFrame, left: Column, right: Column) -> Column:
    """`+` by the types the operands have in `df`: numbers add, texts concatenate with texts and
    numbers, a date moves by a duration. Lists are refused."""
    left_type, right_type = _types(df, left, right)
    if isinstance(left_type, T.ArrayType) or isinstance(right_type, T.ArrayType):
        raise GraphTypeError("lists cannot be concatenated with +")
    text, number = (T.StringType,), _NUMBERS
    if (isinstance(left_type, text) and isinstance(right_type, (*text, *number))) or (
        isinstance(right_type, text) and isinstance(left_type, number)
    ):
        return F.concat(left.cast("string"), right.cast("string"))
    if isinstance(left_type, T.DateType) and temporal.is_duration(right_type):
        return temporal.date_plus(left, right)
    return left + right


def minus(df: DataFrame, left: Column, right: Column) -> Column:
    """`-`: numbers subtract, a date moves back by a duration."""
    left_type, right_type = _types(df, left, right)
    if isinstance(left_type, T.DateType) and temporal.is_duration(right_type):
        return temporal.date_minus(left, right)
    return left - right


def times(left: Column, right: Column) -> Column:
    return left * right


def divide(df: DataFrame, left: Column, right: Column) -> Column:
    """`/`: two integers give an integer, cut toward zero; division by zero gives null."""
    if all(isinstance(t, _INTEGERS) for t in _types(df, left, right)):
        return divide_integers(left, right)
    return F.try_divide(left, right)


def divide_integers(left: Column, right: Column) -> Column:
    """Integer quotient cut toward zero, null for a zero divisor."""
    return F.call_function("div", left.cast("long"), F.nullif(right.cast("long"), F.lit(0).cast("long")))


def remainder(left: Column, right: Column) -> Column:
    """Remainder with the sign of the dividend, null for a zero divisor."""
    return left % F.nullif(right, F.lit(0).cast("long"))


def e() -> Column:
    return F.lit(math.e)


def pi() -> Column:
    return F.lit(math.pi)


def sqrt(value: Column) -> Column:
    return F.sqrt(value)


def log(value: Column) -> Column:
    return F.ln(value)


def log10(value: Column) -> Column:
    return F.log10(value)


def exp(value: Column) -> Column:
    return F.exp(value)


def abs_(value: Column) -> Column:
    return F.abs(value)


def ceil(value: Column) -> Column:
    return F.ceil(value).cast("double")


def floor(value: Column) -> Column:
    return F.floor(value).cast("double")


def round_(value: Column) -> Column:
    """Nearest whole number, halves away from zero."""
    return F.round(value).cast("double")


def sign(value: Column) -> Column:
    return F.signum(value).cast("int")


def rand(seed: int | None = None) -> Column:
    return F.rand() if seed is None else F.rand(seed)


def acos(value: Column) -> Column:
    return F.acos(value)


def asin(value: Column) -> Column:
    return F.asin(value)


def atan(value: Column) -> Column:
    return F.atan(value)


def atan2(y: Column, x: Column) -> Column:
    return F.atan2(y, x)


def cos(value: Column) -> Column:
    return F.cos(value)


def cot(value: Column) -> Column:
    return F.cot(value)


def sin(value: Column) -> Column:
    return F.sin(value)


def tan(value: Column) -> Column:
    return F.tan(value)


def degrees(value: Column) -> Column:
    return F.degrees(value)


def radians(value: Column) -> Column:
    return F.radians(value)


def haversin(value: Column) -> Column:
    return (F.lit(1.0) - F.cos(value)) / F.lit(2.0)


def bit_and(left: Column, right: Column) -> Column:
    return left.bitwiseAND(right)


def bit_or(left: Column, right: Column) -> Column:
    return left.bitwiseOR(right)


def shift_left(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits)


def shift_right_unsigned(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, bits)


def to_float(value: Column) -> Column:
    """Null for what is no number."""
    return value.try_cast("double")


def to_integer(value: Column) -> Column:
    return value.try_cast("long")


def to_string(value: Column) -> Column:
    return value.cast("string")


def to_boolean(value: Column) -> Column:
    return value.try_cast("boolean")
