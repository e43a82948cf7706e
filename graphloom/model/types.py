"""Property types and their Spark counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphTypeError

# Names of property types in stored graph schemas.
SPARK_TYPE_BY_NAME = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "LOCALDATETIME": T.TimestampType(),
    "IDENTITY": T.BinaryType(),
    "VOID": T.NullType(),
}

# Java class names found in the `type` field of document properties.
SPARK_TYPE_BY_JAVA_CLASS = {
    "java.lang.String": T.StringType(),
    "java.lang.Long": T.LongType(),
    "java.lang.Double": T.DoubleType(),
    "java.lang.Float": T.FloatType(),
    "java.lang.Integer": T.IntegerType(),
    "java.lang.Short": T.ShortType(),
    "java.lang.Boolean": T.BooleanType(),
    "java.lang.Byte": T.ByteType(),
    "java.sql.Timestamp": T.TimestampType(),
    "java.sql.Date": T.DateType(),
}

_WIDER = {
    T.ByteType(): T.LongType(),
    T.ShortType(): T.LongType(),
    T.IntegerType(): T.LongType(),
    T.FloatType(): T.DoubleType(),
}
_ATOMIC = (
    T.StringType,
    T.LongType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BinaryType,
    T.NullType,
    T.DecimalType,
    T.CalendarIntervalType,
)


def java_class_type(name: str | None) -> T.DataType:
    """Spark type of a document property; an unknown class reads as a string."""
    return SPARK_TYPE_BY_JAVA_CLASS.get(name or "", T.StringType())


def java_class_name(data_type: T.DataType) -> str:
    """Class name under which a value of this Spark type is kept in a document."""
    for name, spark_type in SPARK_TYPE_BY_JAVA_CLASS.items():
        if spark_type == data_type:
            return name
    return "java.lang.String"


def widened(data_type: T.DataType, where: str = "value") -> T.DataType:
    """The graph type a Spark type is stored as: small numbers widen, nested types recurse."""
    if data_type in _WIDER:
        return _WIDER[data_type]
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(widened(data_type.elementType, where), data_type.containsNull)
    if isinstance(data_type, T.MapType):
        return T.MapType(
            widened(data_type.keyType, where), widened(data_type.valueType, where), data_type.valueContainsNull
        )
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, widened(f.dataType, f"{where}.{f.name}"), f.nullable) for f in data_type.fields]
        )
    if isinstance(data_type, _ATOMIC):
        return data_type
    raise GraphTypeError(f"{where}: {data_type.simpleString()} has no place in a property graph")


def normalize_types(df: DataFrame) -> DataFrame:
    """Cast every column to its graph type. Columns that already fit are left as they are."""

    def fitted(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        target = widened(field.dataType, field.name)
        return column if target == field.dataType else column.cast(target).alias(field.name)

    fields = df.schema.fields
    if all(widened(f.dataType, f.name) == f.dataType for f in fields):
        return df
    return df.select([fitted(f) for f in fields])


def type_name(data_type: T.DataType) -> str:
    """Name of a property type in a stored schema."""
    data_type = widened(data_type)
    for name, spark_type in SPARK_TYPE_BY_NAME.items():
        if spark_type == data_type:
            return name
    if isinstance(data_type, T.ArrayType):
        return f"LIST<{type_name(data_type.elementType)}>"
    return data_type.simpleString()


def parse_type_name(name: str) -> T.DataType:
    """Spark type for a stored type name; a trailing `?` only marks nullability."""
    bare = name.strip().rstrip("?")
    if bare.upper() in SPARK_TYPE_BY_NAME:
        return SPARK_TYPE_BY_NAME[bare.upper()]
    if bare.upper().startswith("LIST<") or bare.upper().startswith("LIST("):
        return T.ArrayType(parse_type_name(bare[5:-1]))
    return T.DataType.fromDDL(bare)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """Type both can be stored as in one column, or None."""
    left, right = widened(left), widened(right)
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    numbers = {T.LongType(), T.DoubleType()}
    if {left, right} <= numbers:
        return T.DoubleType()
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        element = common_type(left.elementType, right.elementType)
        return None if element is None else T.ArrayType(element)
    return None


def is_subtype(actual: T.DataType, expected: T.DataType) -> bool:
    """Whether values of `actual` may stand in a column declared as `expected`."""
    return common_type(actual, expected) == widened(expected)
