"""Descriptors of attribute values and the Spark types behind them."""

from __future__ import annotations

from pyspark.sql import types as T

from ..errors import ValidationError

# Spark type that stores each descriptor.
SPARK_TYPES: dict[str, T.DataType] = {
    "S": T.StringType(),
    "N": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "B": T.BinaryType(),
    "SS": T.ArrayType(T.StringType()),
    "NS": T.ArrayType(T.DoubleType()),
    "BS": T.ArrayType(T.BinaryType()),
    "L": T.VariantType(),
    "M": T.VariantType(),
    "NULL": T.StringType(),
}
# SQL type name recorded in the metadata rows; anything unknown is text.
STORED_TYPES: dict[str, str] = {
    "S": "STRING(MAX)",
    "N": "FLOAT64",
    "BOOL": "BOOL",
    "B": "BYTES(MAX)",
    "SS": "ARRAY<STRING(MAX)>",
    "NS": "ARRAY<FLOAT64>",
    "BS": "ARRAY<BYTES(MAX)>",
    "L": "JSON",
    "M": "JSON",
    "NULL": "NULL",
}
SET_DESCRIPTORS = ("SS", "NS", "BS")


def spark_type(descriptor: str) -> T.DataType:
    return SPARK_TYPES.get(descriptor, T.StringType())


def stored_type(descriptor: str) -> str:
    return STORED_TYPES.get(descriptor, STORED_TYPES["S"])


def descriptor_of(kind: T.DataType) -> str:
    """Descriptor a column of this type is written with; arrays of scalars are sets."""
    if isinstance(kind, T.NumericType):
        return "N"
    if isinstance(kind, T.BooleanType):
        return "BOOL"
    if isinstance(kind, T.BinaryType):
        return "B"
    if isinstance(kind, T.ArrayType):
        element = descriptor_of(kind.elementType)
        return {"S": "SS", "N": "NS", "B": "BS"}.get(element, "L")
    if isinstance(kind, (T.StructType, T.MapType)):
        return "M"
    if isinstance(kind, T.VariantType):
        return "M"
    if isinstance(kind, T.NullType):
        return "NULL"
    if isinstance(kind, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "S"
    raise ValidationError(f"no descriptor for a column of type {kind.simpleString()}")


def loose(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed at every level, as results of casts and unions have it."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(loose(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, loose(kind.valueType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, loose(f.dataType), True) for f in kind.fields])
    return kind
