"""Logical column types and the Spark types that hold them."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Logical type names and the Spark type of each.
SPARK_TYPES: dict[str, T.DataType] = {
    "Bool": T.BooleanType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Uint8": T.ShortType(),
    "Uint16": T.IntegerType(),
    "Uint32": T.LongType(),
    "Uint64": T.DecimalType(22, 0),
    "Float": T.FloatType(),
    "Double": T.DoubleType(),
    "Bytes": T.BinaryType(),
    "Text": T.StringType(),
    "Json": T.StringType(),
    "JsonDocument": T.StringType(),
    "Yson": T.StringType(),
    "Uuid": T.StringType(),
    "Date": T.DateType(),
    "Date32": T.DateType(),
    "TzDate": T.DateType(),
    "Datetime": T.TimestampNTZType(),
    "Datetime64": T.TimestampNTZType(),
    "TzDatetime": T.TimestampNTZType(),
    "Timestamp": T.TimestampNTZType(),
    "Timestamp64": T.TimestampNTZType(),
    "TzTimestamp": T.TimestampNTZType(),
    "Interval": T.DayTimeIntervalType(),
    "Interval64": T.DayTimeIntervalType(),
    "DyNumber": T.DecimalType(38, 10),
}
# Largest value of each unsigned type.
UNSIGNED_MAX = {"Uint8": 2**8 - 1, "Uint16": 2**16 - 1, "Uint32": 2**32 - 1, "Uint64": 2**64 - 1}

_DECIMAL = re.compile(r"Decimal\((\d+), *(\d+)\)")


def spark_type(logical: str) -> T.DataType:
    """Spark type that holds a logical type."""
    parts = _DECIMAL.fullmatch(logical)
    if parts:
        return T.DecimalType(int(parts[1]), int(parts[2]))
    if logical not in SPARK_TYPES:
        raise ValueError(f"unknown logical type {logical!r}")
    return SPARK_TYPES[logical]


def logical_type(dtype: T.DataType, signed_dates: bool = True) -> str:
    """Logical type of a new column; nested types have none. Unsigned types are only ever declared."""
    if isinstance(dtype, T.DecimalType):
        return "Int64" if dtype.scale == 0 and dtype.precision <= 21 else f"Decimal({dtype.precision},{dtype.scale})"
    plain = {
        T.BooleanType: "Bool",
        T.ByteType: "Int8",
        T.ShortType: "Int16",
        T.IntegerType: "Int32",
        T.LongType: "Int64",
        T.FloatType: "Float",
        T.DoubleType: "Double",
        T.BinaryType: "Bytes",
        T.StringType: "Text",
        T.VarcharType: "Text",
        T.CharType: "Text",
        T.DateType: "Date32" if signed_dates else "Date",
        T.TimestampType: "Timestamp64" if signed_dates else "Timestamp",
        T.TimestampNTZType: "Timestamp64" if signed_dates else "Timestamp",
        T.DayTimeIntervalType: "Interval64" if signed_dates else "Interval",
    }
    if type(dtype) not in plain:
        raise ValueError(f"no logical type for {dtype.simpleString()}")
    return plain[type(dtype)]


def declare(name: str, logical: str, nullable: bool = True) -> T.StructField:
    """A column with a declared logical type."""
    return T.StructField(name, spark_type(logical), nullable, {"logical": logical})


def new_table_schema(schema: T.StructType, signed_dates: bool = True) -> T.StructType:
    """Types of a table made from a DataFrame: whole decimals of up to 21 digits become 64-bit integers (too large a
    value is an error), and without ``signed_dates`` dates and timestamps before 1970 are refused."""
    fields = []
    for f in schema:
        declared = (f.metadata or {}).get("logical")
        whole = isinstance(f.dataType, T.DecimalType) and logical_type(f.dataType) == "Int64"
        dated = isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) and not signed_dates
        if declared or whole or dated:
            fields.append(declare(f.name, declared or logical_type(f.dataType, signed_dates), f.nullable))
        else:
            fields.append(T.StructField(f.name, f.dataType, f.nullable))
    return T.StructType(fields)
