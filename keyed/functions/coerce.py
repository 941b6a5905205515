"""Bring columns to declared types where rows are written, with native expressions only.

A value that does not fit stops the job, or becomes null with ``on_error="null"``. ``strict`` refuses any cast up front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import UNSIGNED_MAX, spark_type

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def coerce(df: DataFrame, schema: T.StructType, strict: bool = False, on_error: str = "raise") -> DataFrame:
    """The columns of ``schema`` in its order, each brought to its type."""
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} are missing")
    if strict:
        wrong = [
            f"{f.name}: {df.schema[f.name].dataType.simpleString()} is not {f.dataType.simpleString()}"
            for f in schema
            if df.schema[f.name].dataType != f.dataType
        ]
        if wrong:
            raise TypeError("strict write refuses casts: " + "; ".join(wrong))
    columns = []
    for f in schema:
        source, logical = df.schema[f.name].dataType, (f.metadata or {}).get("logical")
        if logical:
            columns.append(coerce_column(F.col(f.name), source, logical, on_error).alias(f.name, metadata=f.metadata))
        elif source == f.dataType:
            columns.append(F.col(f.name))
        else:
            columns.append(_plain(F.col(f.name), source, f.dataType, on_error).alias(f.name))
    return df.select(*columns)


def coerce_column(c: Column, source: T.DataType, logical: str, on_error: str = "raise") -> Column:
    """One column to a logical type."""
    target = spark_type(logical)
    if logical in UNSIGNED_MAX:
        return _unsigned(c, source, target, logical, on_error)
    if logical == "Bool":
        return _bool(c, source)
    if logical in ("Date", "Date32"):
        return _guard(_date(c, source, on_error), F.lit("1970-01-01").cast("date"), logical == "Date", logical, on_error)
    if logical in ("Datetime", "Datetime64", "Timestamp", "Timestamp64"):
        whole = logical.startswith("Datetime")
        found = _timestamp(c, source, zoned=not whole, on_error=on_error)
        found = F.date_trunc("second", found).cast(T.TimestampNTZType()) if whole else found
        return _guard(found, _epoch(), not logical.endswith("64"), logical, on_error)
    if isinstance(target, T.StringType):
        return _text(c, source, logical)
    if isinstance(target, T.BinaryType):
        return _bytes(c, source)
    return _plain(c, source, target, on_error)


def valid_json(c: Column) -> Column:
    """Whether text is JSON; writes themselves do not check it."""
    return F.try_parse_json(c).isNotNull()


def _refuse(source: T.DataType, target: str):
    raise TypeError(f"cannot bring {source.simpleString()} to {target}")


def _cast(c: Column, target: T.DataType, on_error: str) -> Column:
    return c.try_cast(target) if on_error == "null" else c.cast(target)


def _plain(c: Column, source: T.DataType, target: T.DataType, on_error: str) -> Column:
    if source == target:
        return c
    if isinstance(target, T.BooleanType):
        return _bool(c, source)
    if isinstance(target, T.StringType):
        return _text(c, source, "Text")
    if isinstance(target, T.BinaryType):
        return _bytes(c, source)
    if isinstance(target, T.DateType):
        return _date(c, source, on_error)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)) and isinstance(source, _INTEGERS):
        return F.timestamp_micros(c.cast("bigint")) if isinstance(target, T.TimestampType) else from_micros(c.cast("bigint"))
    numeric = isinstance(target, T.NumericType)
    if numeric and not isinstance(source, (T.NumericType, T.StringType)):
        _refuse(source, target.simpleString())
    return _cast(c, target, on_error)


def _bool(c: Column, source: T.DataType) -> Column:
    """Numbers are true when their whole part is not zero; text is true only for the word "true" in any case."""
    if isinstance(source, T.BooleanType):
        return c
    if isinstance(source, _INTEGERS):
        return c != 0
    if isinstance(source, _FRACTIONS):
        return ~F.isnan(c) & (F.abs(c) >= 1)
    if isinstance(source, T.DecimalType):
        return F.abs(c) >= 1
    if isinstance(source, T.StringType):
        return F.lower(c) == "true"
    return _refuse(source, "Bool")


def _unsigned(c: Column, source: T.DataType, target: T.DataType, logical: str, on_error: str) -> Column:
    """Widened, then held to 0 .. 2^bits - 1."""
    if not isinstance(source, (T.NumericType, T.StringType)):
        _refuse(source, logical)
    wide = _cast(c, T.DecimalType(22, 0) if logical == "Uint64" else T.LongType(), on_error)
    fits = wide.between(F.lit(0), F.lit(str(UNSIGNED_MAX[logical])).cast(T.DecimalType(22, 0)))
    return F.when(wide.isNull() | fits, _cast(wide, target, on_error)).otherwise(_failure(logical, on_error))


def _failure(logical: str, on_error: str) -> Column:
    return F.lit(None) if on_error == "null" else F.raise_error(F.lit(f"value out of range for {logical}"))


def _guard(c: Column, lowest: Column, guarded: bool, logical: str, on_error: str) -> Column:
    if not guarded:
        return c
    return F.when(c.isNull() | (c >= lowest), c).otherwise(_failure(logical, on_error))


def _text(c: Column, source: T.DataType, logical: str) -> Column:
    if isinstance(source, T.StringType):
        return c
    if isinstance(source, T.BinaryType):
        return F.decode(c, "UTF-8")
    return _refuse(source, logical)


def _bytes(c: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BinaryType):
        return c
    if isinstance(source, T.StringType):
        return F.encode(c, "UTF-8")
    return _refuse(source, "Bytes")


def _date(c: Column, source: T.DataType, on_error: str) -> Column:
    """A date, a number of days since 1970-01-01, or ISO text."""
    if isinstance(source, T.DateType):
        return c
    if isinstance(source, _INTEGERS):
        return F.date_from_unix_date(_cast(c, T.IntegerType(), on_error))
    if isinstance(source, T.StringType):
        return _cast(c, T.DateType(), on_error)
    return _refuse(source, "Date")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def from_micros(c: Column) -> Column:
    """UTC time without zone from microseconds since 1970, whatever the session time zone is."""
    return F.timestamp_add("MICROSECOND", c, _epoch())


def _timestamp(c: Column, source: T.DataType, zoned: bool, on_error: str) -> Column:
    """A timestamp, microseconds since 1970, or ISO text: local text for whole seconds, text with a zone otherwise."""
    if isinstance(source, T.TimestampNTZType):
        return c
    if isinstance(source, T.TimestampType):
        return from_micros(F.unix_micros(c))
    if isinstance(source, _INTEGERS):
        return from_micros(c.cast("bigint"))
    if isinstance(source, T.StringType):
        if zoned:
            return from_micros(F.unix_micros(_cast(c, T.TimestampType(), on_error)))
        return _cast(c, T.TimestampNTZType(), on_error)
    return _refuse(source, "Timestamp")
