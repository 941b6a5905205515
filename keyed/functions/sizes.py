"""Bytes of values, by type: what batches and the work of tasks are measured in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.YearMonthIntervalType: 4, T.NullType: 0}


def _fixed(dtype: T.DataType) -> int | None:
    """Bytes of every value of a type; None where they differ from value to value."""
    if isinstance(dtype, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType)):
        return None
    if isinstance(dtype, T.StructType):
        parts = [_fixed(f.dataType) for f in dtype]
        return None if None in parts else sum(parts)
    if isinstance(dtype, T.DecimalType):
        return 8 if dtype.precision <= 18 else 16
    return _FIXED.get(type(dtype), 8)


def value_bytes(value: Column, dtype: T.DataType) -> Column:
    """Bytes of one value, nested ones in full: texts and binaries by length, numbers by width, nulls 0."""
    fixed = _fixed(dtype)
    if fixed is not None:
        return F.when(value.isNull(), F.lit(0)).otherwise(F.lit(fixed)).cast("bigint")
    if isinstance(dtype, T.ArrayType):
        inner = _fixed(dtype.elementType)
        if inner is not None and not dtype.containsNull:
            size = F.size(value).cast("bigint") * inner
        else:
            size = F.aggregate(value, F.lit(0).cast("bigint"), lambda s, x: s + value_bytes(x, dtype.elementType))
    elif isinstance(dtype, T.MapType):
        sides = ((F.map_keys(value), T.ArrayType(dtype.keyType, False)), (F.map_values(value), T.ArrayType(dtype.valueType, dtype.valueContainsNull)))
        size = sum((value_bytes(v, t) for v, t in sides), F.lit(0).cast("bigint"))
    elif isinstance(dtype, T.StructType):
        size = sum((value_bytes(value[f.name], f.dataType) for f in dtype), F.lit(0).cast("bigint"))
    elif isinstance(dtype, T.VariantType):
        size = F.octet_length(F.to_json(value)).cast("bigint")
    else:
        size = F.octet_length(value).cast("bigint")
    return F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(size)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row of this schema."""
    return sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema), F.lit(0).cast("bigint"))
