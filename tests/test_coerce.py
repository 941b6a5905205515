import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import keyed as K


def one(spark, value, source, logical, on_error="raise"):
    df = spark.createDataFrame([(value,)], f"v {source}")
    schema = T.StructType([K.declare("v", logical)])
    return K.coerce(df, schema, on_error=on_error).first().v


@pytest.mark.parametrize(
    "value,source,logical,expected",
    [
        (True, "boolean", "Bool", True),
        (0.5, "double", "Bool", False),
        (-2.0, "double", "Bool", True),
        (float("nan"), "double", "Bool", False),
        (7, "int", "Bool", True),
        ("TRUE", "string", "Bool", True),
        ("yes", "string", "Bool", False),
        (127, "bigint", "Int8", 127),
        ("-5", "string", "Int32", -5),
        (3.9, "double", "Int64", 3),
        (Decimal("12.7"), "decimal(10,1)", "Int16", 12),
        (255, "int", "Uint8", 255),
        (65535, "bigint", "Uint16", 65535),
        ("4294967295", "string", "Uint32", 4294967295),
        ("18446744073709551615", "string", "Uint64", Decimal(18446744073709551615)),
        ("1.5", "string", "Double", 1.5),
        (1.005, "double", "Decimal(10,2)", Decimal("1.01")),
        ("2.345", "string", "Decimal(10,2)", Decimal("2.35")),
        (bytearray(b"h\xc3\xa9"), "binary", "Text", "hé"),
        ("hé", "string", "Bytes", bytearray(b"h\xc3\xa9")),
        ('{ "a": 1 }', "string", "Json", '{ "a": 1 }'),
        ("2025-03-05", "string", "Date", dt.date(2025, 3, 5)),
        (-3559, "int", "Date32", dt.date(1960, 4, 4)),
        (dt.date(1960, 4, 4), "date", "Date32", dt.date(1960, 4, 4)),
        (1_500_000, "bigint", "Datetime", dt.datetime(1970, 1, 1, 0, 0, 1)),
        (-1, "bigint", "Datetime64", dt.datetime(1969, 12, 31, 23, 59, 59)),
        ("2024-02-29T10:11:12", "string", "Datetime", dt.datetime(2024, 2, 29, 10, 11, 12)),
        (1_500_001, "bigint", "Timestamp", dt.datetime(1970, 1, 1, 0, 0, 1, 500001)),
        ("2024-02-29T10:11:12.000001Z", "string", "Timestamp", dt.datetime(2024, 2, 29, 10, 11, 12, 1)),
        ("2024-02-29T10:11:12+02:00", "string", "Timestamp64", dt.datetime(2024, 2, 29, 8, 11, 12)),
        (None, "int", "Uint8", None),
        (None, "string", "Date", None),
    ],
)
def test_values(spark, value, source, logical, expected):
    assert one(spark, value, source, logical) == expected


@pytest.mark.parametrize(
    "value,source,logical",
    [
        (300, "int", "Int8"),
        (-1, "int", "Uint8"),
        (256, "int", "Uint8"),
        (4294967296, "bigint", "Uint32"),
        (Decimal(-1), "decimal(22,0)", "Uint64"),
        (Decimal(18446744073709551616), "decimal(22,0)", "Uint64"),
        ("12x", "string", "Int32"),
        ("x", "string", "Double"),
        (dt.date(1960, 4, 4), "date", "Date"),
        (-1, "bigint", "Datetime"),
        ("1969-12-31T23:59:59Z", "string", "Timestamp"),
        ("nonsense", "string", "Date"),
    ],
)
def test_values_that_do_not_fit(spark, value, source, logical):
    with pytest.raises(PySparkException):
        one(spark, value, source, logical)
    assert one(spark, value, source, logical, on_error="null") is None


@pytest.mark.parametrize(
    "source,logical",
    [("int", "Text"), ("boolean", "Bytes"), ("date", "Bool"), ("boolean", "Int32"), ("date", "Uint8"), ("double", "Date"), ("boolean", "Timestamp")],
)
def test_pairs_that_are_refused(spark, source, logical):
    with pytest.raises(TypeError):
        one(spark, None, source, logical)


def test_session_time_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, 1_710_054_000_000_000, "bigint", "Timestamp") == dt.datetime(2024, 3, 10, 7, 0)
        assert one(spark, "2024-03-10T07:00:00Z", "string", "Timestamp") == dt.datetime(2024, 3, 10, 7, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_and_missing(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    schema = T.StructType().add("id", T.LongType()).add("s", T.StringType())
    with pytest.raises(TypeError, match="id: int is not bigint"):
        K.coerce(df, schema, strict=True)
    assert K.coerce(df, schema).schema["id"].dataType == T.LongType()
    with pytest.raises(ValueError, match="missing"):
        K.coerce(df.select("id"), schema)


def test_type_names():
    assert K.spark_type("Decimal(22,9)") == T.DecimalType(22, 9)
    assert K.logical_type(T.DecimalType(21, 0)) == "Int64" and K.logical_type(T.DecimalType(22, 0)) == "Decimal(22,0)"
    assert K.logical_type(T.DecimalType(22, 9)) == "Decimal(22,9)"
    assert K.logical_type(T.DateType()) == "Date32" and K.logical_type(T.DateType(), False) == "Date"
    with pytest.raises(ValueError):
        K.logical_type(T.ArrayType(T.IntegerType()))
    with pytest.raises(ValueError):
        K.spark_type("Int128")


def test_text_forms_and_json(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 6), "{}", "{")], "d date, t timestamp_ntz, j string, k string")
    row = K.dates_as_text(df).select("*", K.valid_json(F.col("j")).alias("a"), K.valid_json(F.col("k")).alias("b")).first()
    assert (row.d, row.t, row.a, row.b) == ("2024-01-02", "2024-01-02T03:04:05.000006Z", True, False)
