"""Values that must not depend on a zone, a decimal context or the width of a type."""

import datetime as dt
from decimal import Decimal

import keyed as K


def test_text_of_instants_is_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_micros(0) AS a, timestamp_micros(-1) AS b, timestamp_micros(1762063200123456) AS c")
        assert tuple(K.dates_as_text(df).first()) == ("1970-01-01T00:00:00.000000Z", "1969-12-31T23:59:59.999999Z", "2025-11-02T06:00:00.123456Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keys_without_zone_in_another_session_zone(spark, place):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), h) for h in range(40)]
        df = spark.createDataFrame(rows, "t timestamp_ntz, h int")
        table = K.create_keyed(spark, "hours", df, "t", prefix=place, splits=[rows[10][0], rows[20][0], rows[30][0]]).table
        for t, h in (rows[0], rows[19], rows[20], rows[39]):
            assert [r.h for r in K.KeyedTable.open(spark, table.path).read([("t", "=", t)]).collect()] == [h]
        zoned = dt.datetime(2024, 1, 1, 19, tzinfo=dt.timezone.utc)
        assert [r.h for r in table.read([("t", "=", zoned)]).collect()] == [19]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wide_decimal_keys_reopen(spark, place):
    key = Decimal("12345678901234567890123456789.654321")
    df = spark.createDataFrame([(key, 1), (-key, 2)], "k decimal(35,6), v int")
    table = K.create_keyed(spark, "wide", df, "k", prefix=place, splits=[key]).table
    assert [r.v for r in K.KeyedTable.open(spark, table.path).read([("k", ">=", key)]).collect()] == [1]


def test_literals_beyond_the_type(spark, place):
    df = spark.createDataFrame([(1, 5), (2, -5)], "k long, v byte")
    table = K.create_keyed(spark, "narrow", df, "k", prefix=place, splits=[2]).table
    assert table.read([("v", ">=", 128)]).count() == 0 and table.read([("v", "<", 128)]).count() == 2
    assert table.read([("k", "<", 1 << 70)]).count() == 2


def test_index_lookup_applies_every_triple(spark, place):
    rows = [(i, None if i % 10 == 0 else i % 3, f"n{i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int, name string")
    table = K.create_keyed(spark, "looked", df, "id", prefix=place, splits=[100, 200], indexes={"by_g": ["g"]}).table
    for where, keep in (
        ([("g", ">=", 1), ("id", "=", 7)], lambda r: r[1] is not None and r[1] >= 1 and r[0] == 7),
        ([("g", "<=>", None)], lambda r: r[1] is None),
        ([("g", "=", 2), ("name", "=", "n1")], lambda r: r[1] == 2 and r[2] == "n1"),
    ):
        assert sorted(r.id for r in K.index_lookup(table, "by_g", where).collect()) == [r[0] for r in rows if keep(r)]


def test_numbers_are_microseconds_by_spark_type(spark):
    target = spark.sql("SELECT timestamp_micros(0) AS a, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS b").schema
    row = K.coerce(spark.sql("SELECT 1000000L AS a, 1000000L AS b"), target).selectExpr("unix_micros(a)", "CAST(b AS STRING)").first()
    assert tuple(row) == (1000000, "1970-01-01 00:00:01")
