"""Coercion of whole tables to declared types."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

import keyed as K

from .tables import raw

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return register


def _coerced(df, key, **declared):
    schema = T.StructType([df.schema[key]] + [K.declare(name, logical) for name, logical in declared.items()])
    return K.coerce(df, schema)


@query(
    """SELECT o_orderkey, o_custkey <> 0 AS from_int, trunc(o_totalprice / 200000) <> 0 AS from_double,
        o_orderstatus = 'F' AS from_text FROM orders"""
)
def coerce_bool(spark, sf):
    word = F.when(F.col("o_orderstatus") == "F", "TRUE").when(F.col("o_orderstatus") == "O", "yes").otherwise("1")
    rows = raw(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("from_int"),
        (F.col("o_totalprice") / 200000).alias("from_double"),
        word.alias("from_text"),
    )
    return _coerced(rows, "o_orderkey", from_int="Bool", from_double="Bool", from_text="Bool")


@query(
    """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS narrow, CAST(o_orderkey AS BIGINT) AS from_text,
        CAST(trunc(o_totalprice) AS INTEGER) AS from_double FROM orders"""
)
def coerce_int(spark, sf):
    rows = raw(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("narrow"),
        F.col("o_orderkey").cast("string").alias("from_text"),
        F.col("o_totalprice").alias("from_double"),
    )
    return _coerced(rows, "o_orderkey", narrow="Int32", from_text="Int64", from_double="Int32")


@query(
    """SELECT p_partkey, CAST(p_size AS SMALLINT) AS u8, CAST(p_size * 100 AS INTEGER) AS u16,
        CAST(p_partkey AS BIGINT) AS u32 FROM part"""
)
def coerce_uint(spark, sf):
    rows = raw(spark, sf, "part").select(
        "p_partkey",
        F.col("p_size").alias("u8"),
        (F.col("p_size") * 100).cast("string").alias("u16"),
        F.col("p_partkey").alias("u32"),
    )
    return _coerced(rows, "p_partkey", u8="Uint8", u16="Uint16", u32="Uint32")


@query(
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS small,
        CAST(CAST(18446744073709551615 AS HUGEINT) - o_orderkey AS VARCHAR) AS large FROM orders"""
)
def coerce_uint64(spark, sf):
    large = (F.lit("18446744073709551615").cast("decimal(22,0)") - F.col("o_orderkey")).cast("string")
    rows = raw(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("small"), large.alias("large"))
    done = _coerced(rows, "o_orderkey", small="Uint64", large="Uint64")
    return done.select("o_orderkey", F.col("small").cast("string"), F.col("large").cast("string"))


@query(
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS from_int, o_totalprice AS from_text,
        CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS as_float FROM orders"""
)
def coerce_double(spark, sf):
    price = F.col("o_totalprice")
    rows = raw(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("from_int"),
        price.cast("string").alias("from_text"),
        price.alias("as_float"),
    )
    done = _coerced(rows, "o_orderkey", from_int="Double", from_text="Double", as_float="Float")
    return done.withColumn("as_float", F.col("as_float").cast("double"))


@query(
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(22,9)) AS VARCHAR) AS from_double,
        CAST(CAST(o_custkey AS DECIMAL(35,6)) AS VARCHAR) AS from_int,
        CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(22,2)) AS VARCHAR) AS from_text FROM orders"""
)
def coerce_decimal(spark, sf):
    price = F.col("o_totalprice")
    rows = raw(spark, sf, "orders").select(
        "o_orderkey",
        price.alias("from_double"),
        F.col("o_custkey").alias("from_int"),
        price.cast("string").alias("from_text"),
    )
    done = _coerced(rows, "o_orderkey", from_double="Decimal(22,9)", from_int="Decimal(35,6)", from_text="Decimal(22,2)")
    return done.select("o_orderkey", *[F.col(c).cast("string") for c in ("from_double", "from_int", "from_text")])


@query("SELECT doc_id, text FROM documents")
def coerce_text(spark, sf):
    rows = raw(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("text"))
    return _coerced(rows, "doc_id", text="Text")


@query("SELECT event_id, props, json_valid(props) AS valid FROM events")
def coerce_json(spark, sf):
    rows = raw(spark, sf, "events").select("event_id", F.encode("props", "UTF-8").alias("props"))
    return _coerced(rows, "event_id", props="Json").withColumn("valid", K.valid_json(F.col("props")))


@query("SELECT doc_id, hex(encode(text)) AS bytes FROM documents")
def coerce_bytes(spark, sf):
    rows = raw(spark, sf, "documents").select("doc_id", F.col("text").alias("bytes"))
    return _coerced(rows, "doc_id", bytes="Bytes").withColumn("bytes", F.hex("bytes"))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS from_text,
        strftime(DATE '1970-01-01' + CAST(o_custkey AS INTEGER), '%Y-%m-%d') AS from_days,
        strftime(DATE '1970-01-01' - CAST(o_custkey AS INTEGER), '%Y-%m-%d') AS before_1970 FROM orders"""
)
def coerce_date(spark, sf):
    rows = raw(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("from_text"),
        F.col("o_custkey").alias("from_days"),
        (-F.col("o_custkey")).alias("before_1970"),
    )
    done = _coerced(rows, "o_orderkey", from_text="Date", from_days="Date", before_1970="Date32")
    return K.dates_as_text(done)


@query(
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS whole,
        strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS from_micros,
        strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS from_text FROM events"""
)
def coerce_datetime(spark, sf):
    rows = raw(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("whole"),
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("from_micros"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("from_text"),
    )
    return K.dates_as_text(_coerced(rows, "event_id", whole="Datetime", from_micros="Datetime64", from_text="Datetime"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS from_micros,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS from_text,
        strftime(make_timestamp(-1 - epoch_us(ts)), '%Y-%m-%dT%H:%M:%S.%fZ') AS before_1970 FROM events"""
)
def coerce_timestamp(spark, sf):
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    rows = raw(spark, sf, "events").select(
        "event_id",
        micros.alias("from_micros"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("from_text"),
        (-1 - micros).alias("before_1970"),
    )
    done = _coerced(rows, "event_id", from_micros="Timestamp", from_text="Timestamp", before_1970="Timestamp64")
    return K.dates_as_text(done)


@query("SELECT * FROM part")
def coerce_strict(spark, sf):
    rows = raw(spark, sf, "part")
    return K.coerce(rows, rows.schema, strict=True)
