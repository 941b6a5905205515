import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

import keyed as K
from keyed.operators.write import latest


def test_query_source(spark, place, sf):
    orders = K.load(spark, "orders.parquet", sf)
    K.create_keyed(spark, "dir/orders", orders, "o_orderkey", prefix=place, splits=[700])
    text = "SELECT o_orderkey FROM t WHERE o_custkey = :c ORDER BY o_totalprice DESC LIMIT 1"
    found = K.query(spark, text, {"t": "dir/orders"}, {"c": 5}, prefix=place).collect()
    best = orders.filter("o_custkey = 5").orderBy(F.desc("o_totalprice")).first()
    assert [r.o_orderkey for r in found] == [best.o_orderkey]
    assert K.query(spark, "SELECT * FROM t", {"t": f"{place}/dir/orders"}, prefix="/elsewhere").count() == orders.count()
    with pytest.raises(ParseException):
        K.query(spark, "SELECT 1; SELECT 2")
    with pytest.raises(AnalysisException):
        K.query(spark, "SELECT none FROM t")


def test_names_and_prefixes():
    from keyed.sources.files import resolve

    assert resolve("/root", "a/b") == "/root/a/b" and resolve("/root/", "a") == "/root/a"
    assert resolve("/root", "/abs") == "/abs" and resolve(None, "a") == "a" and resolve("/r", "s3a://b/t") == "s3a://b/t"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_count_reads_no_columns(spark, sf):
    assert "ReadSchema: struct<>" in plan(K.load(spark, "lineitem.parquet", sf).agg(F.count("*")))


def test_pruned_read_plan(spark, place, sf):
    orders = K.load(spark, "orders.parquet", sf)
    t = K.create_keyed(spark, "t", orders, "o_custkey,o_orderkey", prefix=place, splits=[(50,), (100,)]).table
    text = plan(t.read([("o_custkey", ">=", 10), ("o_custkey", "<", 20)], ["o_orderkey"]))
    assert "GreaterThanOrEqual(o_custkey,10)" in text and "LessThan(o_custkey,20)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert t.read([("o_custkey", "=", None)]).count() == 0
    assert t.read([("o_orderstatus", "<=>", None)]).count() == 0
    assert [r.o_custkey for r in t.read([("o_custkey", "=", 7), ("o_custkey", "=", 8)]).collect()] == []


def test_last_row_per_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(latest(rows, ["k"], ["id"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert sorted(tuple(r) for r in latest(rows, ["k"], ["id"]).collect()) == [(0, 99), (1, 97), (2, 98)]


def test_merge_shuffles_and_sorts_once(spark, place, sf):
    from keyed.operators.write import _merged

    orders = K.load(spark, "orders.parquet", sf)
    t = K.create_keyed(spark, "t", orders, "o_orderkey", prefix=place, splits=[500, 1000]).table
    batch = orders.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    text = plan(_merged(spark, t.base, batch, keep_unwritten=True)[0])
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1 and text.count("Window [") == 1


def test_values_of_predicates(spark, place):
    import datetime as dt
    from decimal import Decimal

    rows = spark.sql(
        "SELECT timestampadd(DAY, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS t, CAST(id AS DECIMAL(10,2)) AS n,"
        " date_add(DATE'2024-01-01', CAST(id AS INT)) AS d, id, CAST(id AS DOUBLE) / 4 AS x FROM range(100)"
    )
    for key, low, high in [
        ("t", "2024-01-11", dt.datetime(2024, 1, 21)),
        ("d", "2024-01-11", dt.date(2024, 1, 21)),
        ("n", 10, Decimal("20")),
        ("id", 10.0, 20),
        ("x", 2.5, 5),
    ]:
        table = K.create_keyed(spark, f"by_{key}", rows, key, prefix=place, shards=4).table
        again = K.KeyedTable.open(spark, f"by_{key}", place)
        assert again.layout == table.layout and len(again.base.live) == 4
        where = [(key, ">=", low), (key, "<", high)]
        assert sorted(r.id for r in again.read(where).collect()) == list(range(10, 20))
        assert K.pushdown_parity(again, where).isEmpty()
        assert len({f.split("_shard=")[1][0] for f in again.read(where).inputFiles()}) <= 2
    assert table.read([("id", "<", 2.5)]).count() == 3 and table.read([("n", "<", 1.005)]).count() == rows.filter("n < 1.005").count()
    with pytest.raises(TypeError):
        table.read([("id", "=", "2")])


def test_binary_and_boolean_keys(spark, place):
    rows = spark.range(200).select(F.unhex(F.lpad(F.hex("id"), 4, "0")).alias("k"), (F.col("id") > 50).alias("b"), "id")
    table = K.create_keyed(spark, "bytes", rows, "k,b", prefix=place, splits=[(b"\x00\x20",), (b"\x00\x80", True)]).table
    again = K.KeyedTable.open(spark, "bytes", place)
    assert again.layout == table.layout and sorted(again.base.live) == [0, 1, 2]
    assert again.read([("k", ">=", b"\x00\x80")]).count() == 72
    assert again.read([("k", "=", b"\x00\x20")]).first().id == 32


def test_instant_keys_in_any_session_zone(spark, place):
    rows = spark.range(300).select(F.timestamp_micros(F.col("id") * 3_600_000_000 + 1_710_000_000_000_000).alias("t"), "id")
    few = K.create_keyed(spark, "few", rows, "t", prefix=place, shards=4).table
    many = K.create_keyed(spark, "many", rows, "t", prefix=place, shards=80).table
    expected = sorted(r.id for r in rows.filter("id >= 100 AND id < 200").collect())
    low, high = (rows.filter(F.col("id") == i).first().t for i in (100, 200))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("few", "many"):
            table = K.KeyedTable.open(spark, name, place)
            assert table.layout == {"few": few, "many": many}[name].layout
            got = table.read([("t", ">=", low), ("t", "<", high)])
            assert sorted(r.id for r in got.collect()) == expected
            assert K.upsert(table, rows.withColumn("id", F.col("id") + 1)).table.read().count() == 300
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
