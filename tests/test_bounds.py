import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed.plans.bounds import KeyRange, is_empty, key_range, next_prefix, normalise
from keyed.plans.layout import Layout, derive_splits, shard_count, splits_before

A10N, A10, A109, B = ("A", 10, -1), ("A", 10, 1), ("A", 10), ("B",)


def test_text():
    assert str(KeyRange()) == "(-Inf - +Inf)"
    assert str(KeyRange((), ("A",), False, True)) == "(-Inf - A]"
    assert str(KeyRange((), A10N, True, False)) == "(-Inf - (A,10,-1))"
    assert str(KeyRange(B, (), False, True)) == "(B - +Inf)"
    assert str(KeyRange(A10, (), True, False)) == "[(A,10,1) - +Inf)"


def test_empty():
    assert not is_empty(KeyRange())
    assert not is_empty(KeyRange(A10, A10, True, True))
    assert is_empty(KeyRange(A10, A10, False, True))
    assert is_empty(KeyRange(A10, A10, True, False))
    assert is_empty(KeyRange(B, A10, True, True))
    assert not is_empty(KeyRange((5, 3), (5,), False, True))
    assert is_empty(KeyRange((5, 3), (5,), True, False))


def test_range_from_predicates():
    keys = ["a", "b"]
    assert key_range(keys, [("a", "=", 5), ("b", ">", 3)]) == KeyRange((5, 3), (5,), False, True)
    assert key_range(keys, [("a", "=", 5)]) == KeyRange((5,), (5,), True, True)
    assert key_range(keys, [("a", ">=", 5), ("a", "<", 9), ("a", ">", 5)]) == KeyRange((5,), (9,), False, False)
    assert key_range(keys, [("b", "=", 5)]) == KeyRange()
    assert key_range(keys, [("a", "=", 5), ("a", "=", 6)]) is None
    assert key_range(keys, [("a", ">", 5), ("a", "<", 5)]) is None
    assert key_range(keys, [("a", "=", None)]) is None
    assert key_range(["t"], [("t", "startswith", "ab")]) == KeyRange(("ab",), ("ac",), True, False)


def test_literal_on_the_left():
    assert normalise([(5, "<", "a")], ["a"]) == [("a", ">", 5)]
    with pytest.raises(ValueError):
        normalise([("z", "=", 1)], ["a"])
    with pytest.raises(ValueError):
        normalise([("a", "like", "x")], ["a"])


def test_next_prefix():
    assert next_prefix("az") == "a{"
    assert next_prefix("a\U0010ffff") == "b"
    assert next_prefix("\U0010ffff") is None
    assert next_prefix("퟿") == ""


def test_shards_of_a_range():
    layout = Layout.by_splits([(50,), (70,), (90, 2), (95, 10)])
    assert list(layout.shards_in(KeyRange())) == [0, 1, 2, 3, 4]
    assert list(layout.shards_in(KeyRange((90,), (90,), True, True))) == [2, 3]
    assert list(layout.shards_in(KeyRange((90,), (95,), False, False))) == [3]
    assert list(layout.shards_in(KeyRange((50,), (70,), True, False))) == [1]
    assert list(layout.shards_in(KeyRange((50,), (70,), True, True))) == [1, 2]
    assert list(layout.shards_in(KeyRange((95, 10), (), True, False))) == [4]
    assert list(layout.shards_in(KeyRange((), (50,), False, False))) == [0]
    with pytest.raises(ValueError):
        Layout.by_splits([2, 1])


def test_shard_count():
    mb = 1024 * 1024
    assert shard_count(0) == 1
    assert shard_count(2500 * mb) == 3
    assert shard_count(25 * mb, size_mb=1) == 3
    assert shard_count(10**12, size_mb=10, max_shards=50) == 50
    assert shard_count(10**14) == 95368
    with pytest.raises(ValueError):
        shard_count(0, min_shards=200, max_shards=10)


def test_many_splits_agree_with_few(spark):
    points = [(i * 3, "m") for i in range(200)]
    types = [T.LongType(), T.StringType()]
    rows = spark.range(700).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("z").alias("t"))
    keys = [F.col("id"), F.col("t")]
    found = rows.select("id", "t", splits_before(keys, types, points).alias("n")).collect()
    assert all(r.n == sum(1 for p in points if p <= (r.id, r.t)) for r in found)
    few = rows.select("id", "t", splits_before(keys, types, points[:40]).alias("n")).collect()
    assert all(r.n == sum(1 for p in points[:40] if p <= (r.id, r.t)) for r in few)


def test_derived_splits_are_balanced(spark):
    rows = spark.range(10_000)
    points = derive_splits(rows, ["id"], 8)
    assert len(points) == 7 and points == sorted(points)
    layout = Layout.by_splits(points)
    counts = rows.groupBy(layout.shard_of([F.col("id")], [T.LongType()]).alias("s")).count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) < 2500
    assert derive_splits(rows.limit(0), ["id"], 8) == []


def test_many_splits_of_every_key_type(spark):
    """Routing by expression agrees with ordering in Python for more splits than a CASE tree takes."""
    rows = spark.sql(
        "SELECT timestampadd(MICROSECOND, id * 1000003, TIMESTAMP_NTZ'1969-12-31 23:59:00') AS t,"
        " CAST(id AS DECIMAL(12,3)) / 8 AS n, date_add(DATE'1969-11-01', CAST(id AS INT)) AS d, id,"
        " CAST(id AS DOUBLE) / 7 AS x, CAST(id AS FLOAT) / 7 AS f, unhex(lpad(hex(id * 37), 6, '0')) AS b,"
        " concat('é\"', lpad(id, 4, '0'), chr(128512)) AS s FROM range(400)"
    ).cache()
    for key in ("t", "n", "d", "id", "x", "f", "b", "s"):
        dtype = rows.schema[key].dataType
        values = [r[key] for r in rows.orderBy("id").select(key).collect()]
        values = [bytes(v) if isinstance(v, bytearray) else v for v in values]
        points = [(v,) for v in sorted(values)[5::3]]
        assert len(points) > 64
        found = rows.orderBy("id").select(splits_before([F.col(key)], [dtype], points).alias("n")).collect()
        assert [r.n for r in found] == [sum(1 for p in points if p[0] <= v) for v in values], key
        pairs = [(p[0], 1) for p in points]
        two = splits_before([F.col(key), F.lit(1)], [dtype, T.IntegerType()], pairs)
        assert [r.n for r in rows.orderBy("id").select(two.alias("n")).collect()] == [r.n for r in found], key
        few = splits_before([F.col(key)], [dtype], points[:40])
        assert [r.n for r in rows.orderBy("id").select(few.alias("n")).collect()] == [min(40, r.n) for r in found], key
    rows.unpersist()
