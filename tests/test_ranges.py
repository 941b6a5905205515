import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import keyed as K
from keyed.operators import ranges as R

KEY = "struct<s:string,i:int,l:bigint>"
TUPLES = {
    "v1": ("A", 10, -1), "v2": ("A", 10, 1), "v3": ("A", 10), "v4": ("A", 10, None), "v6": ("A", 9), "v7": ("B",),
}


def parts(v):
    types = ["string", "int", "bigint"]
    return [F.lit(x).cast(t) for x, t in zip(v, types)]


@pytest.mark.parametrize(
    "a,b,expected",
    [
        ("v1", "v1", 0), ("v1", "v2", -1), ("v2", "v1", 1), ("v3", "v1", -1), ("v1", "v3", 1), ("v4", "v3", 0),
        ("v4", "v1", -1), ("v6", "v3", -1), ("v7", "v2", 1), ("v6", "v7", -1),
    ],
)
def test_compare(spark, a, b, expected):
    row = spark.range(1).select(K.compare_keys(parts(TUPLES[a]), parts(TUPLES[b])).alias("c")).first()
    assert row.c == expected


# Ranges and what their intersections must be.
RANGES = {
    "r1": (("A", 9), ("A", 10), True, True),
    "r2": (("A", 9), ("A", 10, 1), False, True),
    "r3": (("A", 10, 1), ("B",), False, False),
    "r4": (("A", 10, 1), None, True, False),
    "r5": (None, ("A", 10, 1), False, False),
    "all": (None, None, False, False),
}
EXPECTED = {
    ("r1", "r2"): "((A,9) - (A,10)]",
    ("r3", "r4"): "((A,10,1) - B)",
    ("r2", "r5"): "((A,9) - (A,10,1))",
    ("r2", "r4"): "[(A,10,1) - (A,10,1)]",
    ("r1", "r1"): "[(A,9) - (A,10)]",
    ("all", "all"): "(-Inf - +Inf)",
    ("r3", "all"): "((A,10,1) - B)",
    ("r1", "r3"): None,
    ("r2", "r3"): None,
    ("r4", "r5"): None,
}


def range_table(spark, names, id_name):
    pad = lambda v: tuple(list(v or ()) + [None] * (3 - len(v or ())))
    rows = [(n, pad(RANGES[n][0]), pad(RANGES[n][1]), RANGES[n][2], RANGES[n][3]) for n in names]
    return spark.createDataFrame(rows, f"{id_name} string, lo {KEY}, hi {KEY}, lo_incl boolean, hi_incl boolean")


def text(row):
    trim = lambda s: tuple(x for x in s if x is not None)
    return str(K.KeyRange(trim(row.lo), trim(row.hi), row.lo_incl, row.hi_incl))


def test_intersections(spark):
    a, b = range_table(spark, RANGES, "a"), range_table(spark, RANGES, "b")
    got = {(r.a, r.b): text(r) for r in K.intersect_ranges(a, b).collect()}
    for (x, y), expected in EXPECTED.items():
        assert got.get((x, y)) == expected and got.get((y, x)) == expected, (x, y)
    for n in RANGES:
        assert got[(n, "all")] == got[(n, n)]


def test_intersection_needs_same_types(spark):
    a = range_table(spark, ["r1"], "a")
    b = a.select(F.col("a").alias("b"), F.struct(F.lit(1).alias("s")).alias("lo"), F.struct(F.lit(1).alias("s")).alias("hi"), "lo_incl", "hi_incl")
    with pytest.raises(TypeError):
        K.intersect_ranges(a, b)


def random_ranges(rng, n, top):
    out = []
    for i in range(n):
        lo, hi = rng.choice([None, rng.randrange(top)]) if rng.random() < 0.1 else rng.randrange(top), None
        if rng.random() > 0.1:
            hi = min(top, (lo or 0) + rng.choice([0, 1, 5, 200]))
        out.append((i, lo, hi, rng.random() < 0.5, rng.random() < 0.5))
    return out


def as_table(spark, rows, name):
    df = spark.createDataFrame(rows, f"{name} int, l int, h int, lo_incl boolean, hi_incl boolean")
    return df.select(name, F.struct(F.col("l").alias("k")).alias("lo"), F.struct(F.col("h").alias("k")).alias("hi"), "lo_incl", "hi_incl")


@pytest.mark.parametrize("bins", [4096, 7])
def test_random_intersections_against_brute_force(spark, bins, monkeypatch):
    """A third of the ranges start at one key."""
    monkeypatch.setattr(R, "bound_splits", lambda tables, found=R.bound_splits: found(tables, bins))
    rng = random.Random(3)
    left, right = random_ranges(rng, 120, 300), random_ranges(rng, 90, 300)
    left = [(i, 42 if i % 3 == 0 else lo, hi, a, b) for i, lo, hi, a, b in left]
    valid = lambda lo, hi, a, b: lo is None or hi is None or lo < hi or (lo == hi and a and b)
    expected = set()
    for i, al, ah, ali, ahi in left:
        for j, bl, bh, bli, bhi in right:
            if not valid(al, ah, ali, ahi) or not valid(bl, bh, bli, bhi):
                continue
            ali_, bli_, ahi_, bhi_ = ali and al is not None, bli and bl is not None, ahi and ah is not None, bhi and bh is not None
            lo, li = max((al, not ali_), (bl, not bli_), key=lambda x: (float("-inf") if x[0] is None else x[0], x[1]))
            hi, hx = min((ah, ahi_), (bh, bhi_), key=lambda x: (float("inf") if x[0] is None else x[0], x[1]))
            if valid(lo, hi, not li, hx):
                expected.add((i, j, lo, hi, (not li) and lo is not None, hx and hi is not None))
    found = K.intersect_ranges(as_table(spark, left, "a"), as_table(spark, right, "b")).collect()
    got = [(r.a, r.b, r.lo[0], r.hi[0], r.lo_incl, r.hi_incl) for r in found]
    assert len(got) == len(set(got)) and set(got) == expected


@pytest.mark.parametrize("bins", [4096, 5])
def test_random_routing_against_brute_force(spark, bins, monkeypatch):
    monkeypatch.setattr(R, "bound_splits", lambda tables, found=R.bound_splits: found(tables, bins))
    rng = random.Random(5)
    ranges = random_ranges(rng, 60, 300)
    keys = [rng.randrange(300) if i % 3 else 42 for i in range(400)]
    rows = spark.createDataFrame(list(enumerate(keys)), "row int, k int")
    got = {(r.row, r.a) for r in K.route_rows(rows, ["k"], as_table(spark, ranges, "a")).collect()}
    expected = {
        (i, a)
        for i, k in enumerate(keys)
        for a, lo, hi, li, hin in ranges
        if (lo is None or k > lo or (k == lo and li)) and (hi is None or k < hi or (k == hi and hin))
    }
    assert got == expected


def test_prefix_ranges_route_and_touch(spark, place):
    """Composite keys with prefix bounds: no row is lost and no shard is missed."""
    rows = spark.range(400).select((F.col("id") % 20).alias("a"), F.col("id").alias("b"))
    table = K.create_keyed(spark, f"{place}/t", rows, "a,b", splits=[(5,), (5, 105), (9, 200), (15,)]).table
    rng = random.Random(9)
    specs = []
    for i in range(80):
        bound = lambda: rng.choice([(None, None), (rng.randrange(20), None), (rng.randrange(20), rng.randrange(400))])
        specs.append((i, bound(), bound(), rng.random() < 0.5, rng.random() < 0.5))
    key = "struct<a:bigint,b:bigint>"
    ranges = spark.createDataFrame(specs, f"r int, lo {key}, hi {key}, lo_incl boolean, hi_incl boolean")

    def trim(v):
        return tuple(x for x in v if x is not None)

    def holds(spec, k):
        lo, hi = trim(spec[1]), trim(spec[2])
        above = not lo or k[: len(lo)] > lo or (k[: len(lo)] == lo and spec[3])
        below = not hi or k[: len(hi)] < hi or (k[: len(hi)] == hi and spec[4])
        return above and below

    keys = [(i % 20, i) for i in range(400)]
    got = {(r.r, r.a, r.b) for r in K.route_rows(table.read(), ["a", "b"], ranges).collect()}
    assert got == {(s[0], *k) for s in specs for k in keys if holds(s, k)}
    from keyed.plans.bounds import is_empty

    spread = R.range_shards(table.layout, table.base.key_types(), ranges)
    touched = {(r.r, r.shard) for r in spread.collect()}
    expected = set()
    for s in specs:
        kr = K.KeyRange(trim(s[1]), trim(s[2]), s[3], s[4])
        if not is_empty(kr):
            expected |= {(s[0], shard) for shard in table.layout.shards_in(kr)}
    assert touched == expected
    few = ranges.filter("r < 5")
    read = {(r.a, r.b) for r in K.read_ranges(table, few).collect()}
    assert read == {k for s in specs[:5] for k in keys if holds(s, k)}


def test_bigint_keys_meet_int_ranges(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    ranges = as_table(spark, [(1, 2, 4, True, False)], "a")
    assert sorted(r.k for r in K.route_rows(rows, ["k"], ranges).collect()) == [2, 3]
    assert T.LongType() == rows.schema["k"].dataType


def test_hot_keys_without_broadcast(spark):
    """A third of all rows and of all ranges share one key; both sides are shuffled by bin."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"))
        ranges = spark.range(600).select(
            F.col("id").alias("a"),
            F.struct(F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id")).alias("k")).alias("lo"),
            F.struct(F.when(F.col("id") % 3 == 0, 701).otherwise(F.col("id") + 5).alias("k")).alias("hi"),
            F.lit(True).alias("lo_incl"),
            F.lit(False).alias("hi_incl"),
        )
        per_range = K.route_rows(rows, ["k"], ranges).groupBy("a").count()
        counts = {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
        spans = {i: (700, 701) if i % 3 == 0 else (i, i + 5) for i in range(600)}
        expected = {i: sum(counts.get(k, 0) for k in range(*s)) for i, s in spans.items()}
        assert {r.a: r["count"] for r in per_range.collect()} == {i: n for i, n in expected.items() if n}
        other = ranges.withColumnRenamed("a", "b").filter("b % 3 <> 1")
        pairs = K.intersect_ranges(ranges, other).groupBy("a").count()
        overlaps = {
            i: sum(1 for j, t in spans.items() if j % 3 != 1 and max(s[0], t[0]) < min(s[1], t[1])) for i, s in spans.items()
        }
        assert {r.a: r["count"] for r in pairs.collect()} == {i: n for i, n in overlaps.items() if n}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
