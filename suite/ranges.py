"""Key ranges as data, and table comparison."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

import keyed as K

from .reads import CUSTOMER_SHARD
from .tables import fresh, orders_by_customer, raw

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return register


def _customer_ranges(spark, sf):
    """One range of customer keys per customer; about every second one leaves out its last key."""
    return raw(spark, sf, "customer").select(
        F.col("c_custkey").alias("range_id"),
        F.struct(F.col("c_custkey").alias("k0")).alias("lo"),
        F.struct((F.col("c_custkey") + F.col("c_nationkey")).alias("k0")).alias("hi"),
        (F.col("c_acctbal") > 1000).alias("lo_incl"),
        (F.col("c_acctbal") > 5000).alias("hi_incl"),
    )


INSIDE = """(o_custkey > c_custkey OR (o_custkey = c_custkey AND c_acctbal > 1000))
    AND (o_custkey < c_custkey + c_nationkey OR (o_custkey = c_custkey + c_nationkey AND c_acctbal > 5000))"""


@query(
    f"""SELECT c_custkey AS range_id, COUNT(*) AS orders_in_range, MAX(o_totalprice) AS max_price
        FROM customer JOIN orders ON {INSIDE} GROUP BY c_custkey"""
)
def route_rows(spark, sf):
    orders = raw(spark, sf, "orders").select("o_custkey", "o_totalprice")
    routed = K.route_rows(orders, ["o_custkey"], _customer_ranges(spark, sf))
    return routed.groupBy("range_id").agg(
        F.count(F.lit(1)).alias("orders_in_range"), F.max("o_totalprice").alias("max_price")
    )


@query(
    """WITH pairs AS (
            SELECT o_orderkey, o_custkey AS a1, nullif(o_orderstatus, 'P') AS a2, o_orderpriority AS a3,
                o_custkey AS b1, nullif(CASE WHEN o_totalprice > 200000 THEN 'F' ELSE 'O' END, 'O') AS b2, '3-MEDIUM' AS b3
            FROM orders)
        SELECT o_orderkey, CAST(CASE
            WHEN a1 < b1 THEN -1 WHEN a1 > b1 THEN 1
            WHEN a2 IS NULL AND b2 IS NULL THEN 0 WHEN a2 IS NULL THEN -1 WHEN b2 IS NULL THEN 1
            WHEN a2 < b2 THEN -1 WHEN a2 > b2 THEN 1
            WHEN a3 < b3 THEN -1 WHEN a3 > b3 THEN 1 ELSE 0 END AS INTEGER) AS cmp,
            CAST(CASE WHEN a2 IS NULL THEN 0 ELSE 1 END AS INTEGER) AS longer FROM pairs"""
)
def key_compare(spark, sf):
    dear = F.when(F.col("o_totalprice") > 200000, "F").otherwise("O")
    a = [F.col("o_custkey"), F.nullif(F.col("o_orderstatus"), F.lit("P")), F.col("o_orderpriority")]
    b = [F.col("o_custkey"), F.nullif(dear, F.lit("O")), F.lit("3-MEDIUM")]
    return raw(spark, sf, "orders").select(
        "o_orderkey", K.compare_keys(a, b).alias("cmp"), K.compare_keys(a, a[:1]).alias("longer")
    )


@query(
    """WITH a AS (SELECT c_custkey AS a_id, c_custkey AS lo, c_custkey + c_nationkey AS hi, c_acctbal > 1000 AS li,
            c_acctbal > 5000 AS hi_in FROM customer),
        b AS (SELECT s_suppkey AS b_id, s_suppkey * 15 AS lo, s_suppkey * 15 + s_nationkey AS hi, s_acctbal > 2000 AS li,
            s_acctbal > 4000 AS hi_in FROM supplier),
        valid_a AS (SELECT * FROM a WHERE lo < hi OR (lo = hi AND li AND hi_in)),
        valid_b AS (SELECT * FROM b WHERE lo < hi OR (lo = hi AND li AND hi_in)),
        pairs AS (SELECT a_id, b_id, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi,
            CASE WHEN a.lo = b.lo THEN a.li AND b.li WHEN a.lo > b.lo THEN a.li ELSE b.li END AS lo_incl,
            CASE WHEN a.hi = b.hi THEN a.hi_in AND b.hi_in WHEN a.hi < b.hi THEN a.hi_in ELSE b.hi_in END AS hi_incl
            FROM valid_a a JOIN valid_b b ON a.lo <= b.hi AND b.lo <= a.hi)
        SELECT * FROM pairs WHERE lo < hi OR (lo = hi AND lo_incl AND hi_incl)"""
)
def range_intersect(spark, sf):
    a = _customer_ranges(spark, sf).withColumnRenamed("range_id", "a_id")
    start = F.col("s_suppkey") * 15
    b = raw(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("b_id"),
        F.struct(start.alias("k0")).alias("lo"),
        F.struct((start + F.col("s_nationkey")).alias("k0")).alias("hi"),
        (F.col("s_acctbal") > 2000).alias("lo_incl"),
        (F.col("s_acctbal") > 4000).alias("hi_incl"),
    )
    both = K.intersect_ranges(a, b)
    return both.select("a_id", "b_id", F.col("lo.k0").alias("lo"), F.col("hi.k0").alias("hi"), "lo_incl", "hi_incl")


@query(
    """WITH r AS (SELECT c_custkey AS lo, c_custkey + c_nationkey AS hi, c_acctbal > 1000 AS li, c_acctbal > 5000 AS hi_in
            FROM customer),
        shards(shard, lo1, hi1, hi2) AS (VALUES (0, NULL, 300, NULL), (1, 300, 600, NULL), (2, 600, 900, NULL),
            (3, 900, 1200, 5000), (4, 1200, NULL, NULL))
        SELECT CAST(shard AS INTEGER) AS shard, COUNT(*) AS ranges FROM r JOIN shards
            ON (lo < hi OR (lo = hi AND li AND hi_in))
            AND (hi1 IS NULL OR lo < hi1 OR (lo = hi1 AND li AND hi2 IS NOT NULL))
            AND (lo1 IS NULL OR hi > lo1 OR (hi = lo1 AND hi_in))
        GROUP BY shard"""
)
def touched_shards(spark, sf):
    return K.touched_shards(orders_by_customer(spark, sf), _customer_ranges(spark, sf))


@query(
    f"""SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM
        (SELECT s_suppkey * 15 AS c_custkey, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal FROM supplier) s
        WHERE {INSIDE})"""
)
def read_ranges(spark, sf):
    start = F.col("s_suppkey") * 15
    ranges = raw(spark, sf, "supplier").select(
        F.struct(start.alias("k0")).alias("lo"),
        F.struct((start + F.col("s_nationkey")).alias("k0")).alias("hi"),
        (F.col("s_acctbal") > 1000).alias("lo_incl"),
        (F.col("s_acctbal") > 5000).alias("hi_incl"),
    )
    return K.read_ranges(orders_by_customer(spark, sf), ranges)


@query(
    """WITH b AS (SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey,
            nullif(o_orderstatus, 'O') AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
            CASE WHEN b.o_orderkey IS NULL THEN 'only_left' WHEN a.o_orderkey IS NULL THEN 'only_right' ELSE 'changed' END AS diff
        FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus"""
)
def table_diff(spark, sf):
    orders = raw(spark, sf, "orders")
    moved = F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    other = orders.withColumns(
        {"o_orderkey": moved, "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("O"))}
    )
    return K.table_diff(orders, other, ["o_orderkey"])


@query(
    """SELECT p_partkey, 'changed' AS diff, TRUE AS without_exchange FROM part WHERE p_partkey % 10 = 3
        UNION ALL SELECT -1 - p_partkey, 'only_right', TRUE FROM part WHERE p_partkey % 10 = 4"""
)
def bucketed_diff(spark, sf):
    """Two tables in buckets of their keys are compared without a shuffle."""
    parts = raw(spark, sf, "part")
    size = F.when(F.col("p_partkey") % 10 == 3, F.col("p_size") + 1).otherwise(F.col("p_size"))
    other = parts.withColumn("p_size", size.cast(parts.schema["p_size"].dataType))
    more = parts.filter("p_partkey % 10 = 4").withColumn("p_partkey", -1 - F.col("p_partkey"))
    tables = []
    for i, rows in enumerate((parts, other.unionByName(more))):
        table = fresh(spark, sf, f"bucketed-{i}", rows, "p_partkey", store="hash", shards=8)
        tables.append(K.publish_buckets(table, f"parts_in_buckets_{i}_{uuid.uuid4().hex[:8]}"))
    diff = K.table_diff(*tables, ["p_partkey"])
    plan = diff._jdf.queryExecution().sparkPlan().toString() + diff._jdf.queryExecution().executedPlan().toString()
    return diff.withColumn("without_exchange", F.lit("Exchange" not in plan))


@query(
    """WITH l AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem),
        r AS (SELECT DISTINCT * FROM l)
        SELECT l_orderkey, l_partkey, l_quantity, COUNT(*) - 1 AS surplus FROM l GROUP BY ALL HAVING COUNT(*) > 1"""
)
def bag_diff(spark, sf):
    rows = raw(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return K.bag_diff(rows, rows.distinct())


@query(
    """SELECT COUNT(*) AS rows_read, CAST(0 AS BIGINT) AS differences FROM orders
        WHERE o_custkey = 1200 AND o_orderkey >= 5000 AND o_totalprice > 1000"""
)
def pushdown_parity(spark, sf):
    table = orders_by_customer(spark, sf)
    where = [("o_custkey", "=", 1200), ("o_orderkey", ">=", 5000), ("o_totalprice", ">", 1000.0)]
    both = table.read(where).select(F.lit(True).alias("read")).unionByName(
        K.pushdown_parity(table, where).select(F.lit(False).alias("read"))
    )
    return both.agg(F.count_if("read").alias("rows_read"), F.count_if(~F.col("read")).alias("differences"))
