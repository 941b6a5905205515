"""Sources, scans, predicates, limits and counts."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import functions as F
from pyspark.sql import types as T

import keyed as K

from .tables import customers_by_name, indexed_orders, orders_by_customer, orders_by_key, orders_in_files, orders_in_one_shard, parts_hashed, raw, stored, stored_together

QUERIES, SQL = {}, {}

ORDER_SHARD = """CASE WHEN o_orderkey < 3000 THEN 0 WHEN o_orderkey < 6000 THEN 1 WHEN o_orderkey < 9000 THEN 2
     WHEN o_orderkey < 12000 THEN 3 ELSE 4 END"""
CUSTOMER_SHARD = """CASE WHEN o_custkey < 300 THEN 0 WHEN o_custkey < 600 THEN 1 WHEN o_custkey < 900 THEN 2
     WHEN o_custkey < 1200 OR (o_custkey = 1200 AND o_orderkey < 5000) THEN 3 ELSE 4 END"""


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return register


@query("SELECT * FROM orders")
def scan_table(spark, sf):
    return K.load(spark, "orders.parquet", sf)


@query(
    "SELECT c_name, CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer"
)
def scan_with_schema(spark, sf):
    schema = T.StructType().add("c_name", T.StringType()).add("c_custkey", T.IntegerType()).add("c_nationkey", T.LongType())
    return K.load(spark, "customer.parquet", sf, schema)


@query(f"SELECT CAST({ORDER_SHARD} AS INTEGER) AS shard, COUNT(*) AS rows_in_shard FROM orders GROUP BY 1")
def scan_range_shards(spark, sf):
    rows = orders_by_key(spark, sf).read(columns=[], with_shard=True)
    return rows.groupBy(F.col("_shard").alias("shard")).agg(F.count(F.lit(1)).alias("rows_in_shard"))


@query("SELECT *, TRUE AS in_its_shard FROM part")
def scan_hash_shards(spark, sf):
    rows = parts_hashed(spark, sf).read(with_shard=True)
    shard = F.pmod(F.hash("p_partkey"), F.lit(8))
    return rows.withColumn("in_its_shard", F.col("_shard") == shard).drop("_shard")


@query("SELECT * FROM orders WHERE o_orderkey = 742")
def range_read_point(spark, sf):
    return orders_by_key(spark, sf).read([("o_orderkey", "=", 742)])


@query("SELECT *, 1 AS files_read FROM orders WHERE o_orderkey = 742")
def file_point_read(spark, sf):
    """A point read of a large shard opens one file."""
    rows = orders_in_one_shard(spark, sf).read([("o_orderkey", "=", 742)])
    return rows.withColumn("files_read", F.lit(len(rows.inputFiles())))


@query("SELECT *, TRUE AS few_files FROM orders WHERE o_orderkey IN (42, 742, 1450)")
def range_read_in(spark, sf):
    """Three keys open three files at most."""
    rows = orders_in_one_shard(spark, sf).read([("o_orderkey", "in", [42, 742, 1450])])
    return rows.withColumn("few_files", F.lit(len(rows.inputFiles()) <= 3))


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice, TRUE AS pruned FROM orders
        WHERE (o_custkey IN (3, 5, 7, 1300) AND NOT o_orderkey < 100) OR (o_custkey >= 1490 AND o_totalprice > 1000)"""
)
def range_read_or(spark, sf):
    """Spans of both sides of an OR choose the shards."""
    where = ("or", [
        ("and", [("o_custkey", "in", [3, 5, 7, 1300]), ("not", ("o_orderkey", "<", 100))]),
        ("and", [("o_custkey", ">=", 1490), ("o_totalprice", ">", 1000.0)]),
    ])
    rows = orders_by_customer(spark, sf).read([where], ["o_custkey", "o_orderkey", "o_totalprice"])
    shards = {f.split("_shard=")[1].split("/")[0] for f in rows.inputFiles()}
    return rows.withColumn("pruned", F.lit(shards <= {"0", "4"}))


def _typed_orders(spark, sf):
    """Ten tables of orders, by store and key."""
    typed = raw(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CAST(o_totalprice AS DECIMAL(9,2)) AS price",
        "if(o_orderkey % 50 = 0, CAST('NaN' AS DOUBLE), o_totalprice) AS amount",
        "CAST(o_orderdate AS DATE) AS day",
        "make_dt_interval(0, CAST(o_orderkey AS INT), 30) AS age",
    )
    options = {"shards": 4, "rows_per_file": 200}
    keys = {"whole": "o_orderkey", "price": "price, o_orderkey", "amount": "amount, o_orderkey", "day": "day, o_orderkey", "age": "age"}
    creates = {
        f"typed_{store}_{k}": lambda n, p, store=store, key=key: K.create_keyed(spark, n, typed, key, prefix=p, store=store, **options)
        for store in ("range", "hash")
        for k, key in keys.items()
    }
    return stored_together(spark, sf, creates)


@query(
    """WITH t AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(9,2)) AS price,
            CASE WHEN o_orderkey % 50 = 0 THEN 'NaN'::DOUBLE ELSE o_totalprice END AS amount, CAST(o_orderdate AS DATE) AS day FROM orders),
        found AS (
            SELECT 'whole' AS key, 0 AS part, o_orderkey FROM t WHERE o_orderkey >= 49.5 AND o_orderkey < 120
            UNION ALL SELECT 'whole', 1, o_orderkey FROM t WHERE o_orderkey IN (1, 2, 700)
            UNION ALL SELECT 'price', 0, o_orderkey FROM t WHERE price < 1234567890123 AND price >= 300000.005
            UNION ALL SELECT 'amount', 0, o_orderkey FROM t WHERE isnan(amount)
            UNION ALL SELECT 'amount', 1, o_orderkey FROM t WHERE amount > 400000
            UNION ALL SELECT 'amount', 2, o_orderkey FROM t WHERE NOT isnan(amount) AND amount < 2000
            UNION ALL SELECT 'day', 0, o_orderkey FROM t WHERE day >= TIMESTAMP '2001-01-01 12:00:00'
            UNION ALL SELECT 'age', 0, o_orderkey FROM t WHERE o_orderkey * 60 + 30 > 1000 * 60 + 30)
        SELECT store, key, part, o_orderkey FROM found, (VALUES ('range'), ('hash')) s(store)"""
)
def range_read_typed(spark, sf):
    """Keys of several types, with literals that lie between their values or beyond them, NaN among them."""
    nan = float("nan")
    wanted = {
        "whole": [[("o_orderkey", ">=", 49.5), ("o_orderkey", "<", 120)], [("o_orderkey", "in", [1, 2, 2.5, 700, 10**30])]],
        "price": [[("price", "<", 1234567890123), ("price", ">=", 300000.005)]],
        "amount": [[("amount", "=", nan)], [("amount", ">", 400000.0)], [("not", ("amount", "=", nan)), ("amount", "<", 2000)]],
        "day": [[("day", ">=", dt.datetime(2001, 1, 1, 12))]],
        "age": [[("age", ">", dt.timedelta(hours=1000, minutes=30))]],
    }
    out = None
    for name, table in _typed_orders(spark, sf).items():
        _, store, key = name.split("_")
        for part, where in enumerate(wanted[key]):
            rows = table.read(where, ["o_orderkey"])
            one = rows.select(F.lit(store).alias("store"), F.lit(key).alias("key"), F.lit(part).alias("part"), "o_orderkey")
            out = one if out is None else out.unionAll(one)
    return out


@query("SELECT * FROM orders WHERE o_custkey = 5 AND o_orderkey > 3000")
def range_read_prefix(spark, sf):
    return orders_by_customer(spark, sf).read([("o_custkey", "=", 5), ("o_orderkey", ">", 3000)])


@query("SELECT * FROM orders WHERE o_custkey >= 200 AND o_custkey < 700")
def range_read_between(spark, sf):
    return orders_by_customer(spark, sf).read([("o_custkey", ">=", 200), (700, ">", "o_custkey")])


@query("SELECT * FROM customer WHERE c_name LIKE 'Customer#00000012%'")
def range_read_text_prefix(spark, sf):
    return customers_by_name(spark, sf).read([("c_name", "startswith", "Customer#00000012")])


@query(
    f"""SELECT o_orderkey, o_totalprice, CAST({ORDER_SHARD} AS INTEGER) AS shard,
        row_number() OVER (PARTITION BY {ORDER_SHARD} ORDER BY o_orderkey) AS position FROM orders"""
)
def ordered_read(spark, sf):
    """Positions as the read hands the rows over: by partition, and by place within it."""
    rows = orders_in_files(spark, sf).ordered(columns=["o_orderkey", "o_totalprice"])
    handed = rows.withColumn("_at", F.monotonically_increasing_id()).withColumnRenamed("_shard", "shard")
    return K.rank_in_shard(handed, ["_at"], "shard", "position").drop("_at")


@query("SELECT o_custkey, o_orderkey FROM orders")
def index_scan(spark, sf):
    return indexed_orders(spark, sf).index("by_customer")


@query("SELECT * FROM orders WHERE o_custkey >= 40 AND o_custkey <= 60")
def index_lookup(spark, sf):
    return K.index_lookup(indexed_orders(spark, sf), "by_customer", [("o_custkey", ">=", 40), ("o_custkey", "<=", 60)])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def sql_source(spark, sf):
    text = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1"
    return K.query(spark, text, {"orders": raw(spark, sf, "orders")})


@query("SELECT COUNT(*) AS n FROM lineitem")
def count_scan(spark, sf):
    return raw(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH placed AS (SELECT CAST({CUSTOMER_SHARD} AS INTEGER) AS shard, o_custkey, o_orderkey FROM orders),
        marked AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY o_custkey, o_orderkey) AS up,
            row_number() OVER (PARTITION BY shard ORDER BY o_custkey DESC, o_orderkey DESC) AS down FROM placed)
        SELECT shard, COUNT(*) AS "rows",
            MAX(CASE WHEN up = 1 THEN o_custkey END) AS min_o_custkey, MAX(CASE WHEN up = 1 THEN o_orderkey END) AS min_o_orderkey,
            MAX(CASE WHEN down = 1 THEN o_custkey END) AS max_o_custkey,
            MAX(CASE WHEN down = 1 THEN o_orderkey END) AS max_o_orderkey,
            CASE shard WHEN 0 THEN '(-Inf - 300)' WHEN 1 THEN '[300 - 600)' WHEN 2 THEN '[600 - 900)'
                WHEN 3 THEN '[900 - (1200,5000))' ELSE '[(1200,5000) - +Inf)' END AS bounds
        FROM marked GROUP BY shard"""
)
def shard_layout(spark, sf):
    return K.shard_layout(orders_by_customer(spark, sf))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, user_id, event_type, value, props FROM events"""
)
def dates_as_text(spark, sf):
    return K.dates_as_text(raw(spark, sf, "events"))


@query(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(CAST(o_custkey AS DECIMAL(22,0)) AS VARCHAR) AS o_custkey,
        CAST(CAST(o_totalprice AS DECIMAL(22,9)) AS VARCHAR) AS o_totalprice,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders"""
)
def typed_read(spark, sf):
    declared = {"o_orderkey": "Uint32", "o_custkey": "Uint64", "o_totalprice": "Decimal(22,9)", "o_orderdate": "Date32"}
    rows = K.typed(raw(spark, sf, "orders").select(*declared), declared)
    return rows.select("o_orderkey", *[F.col(c).cast("string") for c in ("o_custkey", "o_totalprice", "o_orderdate")])


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def prune_columns(spark, sf):
    return orders_by_key(spark, sf).read(columns=["o_orderkey", "o_orderpriority"])


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000 AND o_custkey < 1000")
def filter_and(spark, sf):
    rows = orders_by_key(spark, sf).read([("o_orderstatus", "=", "F"), ("o_totalprice", ">", 250000.0)])
    return rows.filter(F.col("o_custkey") < 1000)


@query(
    """SELECT p_partkey, p_size, flag FROM part, (VALUES ('eq'), ('lt'), ('le'), ('gt'), ('ge'), ('ne')) f(flag)
        WHERE CASE flag WHEN 'eq' THEN p_size = 20 WHEN 'lt' THEN p_size < 20 WHEN 'le' THEN p_size <= 20
            WHEN 'gt' THEN 20 < p_size WHEN 'ge' THEN 20 <= p_size ELSE p_size <> 20 END"""
)
def filter_compare(spark, sf):
    """Every comparison by the table's own conditions, literals on either side."""
    wanted = {
        "eq": ("p_size", "=", 20), "lt": ("p_size", "<", 20), "le": ("p_size", "<=", 20), "gt": (20, "<", "p_size"), "ge": (20, "<=", "p_size"),
        "ne": ("not", ("p_size", "=", 20)),
    }
    table = parts_hashed(spark, sf)
    sides = [table.read([c], ["p_partkey", "p_size"]).withColumn("flag", F.lit(flag)) for flag, c in wanted.items()]
    return functools.reduce(lambda a, b: a.unionAll(b), sides)


@query(
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT DISTINCT FROM NULL
        OR o_orderstatus IS NOT DISTINCT FROM 'F'"""
)
def filter_null_safe(spark, sf):
    rows = raw(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    known = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return rows.filter(known.eqNullSafe(F.lit(None)) | F.col("o_orderstatus").eqNullSafe("F"))


@query(
    """SELECT * FROM orders WHERE (o_totalprice > 400000 AND (o_custkey < 200 OR o_custkey > 1200))
        OR (NOT o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"""
)
def filter_or(spark, sf):
    dear = ("and", [("o_totalprice", ">", 400000.0), ("or", [("o_custkey", "<", 200), ("o_custkey", ">", 1200)])])
    urgent = ("and", [("not", ("o_orderstatus", "=", "F")), ("o_orderpriority", "in", ["1-URGENT", "2-HIGH"])])
    return orders_by_key(spark, sf).read([("or", [dear, urgent])])


@query("SELECT * FROM customer WHERE c_mktsegment LIKE 'MACH%'")
def filter_prefix(spark, sf):
    return customers_by_name(spark, sf).read([("c_mktsegment", "startswith", "MACH")])


@query("SELECT * FROM customer WHERE c_name LIKE '%7'")
def filter_suffix(spark, sf):
    return raw(spark, sf, "customer").filter(F.col("c_name").endswith("7"))


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE contains(text, ', de ')")
def filter_contains(spark, sf):
    return raw(spark, sf, "documents").filter(F.col("text").contains(", de ")).select("doc_id", "lang", "source", "n_chars")


@query("SELECT doc_id, substring(text, 3, 4) AS part, substring(text, 5) AS rest FROM documents WHERE substring(text, 2, 1) = 'e'")
def filter_substring(spark, sf):
    text = F.col("text")
    rows = raw(spark, sf, "documents").filter(F.substring(text, 2, 1) == "e")
    return rows.select("doc_id", F.substring(text, 3, 4).alias("part"), F.expr("substring(text, 5)").alias("rest"))


@query("SELECT doc_id, substring(hex(encode(text)), 5, 8) AS part FROM documents WHERE substring(hex(encode(text)), 3, 2) = '65'")
def filter_substring_bytes(spark, sf):
    rows = raw(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("bytes"))
    rows = rows.filter(F.substring("bytes", 2, 1) == F.expr("X'65'"))
    return rows.select("doc_id", F.hex(F.substring("bytes", 3, 4)).alias("part"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-02-03' AND o_orderdate < DATE '1999-01-01'")
def filter_date(spark, sf):
    """A table by day: literals as text, and as a value."""
    table = stored(
        spark,
        sf,
        "orders_by_day",
        lambda n, p: K.create_keyed(spark, n, raw(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")), "o_orderdate, o_orderkey", prefix=p, shards=4),
    )
    return table.read([("o_orderdate", ">=", "1997-02-03"), ("o_orderdate", "<", dt.date(1999, 1, 1))], ["o_orderkey", "o_custkey"])


@query(
    """SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-03 19:10:33.600001'
        AND ts <= TIMESTAMP '2024-01-20 00:00:00'"""
)
def filter_timestamp(spark, sf):
    """A table by time: literals as text, and as a value."""
    table = stored(
        spark,
        sf,
        "events_by_time",
        lambda n, p: K.create_keyed(spark, n, raw(spark, sf, "events"), "ts, event_id", prefix=p, shards=4),
    )
    where = [("ts", ">", "2024-01-03 19:10:33.600001"), ("ts", "<=", dt.datetime(2024, 1, 20))]
    return table.read(where, ["event_id", "user_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE hex(encode(c_mktsegment)) = '4D414348494E455259'")
def filter_binary(spark, sf):
    rows = raw(spark, sf, "customer").filter(F.encode("c_mktsegment", "UTF-8") == F.expr("X'4D414348494E455259'"))
    return rows.select("c_custkey", "c_name")


@query(
    """SELECT COUNT(*) FILTER (WHERE o_custkey > 700) AS flag_true, COUNT(*) FILTER (WHERE o_custkey <= 700) AS flag_false,
        COUNT(*) FILTER (WHERE o_orderkey - 7000 > 0) AS int32_above, COUNT(*) FILTER (WHERE o_orderkey - 7000 < -1) AS int64_below,
        COUNT(*) FILTER (WHERE o_custkey <= 200) AS uint32_low, COUNT(*) FILTER (WHERE o_custkey = 127) AS uint64_same,
        COUNT(*) FILTER (WHERE CAST(o_totalprice AS FLOAT) < 100000) AS float_low,
        COUNT(*) FILTER (WHERE o_totalprice >= 250000.5) AS double_high,
        COUNT(*) FILTER (WHERE CAST(o_totalprice AS DECIMAL(22,9)) <= 99999.99) AS decimal_low FROM orders"""
)
def filter_typed(spark, sf):
    rows = raw(spark, sf, "orders").select(
        (F.col("o_custkey") > 700).alias("flag"),
        (F.col("o_orderkey") - 7000).cast("int").alias("i32"),
        (F.col("o_orderkey") - 7000).alias("i64"),
        F.col("o_custkey").alias("u32"),
        F.col("o_custkey").alias("u64"),
        F.col("o_totalprice").alias("f"),
        F.col("o_totalprice").alias("d"),
        F.col("o_totalprice").alias("n"),
    )
    rows = K.typed(rows, {"u32": "Uint32", "u64": "Uint64", "f": "Float", "n": "Decimal(22,9)"})
    return rows.agg(
        F.count_if(F.col("flag") == F.lit(True)).alias("flag_true"),
        F.count_if(F.col("flag") < F.lit(True)).alias("flag_false"),
        F.count_if(F.col("i32") > 0).alias("int32_above"),
        F.count_if(F.col("i64") < -1).alias("int64_below"),
        F.count_if(F.col("u32") <= 200).alias("uint32_low"),
        F.count_if(F.col("u64") == 127).alias("uint64_same"),
        F.count_if(F.col("f") < F.lit(100000).cast("float")).alias("float_low"),
        F.count_if(F.col("d") >= 250000.5).alias("double_high"),
        F.count_if(F.col("n") <= F.lit("99999.99").cast("decimal(22,9)")).alias("decimal_low"),
    )


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 3500")
def limit_rows(spark, sf):
    return orders_by_key(spark, sf).read().orderBy("o_orderkey").limit(3500)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark, sf):
    rows = orders_by_key(spark, sf).read(columns=["o_orderkey", "o_totalprice"])
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT COUNT(*) AS n FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'")
def count_filtered(spark, sf):
    rows = raw(spark, sf, "lineitem").filter((F.col("l_quantity") > 25) & (F.col("l_returnflag") == "R"))
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT l_orderkey FROM lineitem")
def distinct_keys(spark, sf):
    return raw(spark, sf, "lineitem").select("l_orderkey").distinct()
