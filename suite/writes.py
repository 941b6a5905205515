"""Keyed writes, schema and layout changes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

import keyed as K

from .reads import ORDER_SHARD
from .tables import ORDER_SPLITS, fresh, orders_by_key, raw

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return register


def _orders(spark, sf, name):
    return fresh(spark, sf, name, raw(spark, sf, "orders"), "o_orderkey", splits=ORDER_SPLITS)


NEW_ORDERS = """SELECT -1 - o_orderkey AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders"""


@query(f"SELECT * FROM orders UNION ALL {NEW_ORDERS}")
def write_insert(spark, sf):
    rows = raw(spark, sf, "orders").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return K.insert(_orders(spark, sf, "insert"), rows).table.read()


@query(
    """WITH batch AS (
            SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice * 1.5 END AS o_totalprice
            FROM orders WHERE o_orderstatus = 'F'
            UNION ALL SELECT -1 - o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW')
        SELECT coalesce(o.o_orderkey, b.o_orderkey) AS o_orderkey, o.o_custkey, o.o_orderstatus,
            CASE WHEN b.o_orderkey IS NULL THEN o.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
            o.o_orderdate, o.o_orderpriority
        FROM orders o FULL JOIN batch b ON o.o_orderkey = b.o_orderkey"""
)
def write_upsert(spark, sf):
    orders = raw(spark, sf, "orders")
    price = F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_totalprice") * 1.5).alias("o_totalprice")
    changed = orders.filter("o_orderstatus = 'F'").select("o_orderkey", price)
    added = orders.filter("o_orderpriority = '5-LOW'").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice")
    return K.upsert(_orders(spark, sf, "upsert"), changed.unionByName(added)).table.read()


@query(
    """WITH batch AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_totalprice * 2 AS o_totalprice
            FROM orders WHERE o_orderstatus = 'F')
        SELECT o.* FROM orders o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
        UNION ALL SELECT o_orderkey, o_custkey, NULL, o_totalprice, NULL, NULL FROM batch"""
)
def write_replace(spark, sf):
    rows = raw(spark, sf, "orders").filter("o_orderstatus = 'F'")
    batch = rows.selectExpr("o_orderkey", "o_custkey + 1 AS o_custkey", "o_totalprice * 2 AS o_totalprice")
    return K.replace_rows(_orders(spark, sf, "replace"), batch).table.read()


@query(
    """WITH batch AS (
            SELECT l_orderkey AS o_orderkey, l_partkey AS o_custkey, l_linestatus AS o_orderstatus,
                l_extendedprice AS o_totalprice, l_shipdate AS o_orderdate, l_returnflag AS o_orderpriority
            FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC,
                l_partkey DESC, l_linestatus DESC, l_returnflag DESC) = 1)
        SELECT * FROM batch UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)"""
)
def write_bulk_upsert(spark, sf):
    batch = raw(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey",
        "l_partkey AS o_custkey",
        "l_linestatus AS o_orderstatus",
        "l_extendedprice AS o_totalprice",
        "l_shipdate AS o_orderdate",
        "l_returnflag AS o_orderpriority",
    )
    order = ["o_orderdate", "o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return K.bulk_upsert(_orders(spark, sf, "bulk"), batch, order_by=order).table.read()


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderkey FROM orders")
def write_indexed(spark, sf):
    orders = raw(spark, sf, "orders")
    table = fresh(
        spark, sf, "indexed", orders, "o_orderkey", splits=ORDER_SPLITS, indexes={"by_customer": ["o_custkey"]}
    )
    moved = orders.filter("o_orderstatus = 'F'").selectExpr("o_orderkey", "o_custkey + 1 AS o_custkey")
    return K.upsert(table, moved).table.index("by_customer")


@query("SELECT * FROM orders WHERE o_orderstatus = 'O'")
def write_overwrite(spark, sf):
    table = _orders(spark, sf, "overwrite")
    return K.overwrite(table, table.read([("o_orderstatus", "=", "O")])).table.read()


@query("SELECT * FROM customer")
def create_keyed(spark, sf):
    return fresh(spark, sf, "create", raw(spark, sf, "customer"), " , c_nationkey, c_custkey,,", shards=4).read()


@query("SELECT COUNT(*) AS row_count, COUNT(*) AS distinct_keys FROM lineitem")
def auto_key(spark, sf):
    table = fresh(spark, sf, "auto", raw(spark, sf, "lineitem"), None, shards=4)
    return table.read().agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("_spark_key").alias("distinct_keys")
    )


CTAS = """SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_totalprice) AS max_price FROM orders GROUP BY o_custkey"""
CTAS_MORE = """SELECT -1 - c_custkey AS o_custkey, CAST(0 AS BIGINT) AS n_orders, c_acctbal AS max_price FROM customer"""


@query(f"{CTAS} UNION ALL {CTAS_MORE}")
def ctas(spark, sf):
    views = {"orders": raw(spark, sf, "orders"), "customer": raw(spark, sf, "customer")}
    table = fresh(spark, sf, "ctas", K.query(spark, CTAS, views), "o_custkey", shards=4)
    return K.insert(table, K.query(spark, CTAS_MORE, views)).table.read()


@query("SELECT * FROM part")
def copy_files(spark, sf):
    parts = raw(spark, sf, "part")
    other = parts.filter("p_partkey % 2 = 0").select("p_partkey", *(F.lit(None).cast(f.dataType).alias(f.name) for f in parts.schema if f.name != "p_partkey"))
    table = fresh(spark, sf, "copy", other.select(parts.columns), "p_partkey", shards=4)
    return K.bulk_upsert(table, K.load(spark, f"{sf}/part.parquet")).table.read()


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def write_by_name(spark, sf):
    rows = raw(spark, sf, "customer")
    table = fresh(spark, sf, "by_name", rows.filter("false"), "c_custkey", splits=[500, 1000])
    return K.insert(table, rows.select("c_mktsegment", "c_acctbal", "c_custkey", "c_nationkey", "c_name")).table.read()


@query("SELECT * FROM supplier")
def not_null_guard(spark, sf):
    rows = raw(spark, sf, "supplier")
    schema = T.StructType([T.StructField(f.name, f.dataType, False) for f in rows.schema])
    return fresh(spark, sf, "not_null", rows, "s_suppkey", schema=schema, splits=[50]).read()


@query(
    """SELECT COUNT(*) AS rows_written,
        CAST(SUM(strlen(c_name) + strlen(c_mktsegment)) AS BIGINT) AS text_bytes FROM customer"""
)
def write_observed(spark, sf):
    rows = raw(spark, sf, "customer")
    table = fresh(spark, sf, "observed", rows.filter("false"), "c_custkey", splits=[500, 1000])
    done = K.upsert(table, rows)
    return spark.createDataFrame([(done.rows, done.payload_bytes)], "rows_written bigint, text_bytes bigint")


@query(
    f"""WITH ranked AS (SELECT CAST({ORDER_SHARD} AS INTEGER) AS shard,
            row_number() OVER (PARTITION BY {ORDER_SHARD} ORDER BY o_orderkey) AS rn FROM orders)
        SELECT shard, CAST(floor((rn - 1) / 1000) AS BIGINT) AS batch, COUNT(*) AS rows_in_batch FROM ranked GROUP BY 1, 2"""
)
def batch_pack(spark, sf):
    rows = orders_by_key(spark, sf).read(columns=["o_orderkey"], with_shard=True).withColumnRenamed("_shard", "shard")
    packed = K.batch_pack(rows, ["o_orderkey"], "shard", rows=1000)
    return packed.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("rows_in_batch"))


@query(
    """WITH RECURSIVE sized AS (
            SELECT CAST(CASE WHEN c_custkey < 500 THEN 0 WHEN c_custkey < 1000 THEN 1 ELSE 2 END AS INTEGER) AS shard, c_custkey,
                8 + 4 + 4 + strlen(c_name) + strlen(c_mktsegment) AS size FROM customer
        ), placed AS (
            SELECT shard, c_custkey, size, row_number() OVER (PARTITION BY shard ORDER BY c_custkey) AS rn FROM sized
        ), steps AS (
            SELECT shard, rn, c_custkey, 0 AS batch, 1 AS n, size AS bytes FROM placed WHERE rn = 1
            UNION ALL
            SELECT p.shard, p.rn, p.c_custkey, CASE WHEN s.n >= 40 OR s.bytes >= 1500 THEN s.batch + 1 ELSE s.batch END,
                CASE WHEN s.n >= 40 OR s.bytes >= 1500 THEN 1 ELSE s.n + 1 END,
                CASE WHEN s.n >= 40 OR s.bytes >= 1500 THEN p.size ELSE s.bytes + p.size END
            FROM steps s JOIN placed p ON p.shard = s.shard AND p.rn = s.rn + 1
        )
        SELECT shard, c_custkey, CAST(batch AS BIGINT) AS batch FROM steps"""
)
def batch_pack_bytes(spark, sf):
    """Batches closed at 40 rows or 1,500 bytes of all columns, whichever comes first."""
    table = fresh(spark, sf, "flush", raw(spark, sf, "customer"), "c_custkey", splits=[500, 1000])
    rows = table.read(with_shard=True).withColumnRenamed("_shard", "shard")
    packed = K.batch_pack(rows.drop("c_acctbal"), ["c_custkey"], "shard", rows=40, max_bytes=1500)
    return packed.select("shard", "c_custkey", "batch")


@query("SELECT * FROM orders WHERE o_orderstatus = 'P'")
def truncate(spark, sf):
    """Nothing of what a table held is left; it takes rows again."""
    table = K.truncate(_orders(spark, sf, "truncate")).table
    return K.insert(table, raw(spark, sf, "orders").filter("o_orderstatus = 'P'")).table.read()


@query("SELECT *, CAST(NULL AS VARCHAR) AS o_note, CAST(NULL AS BIGINT) AS o_weight FROM orders")
def add_column(spark, sf):
    table = _orders(spark, sf, "add")
    return K.add_columns(table, T.StructField("o_note", T.StringType()), T.StructField("o_weight", T.LongType())).table.read()


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_column(spark, sf):
    return K.drop_columns(_orders(spark, sf, "drop"), "o_orderstatus", "o_orderpriority").table.read()


@query(
    """SELECT CAST(CASE WHEN o_orderkey < 1000 THEN 0 WHEN o_orderkey < 7500 THEN 1 ELSE 2 END AS INTEGER) AS shard,
        COUNT(*) AS rows_in_shard FROM orders GROUP BY 1"""
)
def reshard(spark, sf):
    table = K.reshard(_orders(spark, sf, "reshard"), splits=[1000, 7500]).table
    rows = table.read(columns=[], with_shard=True)
    return rows.groupBy(F.col("_shard").alias("shard")).agg(F.count(F.lit(1)).alias("rows_in_shard"))


@query("SELECT *, TRUE AS balanced, TRUE AS others_kept FROM orders")
def resize_shards(spark, sf):
    """One shard is split by size and small neighbours become one; a shard in between keeps its files."""
    orders = raw(spark, sf, "orders")
    table = fresh(spark, sf, "resize", orders, "o_orderkey", splits=[10, 20, 1000, 1300], rows_per_file=100)
    sizes = table.base.stored(spark, table.base.live)
    most = max(sum(z.size for z in zones) for zones in sizes.values())
    kept = set(table.read([("o_orderkey", ">=", 1000), ("o_orderkey", "<", 1300)]).inputFiles())
    done = K.resize(table, max_mb=most / 1.5 / (1 << 20), min_mb=sum(z.size for s in (0, 1) for z in sizes[s]) / (1 << 20)).table
    after = [sum(z.size for z in zones) for zones in done.base.stored(spark, done.base.live).values()]
    same = kept == set(done.read([("o_orderkey", ">=", 1000), ("o_orderkey", "<", 1300)]).inputFiles())
    return done.read().withColumns({"balanced": F.lit(max(after) < most), "others_kept": F.lit(same)})
