"""Times the headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON.

Every case runs once to warm up and then three times; the median counts. Reads end in a count of all their rows with every
column in use, writes end when the new version is published.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import keyed as K  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    for key, value in {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    root = f"{K.work_root(spark)}/bench"
    load = lambda name: K.load(spark, f"{name}.parquet", SF)
    orders, lineitem, customer = load("orders"), load("lineitem"), load("customer")
    last = orders.agg(F.max("o_orderkey")).first()[0] + 1
    splits = [i * last // 16 for i in range(1, 16)]
    serial = iter(range(10**6))

    def create(name: str, df, keys, **options) -> K.KeyedTable:
        return K.create_keyed(spark, f"{name}-{next(serial)}", df, keys, prefix=root, **options).table

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    by_key = create("orders", orders, "o_orderkey", splits=splits)
    by_customer = create("by_customer", orders, "o_custkey,o_orderkey", shards=16)
    indexed = create("indexed", orders, "o_orderkey", splits=splits, indexes={"by_customer": ["o_custkey"]})
    lines = create("lineitem", lineitem, None, shards=16)
    line_keys = lines.read().filter(F.pmod(F.xxhash64("_spark_key"), F.lit(100)) == 0)
    line_batch = line_keys.select("_spark_key", (F.col("l_quantity") + 1).alias("l_quantity"))
    in_one_shard = orders.filter(F.col("o_orderkey") < splits[0]).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    everywhere = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    ranges = customer.select(
        F.col("c_custkey").alias("a"),
        F.struct(F.col("c_custkey").alias("k")).alias("lo"),
        F.struct((F.col("c_custkey") + F.col("c_nationkey")).alias("k")).alias("hi"),
        F.lit(True).alias("lo_incl"),
        F.lit(False).alias("hi_incl"),
    )
    shards = ranges.filter(F.col("a") % 100 == 0).withColumnRenamed("a", "b")
    key = [("o_orderkey", "=", last // 2)]

    def latest(table: K.KeyedTable) -> K.KeyedTable:
        return K.KeyedTable.open(spark, table.path)

    cases = {
        "describe_table": lambda: latest(by_key),
        "limit_5": lambda: by_key.read().limit(5).collect(),
        "full_scan": lambda: run(by_key.read()),
        "range_read_point": lambda: run(by_key.read(key)),
        "range_read_prefix": lambda: run(by_customer.read([("o_custkey", "=", 5), ("o_orderkey", ">", 3000)])),
        "range_read_shard": lambda: run(by_key.read([("o_orderkey", "<", splits[0])])),
        "index_lookup": lambda: run(K.index_lookup(indexed, "by_customer", [("o_custkey", "=", 5)])),
        "shard_layout": lambda: run(K.shard_layout(by_key)),
        "create_keyed": lambda: create("create", orders, "o_orderkey", splits=splits),
        "insert": lambda: K.insert(latest(by_key), orders.withColumn("o_orderkey", last * (2 + next(serial)) + F.col("o_orderkey"))),
        "bulk_upsert_one_shard": lambda: K.bulk_upsert(latest(by_customer_free), in_one_shard),
        "bulk_upsert_all_shards": lambda: K.bulk_upsert(latest(by_customer_free), everywhere),
        "upsert_1pct_lineitem": lambda: K.upsert(latest(lines), line_batch),
        "upsert_indexed": lambda: K.upsert(latest(indexed), in_one_shard.select("o_orderkey", "o_custkey")),
        "route_rows": lambda: run(K.route_rows(orders.select("o_custkey", "o_totalprice"), ["o_custkey"], ranges)),
        "range_intersect": lambda: run(K.intersect_ranges(ranges, shards)),
        "touched_shards": lambda: run(K.touched_shards(by_customer, ranges)),
        "table_diff": lambda: run(K.table_diff(orders, everywhere, ["o_orderkey"])),
        "coerce": lambda: run(K.typed(orders, {"o_custkey": "Uint64", "o_totalprice": "Decimal(22,9)"})),
        "distinct_keys": lambda: run(lineitem.select("l_orderkey").distinct()),
    }
    by_customer_free = create("free", orders, "o_orderkey", splits=splits)
    times = {}
    for name, case in cases.items():
        taken = []
        for _ in range(4):
            start = time.perf_counter()
            case()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 4)
    files = {
        "full_scan": len(by_key.read().inputFiles()),
        "range_read_shard": len(by_key.read([("o_orderkey", "<", splits[0])]).inputFiles()),
        "range_read_point": len(by_key.read(key).inputFiles()),
    }
    total = round(sum(times.values()), 4)
    print(json.dumps({"metric": "total of medians", "value": total, "unit": "sec", "queries": times, "files": files, "sf": SF}))
    spark.stop()


if __name__ == "__main__":
    main()
