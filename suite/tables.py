"""Inputs of the registered queries: the given Parquet tables, and keyed tables written from them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

import keyed as K

ORDER_SPLITS = [3000, 6000, 9000, 12000]
CUSTOMER_SPLITS = [(300,), (600,), (900,), (1200, 5000)]


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return K.load(spark, f"{name}.parquet", sf)


def folder(spark: SparkSession, sf: str) -> str:
    return f"{K.work_root(spark)}/{hashlib.sha256(sf.encode()).hexdigest()[:12]}"


def stored(spark: SparkSession, sf: str, name: str, create: Callable[[str, str], object]) -> K.KeyedTable:
    """A table that several queries read: written once per application."""
    prefix = folder(spark, sf)
    if not K.KeyedTable.exists(spark, name, prefix):
        create(name, prefix)
    return K.KeyedTable.open(spark, name, prefix)


def stored_together(spark: SparkSession, sf: str, creates: dict[str, Callable[[str, str], object]], at_once: int = 5) -> dict[str, K.KeyedTable]:
    """Tables that do not need each other, some written at the same time: one's last tasks and planning leave cores free."""
    folder(spark, sf)  # names the work folder before threads ask for it
    with ThreadPoolExecutor(at_once) as pool:
        made = {n: pool.submit(inheritable_thread_target(spark)(stored), spark, sf, n, create) for n, create in creates.items()}
        return {n: table.result() for n, table in made.items()}


def fresh(spark: SparkSession, sf: str, name: str, df: DataFrame, keys: str | None, **options) -> K.KeyedTable:
    """A table that one query writes to."""
    prefix = folder(spark, sf)
    return K.create_keyed(spark, f"{name}-{uuid.uuid4().hex[:8]}", df, keys, prefix=prefix, **options).table


def orders_by_key(spark: SparkSession, sf: str) -> K.KeyedTable:
    return stored(
        spark,
        sf,
        "orders_by_key",
        lambda n, p: K.create_keyed(spark, n, raw(spark, sf, "orders"), "o_orderkey", prefix=p, splits=ORDER_SPLITS),
    )


def orders_by_customer(spark: SparkSession, sf: str) -> K.KeyedTable:
    return stored(
        spark,
        sf,
        "orders_by_customer",
        lambda n, p: K.create_keyed(
            spark, n, raw(spark, sf, "orders"), "o_custkey, o_orderkey", prefix=p, splits=CUSTOMER_SPLITS
        ),
    )


def indexed_orders(spark: SparkSession, sf: str) -> K.KeyedTable:
    return stored(
        spark,
        sf,
        "indexed_orders",
        lambda n, p: K.create_keyed(
            spark,
            n,
            raw(spark, sf, "orders"),
            "o_orderkey",
            prefix=p,
            splits=ORDER_SPLITS,
            indexes={"by_customer": ["o_custkey"]},
        ),
    )


def customers_by_name(spark: SparkSession, sf: str) -> K.KeyedTable:
    return stored(
        spark,
        sf,
        "customers_by_name",
        lambda n, p: K.create_keyed(
            spark,
            n,
            raw(spark, sf, "customer"),
            "c_name",
            prefix=p,
            splits=["Customer#000000500", "Customer#000001000"],
        ),
    )


def orders_in_one_shard(spark: SparkSession, sf: str) -> K.KeyedTable:
    """One large shard of many files, each of a narrow key range."""
    return stored(
        spark,
        sf,
        "orders_in_one_shard",
        lambda n, p: K.create_keyed(spark, n, raw(spark, sf, "orders"), "o_orderkey", prefix=p, shards=1, rows_per_file=200),
    )


def orders_in_files(spark: SparkSession, sf: str) -> K.KeyedTable:
    """The shards of orders_by_key, each in several files of two generations."""

    def create(name: str, prefix: str) -> None:
        orders = raw(spark, sf, "orders")
        table = K.create_keyed(spark, name, orders.filter("o_orderkey % 3 > 0"), "o_orderkey", prefix=prefix, splits=ORDER_SPLITS, rows_per_file=200).table
        K.insert(table, orders.filter("o_orderkey % 3 = 0"))

    return stored(spark, sf, "orders_in_files", create)


def parts_hashed(spark: SparkSession, sf: str) -> K.KeyedTable:
    return stored(
        spark,
        sf,
        "parts_hashed",
        lambda n, p: K.create_keyed(spark, n, raw(spark, sf, "part"), "p_partkey", prefix=p, store="hash", shards=8),
    )
