"""Comparing tables, and checking that push-down does not change results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.rangeset import as_column
from ..sources.table import SHARD, KeyedTable


def same_schema(left: DataFrame, right: DataFrame) -> None:
    a = [(f.name, f.dataType) for f in left.schema]
    b = [(f.name, f.dataType) for f in right.schema]
    if a != b:
        raise ValueError(f"schemas differ: {a} and {b}")


def table_diff(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ, with ``diff`` = only_left, only_right or changed. Nulls equal nulls, bytes by content."""
    same_schema(left, right)
    others = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(F.lit(1), *others).alias("_a"))
    b = right.select(*keys, F.struct(F.lit(1), *others).alias("_b"))
    joined = a.join(b, list(keys), "full_outer")
    changed = ~F.col("_a").eqNullSafe(F.col("_b"))
    diff = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").when(changed, "changed")
    return joined.select(*keys, diff.alias("diff")).filter(F.col("diff").isNotNull())


def bag_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other; ``surplus`` is positive where the left side has more.

    Equal rows are summed before the shuffle, so many copies of one row stay cheap.
    """
    same_schema(left, right)
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    return both.groupBy(*left.columns).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)


def read_without_pushdown(table: KeyedTable, where: Sequence[tuple]) -> DataFrame:
    """The same rows as ``table.read(where)`` from a scan of every shard with filters the file reader cannot use."""
    df = table.base.read(table.spark).drop(SHARD)
    hidden = as_column(table.conditions(where), table.schema)
    return df.filter(F.element_at(F.array(hidden), 1))


def pushdown_parity(table: KeyedTable, where: Sequence[tuple]) -> DataFrame:
    """Differences between a pruned and an unpruned read; empty when push-down is right."""
    return table_diff(table.read(where), read_without_pushdown(table, where), table.keys)
