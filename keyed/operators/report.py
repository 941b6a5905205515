"""Reports over a table's layout, and positions of rows within their shard."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.bounds import cut_key
from ..plans.layout import derive_splits, key_struct, splits_before
from ..sources.table import SHARD, KeyedTable

ROWS_PER_BIN = 1_000_000


def shard_layout(table: KeyedTable) -> DataFrame:
    """Rows, first and last key and declared key bounds of every shard that holds rows, from the record of its files."""
    stored = table.base.stored(table.spark, sorted(table.base.live))
    if stored is not None:
        return _recorded(table, stored)
    rows = table.read(columns=table.keys, with_shard=True)
    key = key_struct(table.keys)
    found = rows.groupBy(F.col(SHARD).alias("shard")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last")
    )
    texts = [str(table.layout.bounds(s)) for s in range(table.layout.shards)]
    bounds = F.get(F.from_json(F.lit(json.dumps(texts)), "array<string>"), F.col("shard"))
    return found.select(
        "shard",
        "rows",
        *[F.col("first")[f"k{i}"].alias(f"min_{k}") for i, k in enumerate(table.keys)],
        *[F.col("last")[f"k{i}"].alias(f"max_{k}") for i, k in enumerate(table.keys)],
        bounds.alias("bounds"),
    )


def _recorded(table: KeyedTable, stored: dict) -> DataFrame:
    def ends(side: str) -> list[T.StructField]:
        return [T.StructField(f"{side}_{k}", t) for k, t in zip(table.keys, table.base.key_types())]

    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("rows", T.LongType()), *ends("min"), *ends("max"), T.StructField("bounds", T.StringType())])
    out = []
    for shard, zones in stored.items():
        first = min((z.first for z in zones), key=lambda k: cut_key((k, -1)))
        last = max((z.last for z in zones), key=lambda k: cut_key((k, -1)))
        out.append((shard, sum(z.rows for z in zones), *first, *last, str(table.layout.bounds(shard))))
    return table.spark.createDataFrame(out, schema)


def rank_in_shard(df: DataFrame, keys: Sequence[str], shard: str, name: str = "rank") -> DataFrame:
    """Position of every row in key order within its shard, from 1.

    Shards of ordinary size are ranked by one window. A shard too big for one task is cut into key bins: rows are ranked
    within their bin, and the rows of earlier bins are added.
    """
    total, largest = (
        df.groupBy(shard).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    )
    if largest <= ROWS_PER_BIN:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(shard).orderBy(*keys)).cast("bigint"))
    order = [shard, *keys]
    bins = -(-total // ROWS_PER_BIN)
    points = derive_splits(df, order, bins)
    types = [df.schema[c].dataType for c in order]
    binned = df.withColumn("_bin", splits_before([F.col(c) for c in order], types, points))
    before = Window.partitionBy(shard).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        binned.groupBy(shard, "_bin")
        .count()
        .select(shard, "_bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    inner = F.row_number().over(Window.partitionBy(shard, "_bin").orderBy(*keys))
    ranked = binned.withColumn("_inner", inner).join(offsets, [shard, "_bin"])
    return ranked.withColumn(name, F.col("_before") + F.col("_inner")).select(*df.columns, name)
