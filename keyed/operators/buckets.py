"""Hash tables as bucketed catalog tables, whose joins by key Spark plans without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.table import KeyedTable


def publish_buckets(table: KeyedTable, name: str, folder: str | None = None) -> DataFrame:
    """The rows of a hash table as the catalog table ``name``, with a bucket for each shard, sorted by key; returns it.

    Spark then knows where each key is: joins, diffs and aggregates by the key with another such table of as many buckets
    need no exchange. The files lie in ``folder``, by default beside the table's own. The catalog table is of the version that
    was read; publishing again replaces it.
    """
    if table.layout.store != "hash":
        raise ValueError("only a hash layout has buckets")
    spark, keys = table.spark, list(table.keys)
    path = folder or f"{table.path}/buckets-{table.version:08d}"
    rows = table.read().repartition(table.layout.shards, *keys)  # the hash of a bucket, so each is one task and one file
    rows.write.mode("overwrite").option("path", path).bucketBy(table.layout.shards, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)
