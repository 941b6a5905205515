"""Index tables: a projection with its own keys (index columns, then the primary key) and its own shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.layout import key_struct
from ..plans.rangeset import EVERY, Node, RangeSet, as_column, columns_of, key_set, null_can_pass
from ..sources.table import SHARD, KeyedTable
from .write import WriteResult, build_index


def create_index(table: KeyedTable, name: str, columns: Sequence[str], splits: Sequence | None = None) -> WriteResult:
    if name in table.indexes:
        raise ValueError(f"index {name} exists already")
    return WriteResult(table.commit(indexes={**table.indexes, name: build_index(table, name, columns, splits)}))


def index_lookup(table: KeyedTable, name: str, where: Sequence[Sequence]) -> DataFrame:
    """Rows of the table that match all conditions, found by the index: it gives the keys, the keys give the rows.

    Conditions on columns of the index choose its shards and files and are compared on its entries, nulls included
    (``<=> NULL``); others are compared on the rows. The matching entries name the shards to open and, by their least and
    greatest key in each, the files (two keys for each shard reach the driver).
    """
    index = table.indexes[name]
    given = table.conditions(where)
    held = set(index.schema.names)
    on_entries = [p for p in given.parts if columns_of(p) <= held]
    # an index holds rows whose index columns are null, which no set of ranges names: only conditions that nulls cannot pass choose
    choosing = Node("and", tuple(p for p in on_entries if not null_can_pass(p)))
    found = key_set(index.keys, choosing)
    entries = index.read(table.spark, index.holding(table.spark, found), None if found == EVERY else found)
    for p in on_entries:
        entries = entries.filter(as_column(p, table.schema))
    routed = entries.select(*table.keys).withColumn(SHARD, table.base.shard_column())
    key = key_struct(table.keys)
    ends = routed.groupBy(SHARD).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()  # one row per shard
    spans = RangeSet.of([((tuple(r.lo), -1), (tuple(r.hi), 1)) for r in ends])
    rows = table.base.read(table.spark, [r[SHARD] for r in ends if r[SHARD] in table.base.live], spans)
    for p in given.parts:
        rows = rows.filter(as_column(p, table.schema))  # reaches the Parquet scan
    return rows.join(routed, [SHARD, *table.keys], "left_semi").select(*table.schema.names)
