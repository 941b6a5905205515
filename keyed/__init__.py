"""Keyed tables on Spark: see README.md."""

from .functions.coerce import coerce, coerce_column, valid_json
from .functions.types import declare, logical_type, spark_type
from .operators.batches import batch_pack, write_batches
from .operators.buckets import publish_buckets
from .operators.check import bag_diff, pushdown_parity, table_diff
from .operators.evolve import add_columns, alter, drop_columns, reshard, resize
from .operators.index import create_index, index_lookup
from .operators.ranges import compare_keys, intersect_ranges, read_ranges, route_rows, touched_shards
from .operators.report import rank_in_shard, shard_layout
from .operators.write import (
    bulk_upsert,
    create_keyed,
    insert,
    latest,
    overwrite,
    replace_rows,
    truncate,
    upsert,
)
from .plans.bounds import KeyRange, key_range
from .plans.layout import Layout, derive_splits, shard_count
from .sources.files import work_root
from .sources.scan import dates_as_text, load, query, typed
from .sources.table import KeyedTable

__all__ = [name for name in dir() if not name.startswith("_")]
