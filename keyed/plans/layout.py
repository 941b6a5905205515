"""Where a key lives: range layouts by split points, hash layouts by key hash."""

from __future__ import annotations

import base64
import datetime as dt
import json
import math
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bounds import KeyRange, cut_key, instant_text, literal, lower_cut, upper_cut

TREE_SPLITS = 64
MIN_SHARD_MB = 10


def key_struct(columns: Sequence[Column | str]) -> Column:
    """Key tuple as one value with fixed field names; Spark orders it field by field, nulls lowest."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(columns)])


def tuple_array(rows: Sequence[tuple], types: Sequence[T.DataType]) -> Column:
    """Constant array of keys (plain values for one key column, structs for several), folded to one literal.

    Values travel as text and are cast, so a value that does not fit its type is an error, not a null.
    """
    texts = [T.BinaryType() if isinstance(t, T.BinaryType) else T.StringType() for t in types]
    if len(types) == 1:
        data, stored, element = [_text(row[0], types[0]) for row in rows], texts[0], types[0]
    else:
        data = [{f"k{i}": _text(v, types[i]) for i, v in enumerate(row)} for row in rows]
        stored, element = _key_type(texts), _key_type(types)
    wrapped = T.StructType([T.StructField("keys", T.ArrayType(stored))])
    return F.from_json(F.lit(json.dumps({"keys": data})), wrapped)["keys"].cast(T.ArrayType(element))


def _key_type(types: Sequence[T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(f"k{i}", t) for i, t in enumerate(types)])


def _text(value: Any, dtype: T.DataType) -> str | None:
    if isinstance(value, (bytes, bytearray)):
        return base64.b64encode(value).decode("ascii")
    if isinstance(dtype, T.TimestampType) and value is not None:
        return instant_text(value)
    if isinstance(value, dt.timedelta):
        micros = value // dt.timedelta(microseconds=1)
        days, rest = divmod(abs(micros), 86_400_000_000)
        hours, minutes, seconds = rest // 3_600_000_000, rest // 60_000_000 % 60, rest // 1_000_000 % 60
        return f"{'-' * (micros < 0)}{days} {hours:02}:{minutes:02}:{seconds:02}.{rest % 1_000_000:06}"
    return None if value is None else str(value)


def int_array(values: Sequence[int]) -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), T.ArrayType(T.LongType()))


def splits_before(keys: Sequence[Column], types: Sequence[T.DataType], splits: Sequence[tuple]) -> Column:
    """Number of split points at or below the key: a CASE tree for few splits, a binary search for many."""
    if len(splits) <= TREE_SPLITS:
        return _split_tree(keys, types, splits, 0, len(splits))
    return count_splits(keys, types, splits)


def count_splits(keys: Sequence[Column], types: Sequence[T.DataType], splits: Sequence[tuple], at: bool = True) -> Column:
    """Number of rising tuples below (``at``: or equal to) the key, nulls lowest, found by ever smaller jumps."""
    key, points = keys[0] if len(types) == 1 else key_struct(keys), tuple_array(splits, types)

    def passed(index: Column) -> Column:
        # Past the end there is no point and the comparison is null, which counts as no.
        return (F.get(points, index) <= key) if at else (F.get(points, index) < key)

    def jump(found: Column, width: Column) -> Column:
        return F.when(passed(found + width - 1), found + width).otherwise(found)

    # The first comparison stands outside the lambda: the optimizer must see which columns the count depends on.
    half = (len(splits) + 1) // 2
    start = F.when(passed(F.lit(half - 1)), F.lit(half)).otherwise(F.lit(0))
    widths = [1 << i for i in reversed(range((len(splits) - half).bit_length()))]
    jumps = F.from_json(F.lit(json.dumps(widths)), "array<int>")
    # Never null, so that a join on the count does not compute it a second time to filter nulls out.
    return F.coalesce(F.aggregate(jumps, start, jump), F.lit(0))


def _split_tree(keys, types, splits, lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    at_or_above = _at_or_above(keys, types, splits[mid])
    return F.when(at_or_above, _split_tree(keys, types, splits, mid + 1, hi)).otherwise(
        _split_tree(keys, types, splits, lo, mid)
    )


def _at_or_above(keys, types, point: tuple) -> Column:
    out = None
    for i in range(len(point) - 1, -1, -1):
        lit = literal(point[i], types[i])
        out = keys[i] >= lit if out is None else (keys[i] > lit) | ((keys[i] == lit) & out)
    return out


@dataclass(frozen=True)
class Layout:
    store: str
    shards: int
    splits: tuple[tuple, ...] = ()

    def __post_init__(self):
        if self.store not in ("range", "hash"):
            raise ValueError(f"unknown store {self.store!r}")
        if self.store == "range":
            ordered = sorted(self.splits, key=lambda s: cut_key((s, -1)))
            if list(self.splits) != ordered or len(set(self.splits)) != len(self.splits):
                raise ValueError("split points must rise strictly")

    @staticmethod
    def by_splits(splits: Sequence[Any]) -> Layout:
        points = tuple(s if isinstance(s, tuple) else (s,) for s in splits)
        return Layout("range", len(points) + 1, points)

    @staticmethod
    def by_hash(shards: int) -> Layout:
        return Layout("hash", shards)

    def shard_of(self, keys: Sequence[Column], types: Sequence[T.DataType]) -> Column:
        if self.store == "hash":
            return F.pmod(F.hash(*keys), F.lit(self.shards)).cast("int")
        return splits_before(keys, types, self.splits).cast("int")

    def bounds(self, shard: int) -> KeyRange:
        if self.store == "hash":
            return KeyRange()
        lo = self.splits[shard - 1] if shard else ()
        hi = self.splits[shard] if shard < len(self.splits) else ()
        return KeyRange(lo, hi, bool(lo), False)

    def shards_in(self, r: KeyRange) -> range:
        """Shards whose bounds overlap the range, found by bisection."""
        if self.store == "hash":
            return range(self.shards)
        cuts = [cut_key((s, -1)) for s in self.splits]
        return range(bisect_right(cuts, cut_key(lower_cut(r))), bisect_left(cuts, cut_key(upper_cut(r))) + 1)


def quantiles(weighed: Sequence[tuple[tuple, float]], parts: int) -> list[tuple]:
    """At most ``parts - 1`` rising keys that cut sorted weights into about equal parts; each key begins a part."""
    total, passed, out = sum(w for _, w in weighed), 0.0, []
    for i, (key, weight) in enumerate(weighed):
        if i and passed >= total * (len(out) + 1) / parts and len(out) + 1 < parts and cut_key((key, -1)) > cut_key((weighed[i - 1][0], -1)):
            out.append(key)
        passed += weight
    return out


def shard_count(size_bytes: int, size_mb: int = 1000, min_shards: int = 1, max_shards: int | None = None) -> int:
    """Number of shards for a table of this size; it grows with the table unless ``max_shards`` is given."""
    low = max(1, min_shards)
    if max_shards is not None and max_shards < low:
        raise ValueError(f"at most {max_shards} shards, but at least {low}")
    wanted = max(math.ceil(size_bytes / (max(MIN_SHARD_MB, size_mb) * 1024 * 1024)), low)
    return wanted if max_shards is None else min(wanted, max_shards)


def derive_splits(df: DataFrame, keys: Sequence[str], shards: int, sample_per_shard: int = 200) -> list[tuple]:
    """Split points from a sample of the key columns; only ``shards - 1`` key tuples reach the driver.

    The sample decides where shards begin, never which rows are stored.
    """
    if shards <= 1:
        return []
    rows = df.count()
    if rows == 0:
        return []
    sample = df.select(*keys).dropna(subset=list(keys)).sample(fraction=min(1.0, shards * sample_per_shard / rows), seed=7)
    firsts = (
        sample.repartitionByRange(shards, *keys)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(key_struct(keys)).alias("first"))
        .select("first.*")
        .collect()
    )
    points = sorted({tuple(r) for r in firsts}, key=lambda s: cut_key((s, -1)))
    return points[1:]
