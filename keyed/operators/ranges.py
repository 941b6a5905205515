"""Key ranges as data: route rows to ranges, compare key tuples, intersect range tables, list touched shards.

A table of ranges has columns ``lo`` and ``hi`` (structs over the first key columns; null parts end a prefix, all null or
a null struct means unbounded) and ``lo_incl`` and ``hi_incl``. Overlap joins are equality joins on bins cut from the
range bounds themselves, so no pair is built that does not share a bin.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.bounds import cut_key
from ..plans.layout import TREE_SPLITS, Layout, count_splits, key_struct, splits_before
from ..sources.table import SHARD, KeyedTable

BOUNDS_PER_BIN = 32
SHARDS_PER_BLOCK = 4096
MAX_BINS = 65_536


def cut_at_null(parts: Sequence[Column]) -> list[Column]:
    """Key parts up to the first null; later parts become null."""
    out, open_ = [], F.lit(True)
    for p in parts:
        open_ = open_ & p.isNotNull()
        out.append(F.when(open_, p))
    return out


def _padded(side: Sequence[Column], other: Sequence[Column]) -> list[Column]:
    """The tuple at the other's length; missing parts are nulls of the other's types."""
    return [*side, *[F.when(F.lit(False), c) for c in list(other)[len(side) :]]]


def compare_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """-1, 0 or 1 in key order: part by part, a tuple that ends (or holds a null) sorts before its extensions."""
    a, b = key_struct(cut_at_null(_padded(left, right))), key_struct(cut_at_null(_padded(right, left)))
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def _parts(df: DataFrame, name: str) -> list[Column]:
    return [F.col(name)[f.name] for f in df.schema[name].dataType.fields]


def _part_types(df: DataFrame, name: str) -> list[T.DataType]:
    return [f.dataType for f in df.schema[name].dataType.fields]


def _at_or_after_lo(keys: Sequence[Column], lo: Sequence[Column], incl: Column) -> Column:
    out = incl
    for k, b in reversed(list(zip(keys, lo))):
        out = F.when(b.isNull(), incl).when(k > b, True).when(k == b, out).otherwise(False)
    return lo[0].isNull() | out


def _at_or_before_hi(keys: Sequence[Column], hi: Sequence[Column], incl: Column) -> Column:
    out = incl
    for k, b in reversed(list(zip(keys, hi))):
        out = F.when(b.isNull(), incl).when(k < b, True).when(k == b, out).otherwise(False)
    return hi[0].isNull() | out


def bound_splits(ranges: Sequence[DataFrame], max_bins: int = MAX_BINS) -> list[tuple]:
    """Bin edges taken from the range bounds, about ``max_bins`` of them; a bound that is very frequent gets its own bin.

    Edges only say where rows and ranges meet; every bound still takes part in the join.
    """
    ends = None
    for r in ranges:
        for side in ("lo", "hi"):
            one = r.select(*[p.alias(f"k{i}") for i, p in enumerate(cut_at_null(_parts(r, side)))])
            ends = one if ends is None else ends.unionByName(one)
    names = ends.columns
    ends = ends.filter(F.col(names[0]).isNotNull())
    rows = ends.count()
    bins = min(max_bins, max(TREE_SPLITS, rows // BOUNDS_PER_BIN))
    picked = ends if rows <= bins else ends.sample(fraction=bins / rows, seed=7)
    points = {tuple(v for v in r if v is not None) for r in picked.distinct().collect()}
    return sorted(points, key=lambda s: cut_key((s, -1)))


def route_rows(rows: DataFrame, keys: Sequence[str], ranges: DataFrame, how: str = "inner") -> DataFrame:
    """Every row with every range that holds its key.

    Ranges are copied to the bins they cover and rows look up their own bin, so rows are not copied. The range side is
    broadcast only if Spark finds it small; otherwise rows meet ranges by bin and Spark splits bins that are too full.
    """
    types = _part_types(ranges, "lo")
    splits = bound_splits([ranges])
    lo, hi = cut_at_null(_parts(ranges, "lo")), cut_at_null(_parts(ranges, "hi"))
    first = F.when(lo[0].isNull(), F.lit(0)).otherwise(splits_before(lo, types, splits))
    last = F.when(hi[0].isNull(), F.lit(len(splits))).otherwise(_last_count(hi, types, splits, None))
    binned = ranges.withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last)))).alias("r")
    key_columns = [F.col(k).cast(t) for k, t in zip(keys, types)]
    located = rows.withColumn("_bin", splits_before(key_columns, types, splits))
    inside = _at_or_after_lo(key_columns, _parts(ranges, "lo"), F.col("lo_incl")) & _at_or_before_hi(
        key_columns, _parts(ranges, "hi"), F.col("hi_incl")
    )
    joined = located.alias("l").join(binned, (F.col("l._bin") == F.col("r._bin")) & inside, how)
    return joined.drop("_bin")


def _by_length(parts: Sequence[Column], build) -> Column:
    """A value by the number of parts before the first null."""
    out = build(1)
    for m in range(2, len(parts) + 1):
        out = F.when(parts[m - 1].isNotNull(), build(m)).otherwise(out)
    return out


def _last_count(hi: Sequence[Column], types: Sequence[T.DataType], splits: Sequence[tuple], incl: Column | None) -> Column:
    """Number of splits before the end of an upper bound; an inclusive prefix (``incl`` None: any) reaches past all
    its keys."""
    if not splits:
        return F.lit(0)

    def for_length(m: int) -> Column:
        short = [s[:m] for s in splits]
        through = count_splits(hi[:m], types[:m], short)
        return through if incl is None else F.when(incl, through).otherwise(count_splits(hi[:m], types[:m], short, False))

    return _by_length(hi, for_length)


def _first_count(lo: Sequence[Column], types: Sequence[T.DataType], splits: Sequence[tuple], incl: Column) -> Column:
    """Number of splits at or before the start of a lower bound; an exclusive prefix starts after all its keys."""
    if not splits:
        return F.lit(0)

    def for_length(m: int) -> Column:
        return count_splits(lo[:m], types[:m], [s[:m] for s in splits], True)

    return F.when(incl, count_splits(lo, types, splits, True)).otherwise(_by_length(lo, for_length))


def shard_spans(layout: Layout, types: Sequence[T.DataType], ranges: DataFrame) -> DataFrame:
    """Every range that can hold a key, with the ``first`` and ``last`` shard it touches."""
    lo, hi = cut_at_null(_parts(ranges, "lo")), cut_at_null(_parts(ranges, "hi"))
    if layout.store == "hash":
        first, last = F.lit(0), F.lit(layout.shards - 1)
    else:
        splits = layout.splits
        lo, hi = ([*side, *[F.lit(None).cast(t) for t in types[len(side) :]]] for side in (lo, hi))
        first = F.when(lo[0].isNull(), F.lit(0)).otherwise(_first_count(lo, types, splits, F.col("lo_incl")))
        last = F.when(hi[0].isNull(), F.lit(len(splits))).otherwise(_last_count(hi, types, splits, F.col("hi_incl")))
    spans = ranges.filter(_holds_keys(lo, hi)).withColumns({"first": first.cast("int"), "last": last.cast("int")})
    return spans.filter("first <= last")


def range_shards(layout: Layout, types: Sequence[T.DataType], ranges: DataFrame) -> DataFrame:
    """Every range with the shards it touches; ranges that hold no key touch none."""
    spans = shard_spans(layout, types, ranges)
    return spans.withColumn("shard", F.explode(F.sequence("first", "last"))).drop("first", "last")


def _holds_keys(lo: Sequence[Column], hi: Sequence[Column]) -> Column:
    """Whether any key can lie in the range."""
    both = F.col("lo_incl") & F.col("hi_incl")
    out = both
    for a, b in reversed(list(zip(lo, hi))):
        ends = F.when(a.isNull() & b.isNull(), both).when(a.isNull(), F.col("lo_incl")).when(b.isNull(), F.col("hi_incl"))
        # One bound a prefix of the other: what lies between is decided by the shorter bound's own flag.
        out = ends.when(a < b, True).when(a > b, False).otherwise(out)
    return lo[0].isNull() | hi[0].isNull() | out


def touched_shards(table: KeyedTable, ranges: DataFrame) -> DataFrame:
    """Shards that any range touches, with the number of ranges that touch them.

    Each range adds 1 at its first shard and takes it off after its last; the running sum of these differences is the
    number of ranges at a shard. So a range costs two rows, however many shards it covers, and these are summed before
    the shuffle.
    """
    spans = shard_spans(table.layout, table.base.key_types(), ranges)
    ends = F.array(F.struct(F.col("first").alias("shard"), F.lit(1).alias("change")), F.struct((F.col("last") + 1).alias("shard"), F.lit(-1).alias("change")))
    changes = spans.select(F.inline(ends)).groupBy("shard").agg(F.sum("change").alias("change"))
    every = table.spark.range(table.layout.shards).select(F.col("id").cast("int").alias("shard"))
    each = every.join(changes, "shard", "left").select("shard", F.floor(F.col("shard") / SHARDS_PER_BLOCK).alias("block"), F.coalesce("change", F.lit(0)).alias("change"))
    # a running sum over blocks (one row each), and one within each block; a single block needs no sum before it
    if table.layout.shards <= SHARDS_PER_BLOCK:
        counted = each.withColumn("ranges", F.sum("change").over(Window.partitionBy("block").orderBy("shard")))
        return counted.select("shard", "ranges").filter("ranges > 0")
    sums = each.groupBy("block").agg(F.sum("change").alias("change"))
    before = F.coalesce(F.sum("change").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    running = F.sum("change").over(Window.partitionBy("block").orderBy("shard"))
    counted = each.withColumn("own", running).join(sums.select("block", before.alias("before")), "block")
    return counted.select("shard", (F.col("before") + F.col("own")).alias("ranges")).filter("ranges > 0")


def read_ranges(table: KeyedTable, ranges: DataFrame) -> DataFrame:
    """Rows whose key lies in any of the ranges.

    The touched shards are worked out while the query runs and filter the scan's partitions, so other shards are not opened
    and the ranges may come from any query. Their list has at most a number for each shard.
    """
    touched = touched_shards(table, ranges).select(F.col("shard").alias(SHARD))
    rows = table.base.read(table.spark).join(F.broadcast(touched), SHARD, "left_semi").drop(SHARD)
    bounds = ranges.select("lo", "hi", "lo_incl", "hi_incl")
    return route_rows(rows, table.keys, bounds, "left_semi").select(*table.schema.names)


def _cover(first: Column, end: Column, levels: int) -> Column:
    """Tree nodes that together cover bins first .. end - 1: at most two per level."""

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), level)
        left = F.floor((first + size - 1) / size).cast("int")
        right = F.floor(end / size).cast("int")
        nodes = F.array(
            F.when((left < right) & (left % 2 == 1), F.struct(level.alias("level"), left.alias("node"))),
            F.when((left < right) & (right % 2 == 1), F.struct(level.alias("level"), (right - 1).alias("node"))),
        )
        return F.filter(nodes, lambda n: n.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def _ancestors(leaf: Column, levels: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(levels)),
        lambda level: F.struct(level.alias("level"), F.floor(leaf / F.call_function("shiftleft", F.lit(1), level)).cast("int").alias("node")),
    )


def intersect_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every pair of ranges that overlap, with the overlap as ``lo``, ``hi``, ``lo_incl``, ``hi_incl``.

    The tighter of both bounds wins; equal bounds are inclusive only where both are. Tuples compare in key order, a
    prefix before its extensions. Other columns of both sides are kept, so they must have different names.

    Two ranges overlap when the later start lies in the other range. Ranges are cut into tree nodes over bins of the
    bounds (at most two per level) and starts look up their ancestors, so each pair is found once.
    """
    for side in (a, b):
        if _part_types(side, "lo") != _part_types(side, "hi"):
            raise TypeError("lo and hi must have the same types")
    types = _part_types(a, "lo")
    if types != _part_types(b, "lo"):
        raise TypeError("ranges over different key types cannot be compared")
    splits = bound_splits([a, b])
    levels = max(0, math.ceil(math.log2(len(splits) + 1)))

    def sided(df: DataFrame, s: str) -> DataFrame:
        lo, hi = cut_at_null(_parts(df, "lo")), cut_at_null(_parts(df, "hi"))
        other = [c for c in df.columns if c not in ("lo", "hi", "lo_incl", "hi_incl")]
        start = F.when(lo[0].isNull(), F.lit(0)).otherwise(splits_before(lo, types, splits))
        end = F.when(hi[0].isNull(), F.lit(len(splits))).otherwise(splits_before(hi, types, splits)) + 1
        flat = df.select(
            *other,
            key_struct(lo).alias(f"{s}lo"),
            key_struct(hi).alias(f"{s}hi"),
            (F.col("lo_incl") & lo[0].isNotNull()).alias(f"{s}li"),
            (F.col("hi_incl") & hi[0].isNotNull()).alias(f"{s}hi_incl"),
            lo[0].isNull().alias(f"{s}open"),
            hi[0].isNull().alias(f"{s}end"),
            start.alias(f"{s}start"),
            end.alias(f"{s}stop"),
        )
        order = F.when(F.col(f"{s}open") | F.col(f"{s}end"), True).otherwise(
            (F.col(f"{s}lo") < F.col(f"{s}hi"))
            | ((F.col(f"{s}lo") == F.col(f"{s}hi")) & F.col(f"{s}li") & F.col(f"{s}hi_incl"))
        )
        return flat.filter(order)

    left, right = sided(a, "a_"), sided(b, "b_")
    nodes = ["level", "node"]

    def covers(df: DataFrame, s: str) -> DataFrame:
        return df.select("*", F.inline(_cover(F.col(f"{s}start"), F.col(f"{s}stop"), levels)))

    def starts(df: DataFrame, s: str) -> DataFrame:
        return df.select("*", F.inline(_ancestors(F.col(f"{s}start"), levels)))

    def found(points: DataFrame, cover: DataFrame) -> DataFrame:
        # There are at most two nodes per bin, so this side is small whatever the tables hold. Without it every start
        # would be shuffled to the top nodes, where hardly any range is.
        used = F.broadcast(cover.select(*nodes).distinct())
        return points.join(used, nodes, "left_semi").join(cover, nodes)

    # Null structs do not occur: an unbounded start is a struct of nulls, which sorts before every bounded start.
    a_late = found(starts(left, "a_"), covers(right, "b_")).filter(F.col("b_lo") <= F.col("a_lo"))
    b_late = found(starts(right, "b_"), covers(left, "a_")).filter(F.col("a_lo") < F.col("b_lo"))
    pairs = a_late.unionByName(b_late).drop(*nodes)
    same_lo, same_hi = F.col("a_lo") == F.col("b_lo"), F.col("a_hi") == F.col("b_hi")
    a_later = F.col("a_lo") > F.col("b_lo")
    a_ends_first = F.when(F.col("a_end"), F.lit(False)).when(F.col("b_end"), F.lit(True)).otherwise(F.col("a_hi") < F.col("b_hi"))
    merged = pairs.select(
        *[c for c in [*a.columns, *b.columns] if c not in ("lo", "hi", "lo_incl", "hi_incl")],
        F.greatest("a_lo", "b_lo").alias("lo"),
        F.when(a_ends_first, F.col("a_hi")).otherwise(F.col("b_hi")).alias("hi"),
        F.when(same_lo, F.col("a_li") & F.col("b_li")).when(a_later, F.col("a_li")).otherwise(F.col("b_li")).alias("lo_incl"),
        F.when(same_hi, F.col("a_hi_incl") & F.col("b_hi_incl"))
        .when(a_ends_first, F.col("a_hi_incl"))
        .otherwise(F.col("b_hi_incl"))
        .alias("hi_incl"),
        (F.col("a_open") & F.col("b_open")).alias("_open"),
        (F.col("a_end") & F.col("b_end")).alias("_end"),
    )
    valid = (
        F.col("_open")
        | F.col("_end")
        | (F.col("lo") < F.col("hi"))
        | ((F.col("lo") == F.col("hi")) & F.col("lo_incl") & F.col("hi_incl"))
    )
    return merged.filter(valid).drop("_open", "_end")
