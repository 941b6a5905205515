"""Output batches: cut greedily at so many rows or so many bytes, exactly, by many tasks.

A batch begins where the one before it ends, so its place depends on every row before it. Here each row points to the row at
which a batch that began with it would end; within a bin of rows these pointers are doubled until they leave the bin, which
gives a map from each possible entry of the bin to an entry of the next. Maps are joined bin after bin, in groups of groups, so
that no task follows more than a few of them; then every bin knows where it is entered and marks its batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sizes import row_bytes
from .report import rank_in_shard

#: Rows of a bin, in batches of the most rows; maps that one task follows.
BATCHES_PER_BIN, MAPS_PER_GROUP = 64, 64
_MAP = "shard {0}, bin long, exits array<int>, passed array<long>"


def _maps(narrow: DataFrame, shard: str, rows: int, most: int, size: int) -> DataFrame:
    """One row per bin: for each entry (a row of its first ``rows``) the entry of the next bin and the batches begun."""

    def run(parts):
        import numpy as np
        import pyarrow as pa

        def jump(sizes, own: int):
            """Pointers of a bin's own rows, the rows after them looked at too."""
            total = np.concatenate(([0], np.cumsum(sizes)))
            full = np.searchsorted(total, total[:own] + most, "left")
            return np.maximum(np.arange(own) + 1, np.minimum(np.arange(own) + rows, full))

        def of_bin(sizes, own: int):
            at = jump(sizes, own)
            begun = np.ones(own, np.int64)
            inside = at < own
            while inside.any():  # doubling: every step follows twice as many pointers
                begun[inside] += begun[at[inside]]
                at[inside] = at[at[inside]]
                inside = at < own
            return (at - own).astype(np.int32), begun

        key, sizes, own = None, [], 0

        def done():
            exits, begun = of_bin(np.concatenate(sizes), own)
            entries = exits[:rows], begun[:rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], kind), pa.array([key[1]], pa.int64()), pa.array([entries[0]], pa.list_(pa.int32())), pa.array([entries[1]], pa.list_(pa.int64()))],
                names=["shard", "bin", "exits", "passed"],
            )

        kind = None
        for part in parts:
            kind = part.column(0).type
            shards, bins, ahead, found = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_numpy(zero_copy_only=False), part.column(3).to_numpy()
            start = 0
            for i in range(1, len(shards) + 1):
                if i == len(shards) or (shards[i], bins[i]) != (shards[start], bins[start]):
                    if (shards[start], bins[start]) != key:
                        if own:
                            yield done()
                        key, sizes, own = (shards[start], bins[start]), [], 0
                    sizes.append(found[start:i])
                    own += int((~ahead[start:i]).sum())
                    start = i
        if own:
            yield done()

    kind = narrow.schema[shard].dataType.simpleString()
    runs = narrow.repartition(shard, "bin").sortWithinPartitions(shard, "bin", "rank").select(shard, "bin", "ahead", "size")
    return runs.mapInArrow(run, _MAP.format(kind))


def _joined(maps: DataFrame, group: int) -> DataFrame:
    """Maps of ``group`` bins in a row as one map each; no bin but the last of a shard is shorter than its entries."""

    def run(parts):
        import numpy as np
        import pyarrow as pa

        key, at, begun, kind = None, None, None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], kind), pa.array([key[1]], pa.int64()), pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([begun], pa.list_(pa.int64()))],
                names=["shard", "bin", "exits", "passed"],
            )

        for part in parts:
            kind = part.column(0).type
            for n in range(part.num_rows):
                own = (part.column(0)[n].as_py(), part.column(1)[n].as_py() // group)
                exits, passed = (np.asarray(part.column(c)[n].values) for c in (2, 3))
                if own != key:
                    if key is not None:
                        yield done()
                    key, at, begun = own, exits.copy(), passed.copy()
                else:
                    inside = at < len(exits)  # an exit past a short last bin is past the shard's end
                    begun[inside] += passed[at[inside]]
                    at[inside] = exits[at[inside]]
        if key is not None:
            yield done()

    kind = maps.schema["shard"].dataType.simpleString()
    runs = maps.repartition("shard", F.floor(F.col("bin") / group)).sortWithinPartitions("shard", "bin")
    return runs.mapInArrow(run, _MAP.format(kind))


def _entered(maps: DataFrame, entries: DataFrame | None, group: int) -> DataFrame:
    """Entry of every bin, and batches begun before it, from those of its group of bins (without: a shard starts at 0)."""
    kind = maps.schema["shard"].dataType.simpleString()
    over = F.floor(F.col("bin") / group).cast("long") if entries is not None else F.lit(0).cast("long")
    placed = maps.withColumn("over", over)
    if entries is not None:
        entries = entries.select(F.col("shard").alias("s"), F.col("bin").alias("b"), "entry", "before")
        placed = placed.join(entries, F.col("shard").eqNullSafe(F.col("s")) & (F.col("over") == F.col("b")))
    else:
        placed = placed.withColumn("entry", F.lit(0)).withColumn("before", F.lit(0).cast("long"))
    runs = placed.repartition("shard", "over").sortWithinPartitions("shard", "bin").select("shard", "over", "bin", "exits", "passed", "entry", "before")

    def run(parts):
        import pyarrow as pa

        key, at, begun = None, 0, 0
        for part in parts:
            out = []
            for n in range(part.num_rows):
                own = (part.column(0)[n].as_py(), part.column(1)[n].as_py())
                if own != key:
                    key, at, begun = own, part.column(5)[n].as_py(), part.column(6)[n].as_py()
                out.append((own[0], part.column(2)[n].as_py(), at, begun))
                if at < len(part.column(3)[n].values):
                    begun += part.column(4)[n].values[at].as_py()
                    at = part.column(3)[n].values[at].as_py()
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (part.column(0).type, pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["shard", "bin", "entry", "before"])

    return runs.mapInArrow(run, f"shard {kind}, bin long, entry int, before long")


def _marks(narrow: DataFrame, shard: str, entries: DataFrame, rows: int, most: int) -> DataFrame:
    """First rows of all batches, and for every bin the batch that reaches into it from before: shard, bin, rank, batch."""
    kind = narrow.schema[shard].dataType.simpleString()
    known = entries.select(F.col("shard").alias("s"), F.col("bin").alias("b"), "entry", "before")
    placed = narrow.join(known, F.col(shard).eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    runs = placed.repartition(shard, "bin").sortWithinPartitions(shard, "bin", "rank").select(shard, "bin", "ahead", "size", "rank", "entry", "before")

    def run(parts):
        import numpy as np
        import pyarrow as pa

        key, held = None, []

        def done():
            ahead, sizes, ranks = (np.concatenate([h[i] for h in held]) for i in range(3))
            own, at, batch = int((~ahead).sum()), key[2], key[3]
            total = np.concatenate(([0], np.cumsum(sizes)))
            starts = []
            while at < own:
                starts.append(at)
                full = int(np.searchsorted(total, total[at] + most, "left"))
                at = max(at + 1, min(at + rows, full))
            found = [(int(ranks[0]), batch - 1)] if key[2] and own else []  # rows before the entry belong to the batch before
            found += [(int(ranks[s]), batch + i) for i, s in enumerate(starts)]
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * n, kind_), pa.array([key[1]] * n, pa.int64()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                names=["shard", "bin", "rank", "batch"],
            )

        kind_ = None
        for part in parts:
            kind_ = part.column(0).type
            names = [part.column(i).to_pylist() for i in (0, 1, 5, 6)]
            arrays = [part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4)]
            start = 0
            for i in range(1, part.num_rows + 1):
                if i == part.num_rows or any(c[i] != c[start] for c in names[:2]):
                    own = tuple(c[start] for c in names)
                    if own != key:
                        if held:
                            yield done()
                        key, held = own, []
                    held.append([a[start:i] for a in arrays])
                    start = i
        if held:
            yield done()

    return runs.mapInArrow(run, f"shard {kind}, bin long, rank long, batch long")


def batch_pack(df: DataFrame, keys: Sequence[str], shard: str, rows: int = 10_000, max_bytes: int | None = None) -> DataFrame:
    """Number the output batches of each shard in key order, in ``batch`` from 0.

    A batch is full, and the next row begins another, once it holds ``rows`` rows or, with ``max_bytes``, so many bytes or
    more (of all columns, by type). Shards may be null, which is a shard of its own; keys should be unique, as otherwise
    which of equal rows comes first is open. An empty table has no batches.

    Only shard, rank and size go through Python, a bin of rows at a time; the rows meet their batch in a window.
    """
    if rows < 1 or (max_bytes is not None and max_bytes < 1):
        raise ValueError("a batch holds at least one row and one byte")
    clash = [c for c in df.columns if c.lower() in ("_rank", "batch")]
    if clash:
        raise ValueError(f"columns {clash} have reserved names")
    ranked = rank_in_shard(df, keys, shard, "_rank")
    if max_bytes is None:
        return ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / rows).cast("bigint")).drop("_rank")
    size = rows * BATCHES_PER_BIN
    bin_of = F.floor((F.col("_rank") - 1) / size).cast("long")
    own = ranked.select(F.col(shard), F.col("_rank").alias("rank"), bin_of.alias("bin"), row_bytes(df.schema).alias("size"), F.lit(False).alias("ahead"))
    # a batch may reach into the next bin by less than its most rows
    ahead = own.filter((F.col("bin") > 0) & ((F.col("rank") - 1) % size < rows)).withColumn("bin", F.col("bin") - 1).withColumn("ahead", F.lit(True))
    narrow = own.unionByName(ahead)
    levels = [_maps(narrow, shard, rows, max_bytes, size)]
    bins = own.agg(F.coalesce(F.max("bin"), F.lit(0))).first()[0] + 1
    while bins > MAPS_PER_GROUP:
        levels.append(_joined(levels[-1], MAPS_PER_GROUP))
        bins = -(-bins // MAPS_PER_GROUP)
    entries = None
    for maps in reversed(levels):
        entries = _entered(maps, entries, MAPS_PER_GROUP)
    marks = _marks(narrow, shard, entries, rows, max_bytes)
    names = [f"`{c}`" for c in ranked.columns]
    both = ranked.select(*names, bin_of.alias("_bin"), F.lit(None).cast("long").alias("batch"), F.lit(1).alias("_kind")).unionByName(
        marks.select(F.col("shard").alias(shard), F.col("rank").alias("_rank"), F.col("bin").alias("_bin"), "batch", F.lit(0).alias("_kind")), allowMissingColumns=True
    )
    so_far = Window.partitionBy(shard, "_bin").orderBy("_rank", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("batch", F.last("batch", ignorenulls=True).over(so_far)).filter("_kind = 1")
    return filled.select(*[f"`{c}`" for c in df.columns], "batch")


def write_batches(df: DataFrame, path: str, keys: Sequence[str], shard: str, rows: int = 10_000, max_bytes: int | None = 10 << 20) -> DataFrame:
    """Writes each batch as one Parquet file in key order, in folders by shard and batch, and returns the files' rows.

    The path must be new. Shard and batch become the names of folders.
    """
    spark = df.sparkSession
    packed = batch_pack(df, keys, shard, rows, max_bytes)
    placed = packed.repartition(F.col(shard), F.col("batch")).sortWithinPartitions(shard, "batch", *keys)
    placed.write.partitionBy(shard, "batch").parquet(path)
    stored = T.StructType([*(f for f in packed.schema if f.name not in (shard, "batch")), packed.schema[shard], T.StructField("batch", T.LongType())])
    return spark.read.schema(stored).parquet(path)
