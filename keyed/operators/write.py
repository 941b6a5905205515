"""Keyed writes: insert, upsert, replace, bulk upsert, overwrite, truncate, create.

Every write reads its batch twice and shuffles it once. The first pass is one aggregate that gives, for each shard, rows,
bytes and a sample of keys, in which every byte has the same chance; what is stored is known from its file record. From
these a large shard is cut into cells, key ranges of about equal work; small neighbours share one. The second pass sends
each cell to one task, which writes it in key order. So a shard that holds a third of the table is written by many tasks,
all rows of a key meet in one cell, and each file holds a narrow range of keys. Where files hold few rows, a cell is several
files, and a large write makes them larger: neither tasks and cuts nor files number more than the rows are worth. Only
shards that the batch touches are read or rewritten.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import coerce
from ..functions.sizes import row_bytes
from ..functions.types import new_table_schema
from ..plans.bounds import cut_key
from ..plans.layout import Layout, key_struct, quantiles, shard_count
from ..sources import files
from ..sources.table import BYTES_PER_CELL, CHANGE, GEN, ROWS_PER_CELL, SHARD, KeyedTable, Shards, cell_column, check_names, new_generation

CELL, TAG, RANK = "_cell", "_tag", "_rank"
OLD, DELETED, NEW = 0, 1, 2
#: Part of a cell below which a shard shares its task with its neighbours.
SMALL_CELL = 0.01
#: Keys sampled for each cell's worth of rows, and for each shard of a layout that is still to be found.
SAMPLES, SHARD_SAMPLES = 8, 64
#: Keys, of all shards of a given layout together, that are kept of those which only files of few rows ask for.
NARROW_SAMPLES = 8192
AUTO_KEY = "_spark_key"
#: Plan nodes whose rows are the same, and cheap to make, whenever they are asked for again.
REPEATABLE = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "LocalRelation", "Range"}


class WriteResult:
    """The table after a write, with the rows its tasks wrote and the bytes of their text, binary and array values."""

    def __init__(self, table: KeyedTable, rows: int = 0, payload_bytes: int = 0):
        self.table, self.rows, self.payload_bytes = table, rows, payload_bytes


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Last row per key by ``order_by``; other columns break ties, so the winner does not depend on task order.

    Spark keeps only the best row per key in each task before the shuffle, so a key with very many copies stays cheap.
    """
    given = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [F.col(f.name) for f in df.schema if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in [*given, *rest]])
    return df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) == 1).drop(RANK)


def not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Stop the job where a non-null column holds a null."""
    return df.withColumns(
        {
            f.name: F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"null in non-null column {f.name}"))).otherwise(
                F.col(f.name)
            )
            for f in schema
            if not f.nullable and f.name in df.columns
        }
    )


def by_name(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Columns matched by name and brought to the table's types; order is free, unknown names are an error."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the table")
    present = T.StructType([f for f in schema if f.name in df.columns])
    return coerce(df.select(*present.names), present, strict=strict)


@contextmanager
def _staged(spark: SparkSession, path: str, df: DataFrame):
    """The rows written to files beside the table and read back: computed once, and the same whenever a task runs again."""
    folder = f"{path}/staging-{new_generation()}"
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        files.remove(spark, folder)


@contextmanager
def _generated_keys(spark: SparkSession, path: str, df: DataFrame, name: str):
    """The rows with a text key each: the hash of this write and the row's place in the input, and then these two.

    A task that runs again sees the same rows in the same order and gives the same keys, so nothing is copied. Rows whose
    places may change are staged first.
    """
    write = new_generation()[1:]
    place = F.hex(F.monotonically_increasing_id())
    key = F.concat(F.lower(F.lpad(F.hex(F.xxhash64(F.lit(write), "_place")), 16, "0")), F.lit(f"-{write}-"), F.lower("_place"))

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_place", place).withColumn(name, key).drop("_place")

    if _repeatable(df):
        yield keyed(df)
        return
    with _staged(spark, path, df) as rows:
        yield keyed(rows)


def _repeatable(df: DataFrame) -> bool:
    """Whether the batch is a scan with filters and projections that give the same rows each time."""
    plan = df._jdf.queryExecution().analyzed()
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in REPEATABLE:
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return plan.deterministic()


@contextmanager
def _read_once(spark: SparkSession, path: str, df: DataFrame, order_by, schema: T.StructType):
    """The batch and its order. A write reads its batch several times (counts, key look-ups, rows), so one that may
    differ or is dear to make again is staged first; shards and keys are then judged on the rows that are written."""
    if _repeatable(df):
        yield df, order_by
        return
    typed = {f.name: schema[f.name].dataType if f.name in schema.names else T.StringType() for f in df.schema if isinstance(f.dataType, T.NullType)}
    ordered = {f"_order{n}": c for n, c in enumerate(order_by or []) if isinstance(c, Column)}
    names = [f"_order{n}" if isinstance(c, Column) else c for n, c in enumerate(order_by or [])]
    with _staged(spark, path, df.withColumns({**{c: F.col(c).cast(t) for c, t in typed.items()}, **ordered})) as rows:
        yield rows, names or None


@dataclass
class Load:
    """The work that rows make: their number and bytes, and keys with the rows and bytes that each stands for."""

    rows: int = 0
    bytes: int = 0
    keys: list[tuple[tuple, float, float]] = field(default_factory=list)

    def cells(self, cell_rows: int) -> float:
        return _work(self.rows, self.bytes, cell_rows)


def _work(rows: float, size: float, cell_rows: int) -> float:
    return max(rows / cell_rows, size / BYTES_PER_CELL)


def _payload(schema: T.StructType) -> Column:
    """Bytes of a row's values of varying length."""
    sizes = []
    for f in schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif isinstance(f.dataType, T.ArrayType):
            sizes.append(F.coalesce(F.size(f.name) * 8, F.lit(0)))
    return sum(sizes, F.lit(0)).cast("bigint")


def _width(rows: DataFrame, names: Sequence[str], known: int = 0) -> Column:
    """Bytes of a row: measured, or as stored rows have on average."""
    return F.lit(known).cast("bigint") if known else row_bytes(T.StructType([f for f in rows.schema if f.name in names]))


def _drawn(keys: Sequence[str], size: Column, cell_rows: int) -> Column:
    """Whether a key is in the sample: SAMPLES for every cell's worth of rows and of bytes, told by its hash."""
    u = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(17)), 11).cast("double") / float(1 << 53)
    return u < size * (SAMPLES / BYTES_PER_CELL) + SAMPLES / cell_rows


def _loads(rows: DataFrame, shards: Shards) -> dict[int, Load]:
    """What the rows add to each shard, in one aggregate; keys only of shards with more than one cell.

    Where files hold few rows, every hash bucket of a shard gives its key of least hash, which stands for the bucket: they
    are for few tasks. Keys drawn by size stand for themselves.
    """
    keys = list(shards.keys)
    size = _width(rows, shards.schema.names, shards.row_bytes)
    n, b = F.sum("n"), F.sum("b")
    large = (n > shards.cell_rows) | (b > BYTES_PER_CELL)
    shard = shards.shard_column().alias(SHARD)
    narrow = shards.cell_rows < ROWS_PER_CELL
    if narrow:
        buckets = max(2 * SAMPLES, NARROW_SAMPLES // shards.layout.shards)
        names, parts = _bucketed(rows, [shard], keys, size, buckets, ROWS_PER_CELL)
        found = parts.groupBy(SHARD).agg(n.alias("n"), b.alias("b"), F.when(large, F.collect_list(F.struct(*names, "n", "b"))).alias("keys"))
    else:
        drawn = F.when(_drawn(keys, size, shards.cell_rows), key_struct(keys))
        parts = (
            rows.select(shard, drawn.alias("key"), size.alias("size"))
            .groupBy(SHARD, "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
        )
        found = parts.groupBy(SHARD).agg(n.alias("n"), b.alias("b"), F.when(large, F.collect_list("key")).alias("keys"))
    out = {}
    for shard, count, size_, keys_ in found.collect():
        own = Load(count, size_ or 0)
        if narrow:
            own.keys = [(tuple(k)[:-2], k.n, k.b or 0) for k in keys_ or () if None not in tuple(k)[:-2]]
        else:
            whole = [tuple(k) for k in keys_ or () if None not in k]
            own.keys = [(k, own.rows / len(whole), own.bytes / len(whole)) for k in whole]
        out[shard] = own
    return out


def _bucketed(rows: DataFrame, by: Sequence[Column], keys: Sequence[str], size: Column, buckets: int, cell_rows: int) -> tuple[list[str], DataFrame]:
    """Rows and bytes of every hash bucket with its key of least hash, and of keys drawn by size."""
    hashed = F.xxhash64(*keys)
    names = [f"k{i}" for i in range(len(keys))]
    picked = rows.select(
        *by,
        F.pmod(hashed, F.lit(buckets)).alias("bucket"),
        F.when(_drawn(keys, size, cell_rows), hashed).alias("own"),
        hashed.alias("hash"),
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        size.alias("size"),
    )
    # each key column by itself, all of the row of least hash: numbers then stay in a hash aggregate
    key = [F.min_by(n, "hash").alias(n) for n in names]
    return names, picked.groupBy(*picked.columns[: len(by) + 2]).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"), *key)


def _survey(rows: DataFrame, keys: Sequence[str], names: Sequence[str], shards: int, cell_rows: int) -> list[tuple[tuple, int, int]]:
    """Keys with the rows and bytes they stand for, together all rows, in key order: one aggregate.

    Every hash bucket gives its key of least hash, which stands for the bucket, and keys drawn by size stand for themselves.
    """
    size = _width(rows, names)
    _, parts = _bucketed(rows, [], keys, size, max(1024, SHARD_SAMPLES * shards), max(cell_rows, ROWS_PER_CELL))
    found = [(tuple(r)[4:], r.n, r.b or 0) for r in parts.collect()]
    return sorted((r for r in found if None not in r[0]), key=lambda r: cut_key((r[0], -1)))


def _splits(survey: Sequence[tuple[tuple, int, int]], shards: int) -> list[tuple]:
    """Split points of a new range layout, by bytes."""
    return quantiles([(k, b or n) for k, n, b in survey], shards)


def _surveyed(survey: Sequence[tuple[tuple, int, int]], layout: Layout) -> dict[int, Load]:
    """The survey by shard of a range layout."""
    out: dict[int, Load] = {}
    points = [cut_key((s, -1)) for s in layout.splits]
    shard = 0
    for key, n, b in survey:
        while shard < len(points) and points[shard] <= cut_key((key, -1)):
            shard += 1
        own = out.setdefault(shard, Load())
        own.rows, own.bytes = own.rows + n, own.bytes + b
        own.keys.append((key, n, b))
    return out


def _with_stored(spark: SparkSession, shards: Shards, loads: dict[int, Load]) -> dict[int, Load]:
    """The loads with what the shards hold already, file by file."""
    stored = shards.stored(spark, loads)
    if stored is None:  # no record of these files: rows are counted from their footers
        held = shards.read(spark, [s for s in loads if s in shards.live])
        for shard, n in held.groupBy(SHARD).count().collect():
            loads[shard].rows += n
            loads[shard].bytes += n * shards.row_bytes
        return loads
    for shard, zones in stored.items():
        for z in zones:
            size = z.rows * shards.row_bytes
            loads[shard].rows += z.rows
            loads[shard].bytes += size
            loads[shard].keys.append((z.first, z.rows, size))
    return loads


def _cells(work: dict[int, float], pieces: dict[int, int], shards: int, small: float) -> tuple[list[int], int]:
    """First cell of every shard, and the number of cells: large shards get several, small neighbours share one."""
    first, cells, room = [], 0, 0.0
    for shard in range(shards):
        own = work.get(shard, 0.0)
        if pieces.get(shard, 1) == 1 and own <= room and cells:
            first.append(cells - 1)
            room -= own
            continue
        if not own:
            first.append(max(0, cells - 1))
            continue
        first.append(cells)
        cells += pieces.get(shard, 1)
        room = small - own if pieces.get(shard, 1) == 1 else 0.0
    return first, cells


def _place(df: DataFrame, shards: Shards, loads: dict[int, Load]) -> DataFrame:
    """Rows dealt to cells: shards, or key ranges of large ones."""
    unit = shards.task_rows(_rows(loads))
    work = {s: load.cells(unit) for s, load in loads.items()}
    cuts = {}
    for s, load in loads.items():
        if work[s] > 1 and load.keys:
            keys = sorted(load.keys, key=lambda k: cut_key((k[0], -1)))
            cuts[s] = quantiles([(k, _work(n, b, unit)) for k, n, b in keys], math.ceil(work[s]))
    parallel = df.sparkSession.sparkContext.defaultParallelism
    small = min(1.0, max(SMALL_CELL, sum(work.values()) / (4 * parallel)))
    first, cells = _cells(work, {s: len(c) + 1 for s, c in cuts.items()}, shards.layout.shards, small)
    return df.withColumn(CELL, cell_column(shards, first, cuts)).repartitionById(max(1, cells), F.col(CELL))


def _rows(loads: dict[int, Load]) -> int:
    return sum(load.rows for load in loads.values())


def _per_key(shards: Shards):
    return Window.partitionBy(SHARD, CELL, *shards.keys).orderBy(F.desc(TAG))


def _duplicate_guard(w) -> Column:
    twice = (F.col(TAG) == NEW) & (F.lead(TAG, 1).over(w) == NEW)
    return F.when(twice, F.raise_error(F.lit("duplicate key in one write; give order_by")).cast("boolean")).otherwise(F.lit(True))


def _merged(
    spark,
    shards: Shards,
    new: DataFrame,
    deleted: DataFrame | None = None,
    keep_unwritten: bool = False,
    sizing: DataFrame | None = None,
    capture: Sequence[str] = (),
):
    """Rows of the touched shards after the batch: the newest row per key, unwritten columns from the old row.

    ``sizing`` holds at least the keys of ``new`` and is cheaper to count. With ``capture`` a written row also tells whether it
    replaced one, and what that had in these columns.
    """
    changes = new.withColumn(TAG, F.lit(NEW))
    if deleted is not None:
        changes = changes.unionByName(deleted.withColumn(TAG, F.lit(DELETED)), allowMissingColumns=True)
    changes = changes.withColumn(SHARD, shards.shard_column())
    loads = _with_stored(spark, shards, _loads(changes if sizing is None else sizing, shards))
    old = shards.read(spark, [s for s in loads if s in shards.live])
    every = old.withColumn(TAG, F.lit(OLD)).unionByName(changes, allowMissingColumns=True)
    w = _per_key(shards)
    placed = _place(every, shards, loads)
    kept = [c for c in shards.schema.names if c not in new.columns] if keep_unwritten else []
    ranked = placed.select(
        *[c for c in placed.columns if c not in kept],
        *[F.when(F.col(TAG) == NEW, F.lead(c, 1).over(w)).otherwise(F.col(c)).alias(c) for c in kept],
        F.row_number().over(w).alias(RANK),
        _duplicate_guard(w).alias("_single"),
        *([F.when(F.col(TAG) == NEW, _replaced(w, capture)).alias(CHANGE)] if capture else []),
    )
    kept_rows = ranked.filter((F.col(RANK) == 1) & F.col("_single") & (F.col(TAG) != DELETED))
    return kept_rows.select(SHARD, *shards.schema.names, *([CHANGE] if capture else [])), loads


def _replaced(w, columns: Sequence[str]) -> Column:
    """What the row under this one in its key's window was, if there is one."""
    had = F.coalesce(F.lead(TAG, 1).over(w) == OLD, F.lit(False))
    return F.struct(had.alias("had"), *[F.lead(c, 1).over(w).alias(c) for c in columns])


def _save(
    spark, shards: Shards, rows: DataFrame, touched: set[int] | None, loads: dict[int, Load], exact: bool = True
) -> tuple[Shards, int, int]:
    """Write the rows; touched shards are replaced (None: all). ``exact``: rows in a shard that was not counted stop the write.

    A task's file may hold twice the rows of a file, so that a cell of about that size is one; of several files an eighth
    more, so that a cell of about two is two.
    """
    seen = Observation()
    gen = new_generation()
    beside = [CHANGE] if CHANGE in rows.columns else []
    guarded = not_null(rows, shards.schema).select(SHARD, *shards.schema.names, *beside)
    counted = guarded.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_payload(shards.schema)).alias("bytes"), F.sum(row_bytes(shards.schema)).alias("whole"))
    count = _rows(loads)
    own = shards.file_rows(count)
    most = -(-own * 9 // 8) if shards.task_rows(count) > own else 2 * own
    counted.write.option("maxRecordsPerFile", most).partitionBy(SHARD).parquet(f"{shards.folder}/_gen={gen}")
    count, size = seen.get["rows"], seen.get["bytes"] or 0
    width = -(-(seen.get["whole"] or 0) // count) if count else 0
    written = shards.record_zones(spark, gen)
    if exact and (stray := set(written) - set(loads)):
        raise RuntimeError(f"the batch changed while it was written: rows in shards {sorted(stray)[:10]}, which were not counted")
    return shards.after(gen, written, touched, width), count, size


def _fresh(
    spark,
    shards: Shards,
    df: DataFrame,
    touched: set[int] | None,
    sizing: DataFrame | None = None,
    loads: dict[int, Load] | None = None,
    exact: bool = True,
) -> tuple[Shards, int, int]:
    """Write rows that meet no stored row. ``exact``: the loads name every shard that gets rows."""
    routed = df.withColumn(SHARD, shards.shard_column())
    if loads is None:
        loads = _loads(df if sizing is None else sizing, shards)
    if not loads:
        return (shards if touched is not None else replace(shards, live={}, written={})), 0, 0
    w = _per_key(shards)
    placed = _place(routed.withColumn(TAG, F.lit(NEW)), shards, loads)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in shards.schema if f.name not in df.columns]
    rows = placed.select("*", *missing, _duplicate_guard(w).alias("_single")).filter("_single")
    return _save(spark, shards, rows.select(SHARD, *shards.schema.names), touched, loads, exact)


def _prepared(table: KeyedTable, df: DataFrame, order_by, strict: bool) -> tuple[DataFrame, DataFrame]:
    """The rows to write, and rows with the same keys for counting: those need no pass for the last row per key."""
    extra = [c for c in (order_by or []) if isinstance(c, str) and c not in table.schema.names]
    named = by_name(df.drop(*extra), table.schema, strict)
    absent = [k for k in table.keys if k not in named.columns]
    if absent:
        raise ValueError(f"key columns {absent} are not in the written columns")
    keys = T.StructType([table.schema[k] for k in table.keys])
    if not order_by:
        return not_null(named, keys), named
    last = latest(df, table.keys, order_by).drop(*extra)
    return not_null(by_name(last, table.schema, strict), keys), named


def _write(table: KeyedTable, df: DataFrame, order_by, strict: bool, auto_key: str, run: Callable) -> WriteResult:
    if table.keys == (auto_key,) and auto_key not in df.columns:
        with _generated_keys(table.spark, table.path, df, auto_key) as keyed:
            return run(table, *_prepared(table, keyed, None, strict))
    with _read_once(table.spark, table.path, df, order_by, table.schema) as (rows, order):
        return run(table, *_prepared(table, rows, order, strict))


def insert(table: KeyedTable, df: DataFrame, order_by=None, strict=False, auto_key=AUTO_KEY) -> WriteResult:
    """Add rows; an existing key is an error. Stored rows are not rewritten, only their keys are looked up."""
    return _write(table, df, order_by, strict, auto_key, _insert)


def upsert(table: KeyedTable, df: DataFrame, order_by=None, strict=False, auto_key=AUTO_KEY) -> WriteResult:
    """Written columns overlay the row with the same key (a written null wins), other columns stay, new keys are added."""
    return _write(table, df, order_by, strict, auto_key, partial(_merge, keep_unwritten=True))


def bulk_upsert(table: KeyedTable, df: DataFrame, order_by=None, strict=False, auto_key=AUTO_KEY) -> WriteResult:
    """Upsert of a whole batch in one pass; the default write. With indexes it keeps them in step like any upsert."""
    return upsert(table, df, order_by, strict, auto_key)


def replace_rows(table: KeyedTable, df: DataFrame, order_by=None, strict=False, auto_key=AUTO_KEY) -> WriteResult:
    """The whole row is replaced; columns that are not written become null."""
    return _write(table, df, order_by, strict, auto_key, partial(_merge, keep_unwritten=False))


def overwrite(table: KeyedTable, df: DataFrame, order_by=None, strict=False, auto_key=AUTO_KEY) -> WriteResult:
    """Only the new rows remain. Old files stay, so the table itself may be read to build ``df``."""
    return _write(table, df, order_by, strict, auto_key, _overwrite)


def _insert(table: KeyedTable, new: DataFrame, sizing: DataFrame) -> WriteResult:
    keys = list(table.keys)
    loads = _loads(sizing, table.base)
    stored = table.base.read(table.spark, [s for s in loads if s in table.base.live]).select(*keys)
    if not stored.join(sizing.select(*keys), keys, "left_semi").isEmpty():
        raise ValueError("insert met a key that the table already holds")
    base, rows, size = _fresh(table.spark, table.base, new, set(), sizing, loads)
    indexes = {n: _fresh(table.spark, s, _index_rows(new, s), set())[0] for n, s in table.indexes.items()}
    return WriteResult(table.commit(base=base, indexes=indexes), rows, size)


def _overwrite(table: KeyedTable, new: DataFrame, sizing: DataFrame) -> WriteResult:
    base, rows, size = _fresh(table.spark, table.base, new, None, sizing)
    emptied = replace(table, base=base)
    indexes = {n: _fresh(table.spark, s, _index_rows(emptied.read(), s), None)[0] for n, s in table.indexes.items()}
    return WriteResult(table.commit(base=base, indexes=indexes), rows, size)


def truncate(table: KeyedTable) -> WriteResult:
    def empty(shards: Shards) -> Shards:
        return replace(shards, live={}, written={})

    return WriteResult(table.commit(base=empty(table.base), indexes={n: empty(s) for n, s in table.indexes.items()}))


def _index_rows(df: DataFrame, index: Shards) -> DataFrame:
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in index.schema])


def _merge(table: KeyedTable, new: DataFrame, sizing: DataFrame, keep_unwritten: bool) -> WriteResult:
    spark = table.spark
    indexed = sorted({c for index in table.indexes.values() for c in index.keys} - set(table.keys))
    capture = indexed or list(table.keys[:1])  # an index of key columns alone needs to know of new rows only
    merged, loads = _merged(spark, table.base, new, None, keep_unwritten, sizing, capture if table.indexes else ())
    if not loads:
        return WriteResult(table)
    base, rows, size = _save(spark, table.base, merged, set(loads), loads)
    indexes = {}
    for name, index in table.indexes.items():
        added, removed = _index_changes(spark, table.base, base, index, capture)
        entries, own = _merged(spark, index, added, removed)
        indexes[name] = _save(spark, index, entries, set(own), own)[0] if own else index
    return WriteResult(table.commit(base=base, indexes=indexes), rows, size)


def _index_changes(spark, old: Shards, new: Shards, index: Shards, capture: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Index entries that the last write made and those it took away, from what it noted beside the rows it wrote."""
    gen, = set(new.written) - set(old.written)
    columns = list(dict.fromkeys([*new.keys, *index.keys]))
    noted = T.StructType([T.StructField("had", T.BooleanType()), *[T.StructField(c, new.schema[c].dataType) for c in capture]])
    stored = T.StructType([*[new.schema[c] for c in columns], T.StructField(CHANGE, noted)])
    rows = spark.read.schema(stored).parquet(f"{new.folder}/{GEN}={gen}").filter(F.col(CHANGE).isNotNull())
    had = F.col(CHANGE)["had"]
    mine = [c for c in index.keys if c not in new.keys]
    same = F.lit(True)
    for c in mine:
        same = same & F.col(c).eqNullSafe(F.col(CHANGE)[c])
    before = [F.col(c) if c in new.keys else F.col(CHANGE)[c].alias(c) for c in index.schema.names]
    return rows.filter(~had | ~same).select(*index.schema.names), rows.filter(had & ~same).select(*before)


def key_names(text: str) -> list[str]:
    """Key names from one comma-separated text; blanks and empty names are skipped, the given order is kept."""
    return [n.strip() for n in text.split(",") if n.strip()]


def create_keyed(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str] | str | None = None,
    *,
    prefix: str | None = None,
    store: str = "range",
    splits: Sequence | None = None,
    shards: int | None = None,
    size_bytes: int | None = None,
    size_mb: int = 1000,
    min_shards: int = 1,
    max_shards: int | None = None,
    indexes: dict[str, Sequence[str]] | None = None,
    auto_key: str = AUTO_KEY,
    order_by: Sequence[Column | str] | None = None,
    schema: T.StructType | None = None,
    signed_dates: bool = True,
    rows_per_file: int = ROWS_PER_CELL,
) -> WriteResult:
    """Create a table from a DataFrame. Without keys a generated text key is added.

    The number of shards is given, or follows from split points, or from ``size_bytes``, or else from the measured size of
    the rows; split points that are not given come from the same pass. A source is read twice, and one that is more than a
    scan is evaluated once. ``rows_per_file`` bounds the rows of a file and so its key range (on average);
    a write of more than ``NARROW_FILES`` such files makes that many larger ones, until they hold a million rows.
    """
    path = files.resolve(prefix, name)
    if KeyedTable.exists(spark, path):
        raise FileExistsError(f"a keyed table is already at {path}")
    names = key_names(keys) if isinstance(keys, str) else list(keys or [])
    given = new_table_schema(schema or df.schema, signed_dates)
    df = coerce(df, given)
    check_names(df.schema)
    absent = [n for n in names if n not in df.columns]
    if absent or len(set(names)) != len(names):
        raise ValueError(f"key columns {names} must exist once in {df.columns}")

    def create(rows: DataFrame, keys: list[str], order_by=None) -> WriteResult:
        stored = [c for c in rows.columns if c in df.columns or c in keys]
        fields = [given[c] if c in given.names else rows.schema[c] for c in stored]
        declared = T.StructType([T.StructField(f.name, f.dataType, f.nullable and f.name not in keys, f.metadata) for f in fields])
        last = not_null(latest(rows, keys, order_by) if order_by else rows, T.StructType([declared[k] for k in keys]))
        empty = Shards(f"{path}/data", declared, tuple(keys), Layout.by_hash(1), cell_rows=rows_per_file)
        survey, loads = [], None
        if splits is not None and store == "range":
            layout = Layout.by_splits(splits)
        elif shards and store == "hash":
            layout = Layout.by_hash(shards)
        else:
            survey = _survey(rows, keys, stored, shards or 1, rows_per_file)
            count = shards or shard_count(size_bytes or sum(b for _, _, b in survey), size_mb, min_shards, max_shards)
            layout = Layout.by_hash(count) if store == "hash" else Layout.by_splits(_splits(survey, count))
            loads = _surveyed(survey, layout) if store == "range" else None
        base = replace(empty, layout=layout)
        base, written, size = _fresh(spark, base, last, set(), rows, loads or None, exact=loads is None)
        table = KeyedTable(spark, path, 0, base)
        built = {n: build_index(table, n, columns) for n, columns in (indexes or {}).items()}
        return WriteResult(table.commit(indexes=built), written, size)

    if names:
        with _read_once(spark, path, df, order_by, given) as (rows, order):
            return create(rows, names, order)
    if auto_key in df.columns:
        raise ValueError(f"column {auto_key} exists already; name it as the key")
    with _generated_keys(spark, path, df, auto_key) as keyed:
        return create(keyed, [auto_key])


def build_index(table: KeyedTable, name: str, columns: Sequence[str], splits: Sequence | None = None) -> Shards:
    """Write an index: a projection keyed by the index columns, then the primary key."""
    absent = [c for c in columns if c not in table.schema.names]
    if absent or not columns:
        raise ValueError(f"index columns {list(columns)} must exist in the table")
    keys = tuple(dict.fromkeys([*columns, *table.keys]))
    schema = T.StructType([T.StructField(k, table.schema[k].dataType, table.schema[k].nullable) for k in keys])
    rows = table.read(columns=keys)
    survey = _survey(rows, keys, keys, len(table.base.live), table.base.cell_rows) if splits is None else []
    layout = Layout.by_splits(splits if splits is not None else _splits(survey, max(1, len(table.base.live))))
    index = Shards(f"{table.path}/index-{name}", schema, keys, layout, cell_rows=table.base.cell_rows)
    loads = _surveyed(survey, layout) or None
    return _fresh(table.spark, index, rows, touched=set(), loads=loads, exact=loads is None)[0]
