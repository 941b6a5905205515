"""Schema and layout changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import types as T

from ..plans.bounds import cut_key
from ..plans.layout import Layout, quantiles, shard_count
from ..sources.table import KeyedTable, Shards, Zone, check_names
from .write import Load, WriteResult, _fresh, _splits, _survey, _surveyed


def alter(table: KeyedTable, add: Sequence[T.StructField] = (), drop: Sequence[str] = ()) -> WriteResult:
    """Add and drop columns. Only the table record changes: files without a column read it as null."""
    added = [f.name for f in add]
    known = table.schema.names
    for name in added:
        if name in known:
            raise ValueError(f"column exists already: {name}")
        if added.count(name) > 1:
            raise ValueError(f"column added twice: {name}")
    for name in drop:
        if name in added:
            raise ValueError(f"column both added and dropped: {name}")
        if name not in known:
            raise ValueError(f"no such column: {name}")
        if list(drop).count(name) > 1:
            raise ValueError(f"column dropped twice: {name}")
        if name in table.keys:
            raise ValueError(f"key column cannot be dropped: {name}")
        using = [i for i, s in table.indexes.items() if name in s.keys]
        if using:
            raise ValueError(f"column {name} is used by indexes {using}")
    for f in add:
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError(f"nested column type: {f.name}")
        if not f.nullable and table.base.live:
            raise ValueError(f"stored rows would hold null in non-null column {f.name}")
    schema = T.StructType([f for f in table.schema if f.name not in drop] + list(add))
    check_names(schema)
    base = table.base
    if set(added) & set(table.dropped):
        # Old files still hold values under a name that was dropped before; they must not come back.
        rows = table.read()
        base = _fresh(table.spark, base, rows, touched=None)[0]
        gone = tuple(drop)
    else:
        gone = tuple(dict.fromkeys([*table.dropped, *drop]))
    return WriteResult(table.commit(base=replace(base, schema=schema), dropped=gone))


def add_columns(table: KeyedTable, *columns: T.StructField) -> WriteResult:
    return alter(table, add=columns)


def drop_columns(table: KeyedTable, *names: str) -> WriteResult:
    return alter(table, drop=names)


def reshard(
    table: KeyedTable,
    splits: Sequence | None = None,
    shards: int | None = None,
    store: str | None = None,
    size_mb: int = 1000,
    min_shards: int = 1,
    max_shards: int | None = None,
) -> WriteResult:
    """Rewrite the table under a new layout: given split points, a given number of shards, or a number from its size."""
    rows = table.read()
    count = shards or shard_count(table.size_bytes(), size_mb, min_shards, max_shards)
    survey = []
    if (store or table.layout.store) == "hash":
        layout = Layout.by_hash(count)
    else:
        survey = _survey(rows, table.keys, table.schema.names, count, table.base.cell_rows) if splits is None else []
        layout = Layout.by_splits(splits if splits is not None else _splits(survey, count))
    empty = Shards(table.base.folder, table.schema, table.keys, layout, cell_rows=table.base.cell_rows)
    loads = _surveyed(survey, layout) or None
    base, written, size = _fresh(table.spark, empty, rows, touched=set(), loads=loads, exact=loads is None)
    return WriteResult(table.commit(base=base, dropped=()), written, size)


def resize(table: KeyedTable, max_mb: float = 2000, min_mb: float = 250) -> WriteResult:
    """Splits shards of more than ``max_mb`` and merges neighbours of together at most ``min_mb``; so do its indexes.

    Sizes, and the keys to split at, come from the record of the files. Only shards that are split or merged are read and
    written again, all others keep their files under their new number. A hash layout has no neighbours: use ``reshard``.
    """
    if not 0 <= min_mb < max_mb:
        raise ValueError("min_mb must lie below max_mb")
    done = [_resized(table.spark, s, int(max_mb * (1 << 20)), int(min_mb * (1 << 20))) for s in (table.base, *table.indexes.values())]
    if all(d is None for d in done):
        return WriteResult(table)
    base, *indexes = [d or (s, 0, 0) for d, s in zip(done, (table.base, *table.indexes.values()))]
    return WriteResult(table.commit(base=base[0], indexes={n: i[0] for n, i in zip(table.indexes, indexes)}), base[1], base[2])


def _resized(spark, shards: Shards, most: int, least: int) -> tuple[Shards, int, int] | None:
    """The shards under new split points, with the rows and bytes written again; None if nothing is to be done."""
    stored = shards.stored(spark, shards.live)
    if shards.layout.store != "range" or stored is None:
        return None
    sizes = [sum(z.size for z in stored.get(s, ())) for s in range(shards.layout.shards)]
    cuts = {}
    for s, size in enumerate(sizes):
        if size > most:
            files = sorted(stored[s], key=lambda z: cut_key((z.first, -1)))
            if found := quantiles([(z.first, z.size) for z in files], -(-size // most)):
                cuts[s] = found
    runs: list[list[int]] = []  # neighbours that become one shard
    for s, size in enumerate(sizes):
        if runs and s not in cuts and runs[-1][-1] not in cuts and sum(sizes[r] for r in runs[-1]) + size <= least:
            runs[-1].append(s)
        else:
            runs.append([s])
    if not cuts and all(len(r) == 1 for r in runs):
        return None
    splits, places, touched = [], {}, []
    for run in runs:
        if run[0]:
            splits.append(shards.layout.splits[run[0] - 1])
        if len(run) > 1 or run[0] in cuts:
            touched += run
            splits += cuts.get(run[0], [])
        else:
            places[run[0]] = len(splits)
    rows = shards.read(spark, [s for s in touched if s in shards.live]).select(*shards.schema.names)
    after = shards.under(Layout.by_splits(splits), places)
    return _fresh(spark, after, rows, touched=set(), loads=_recorded(shards, touched, stored, after.layout), exact=False)


def _recorded(shards: Shards, touched: Sequence[int], stored: dict[int, list[Zone]], layout: Layout) -> dict[int, Load]:
    """The work that the files of these shards make under another range layout, by their first keys: nothing is read."""
    zones = sorted((z for s in touched for z in stored.get(s, ())), key=lambda z: cut_key((z.first, -1)))
    loads = _surveyed([(z.first, z.rows, z.rows * shards.row_bytes) for z in zones], layout)
    for load in loads.values():
        load.keys = [k for k in load.keys if None not in k[0]]
    return loads
