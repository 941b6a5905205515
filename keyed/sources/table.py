"""Keyed tables: Parquet files under shard directories, plus one small record per committed version.

``<path>/_commits/<n>.json`` holds keys, schema, layout and, per shard, the generations that make it up;
``<path>/data/_gen=<g>/_shard=<i>/*.parquet`` holds the rows, and ``_gen=<g>/_zones.json`` what each file holds: rows, bytes,
first and last key. The files of a shard in one generation hold rising key ranges that do not overlap, so a read by key finds
its files by bisection. A write adds a generation and then publishes a record, so readers see the table before or after a
write and a failed job leaves nothing visible. One writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.bounds import cut_key, fit, instant_text, range_condition
from ..plans.layout import TREE_SPLITS, Layout, count_splits, int_array, key_struct, quantiles, splits_before, tuple_array
from ..plans.rangeset import EVERY, Leaf, Node, RangeSet, as_column, condition, key_set
from . import files

SHARD, GEN = "_shard", "_gen"
#: What a written row replaced, kept beside it for the table's indexes; not a column of the table.
CHANGE = "_change"
#: Rows of one file's worth of work, unless a table says otherwise.
ROWS_PER_CELL = 1_000_000
BYTES_PER_CELL = 256 * 1024 * 1024
#: Files of few rows that one write makes, and tasks that write or read them: what is more goes into larger files, up to
#: these rows, and several files to a task.
NARROW_FILES, NARROW_TASKS = 80, 40
#: Whole keys of a condition that are hashed to find their shards; more open all shards of a hash layout.
MOST_HASHED = 10_000


def _encode(value: Any, dtype: T.DataType) -> Any:
    if value is None:  # an index may hold nulls
        return None
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(dtype, T.TimestampType):
        return instant_text(value)
    if isinstance(value, dt.timedelta):
        return value // dt.timedelta(microseconds=1)
    return value if isinstance(value, (bool, int, float, str)) else str(value)


def _decode(value: Any, dtype: T.DataType) -> Any:
    if value is not None and isinstance(dtype, T.BinaryType):
        return bytes.fromhex(value)
    return fit(value, dtype)


@dataclass(frozen=True)
class Zone:
    """What one file holds."""

    file: str
    rows: int
    size: int
    first: tuple
    last: tuple


class Zones:
    """The files of one shard in one generation, in key order."""

    def __init__(self, zones: Sequence[Zone]):
        self.files = sorted(zones, key=lambda z: cut_key((z.first, -1)))
        self._ends = [cut_key((z.last, 1)) for z in self.files]

    def holding(self, found: RangeSet) -> list[Zone]:
        """Files that can hold keys of these ranges; each range starts at the first file that does not end before it."""
        out, at = [], 0
        for lo, hi in found.spans:
            at = max(at, bisect_right(self._ends, cut_key(lo)))
            while at < len(self.files) and cut_key((self.files[at].first, -1)) < cut_key(hi):
                out.append(self.files[at])
                at += 1
        return out


#: Zones by folder and generation; a generation never changes. All are forgotten once there are so many.
MOST_KNOWN = 256
_known: dict[tuple[str, str], dict[int, Zones] | None] = {}


@dataclass(frozen=True)
class Shards:
    """One set of sharded files: the rows of a table, or of one of its indexes."""

    folder: str
    schema: T.StructType
    keys: tuple[str, ...]
    layout: Layout
    live: dict[int, tuple[str, ...]] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)
    row_bytes: int = 0
    cell_rows: int = ROWS_PER_CELL
    #: Folder number of a shard in generations that are older than its place in the layout (else the two agree).
    homes: dict[str, dict[int, int]] = field(default_factory=dict)

    def home(self, gen: str, shard: int) -> int:
        return self.homes.get(gen, {}).get(shard, shard)

    def key_types(self) -> list[T.DataType]:
        return [self.schema[k].dataType for k in self.keys]

    def file_rows(self, rows: int) -> int:
        """Rows of a file where so many are written at once: the table's own number, or more if that made too many files."""
        return max(self.cell_rows, min(ROWS_PER_CELL, -(-rows // NARROW_FILES)))

    def task_rows(self, rows: int) -> int:
        """Rows of a task: a file's, or a multiple of it where that made too many tasks."""
        own = self.file_rows(rows)
        return own * max(1, min(-(-rows // (NARROW_TASKS * own)), ROWS_PER_CELL // own))

    def shard_column(self) -> Column:
        return self.layout.shard_of([F.col(k) for k in self.keys], self.key_types())

    def holding(self, spark: SparkSession, found: RangeSet) -> list[int]:
        """Stored shards that can hold keys of these ranges. A hash layout is pruned for whole keys."""
        if found == EVERY:
            return list(self.live)
        if self.layout.store == "hash":
            points = [lo[0] for lo, hi in found.spans if lo[0] == hi[0] and len(lo[0]) == len(self.keys)]
            if len(points) < len(found.spans) or len(points) > MOST_HASHED:
                return list(self.live)
            wanted: Iterable[int] = self._hashed(spark, points) if points else ()
        else:
            wanted = {s for r in found.ranges() for s in self.layout.shards_in(r)}
        return [s for s in sorted(wanted) if s in self.live]

    def _hashed(self, spark: SparkSession, points: Sequence[tuple]) -> set[int]:
        key = F.explode(tuple_array(points, self.key_types()))
        parts = spark.range(1).select(key.alias("k"))
        values = [F.col("k")] if len(self.keys) == 1 else [F.col("k")[f"k{i}"] for i in range(len(self.keys))]
        return {r[0] for r in parts.select(self.layout.shard_of(values, self.key_types())).distinct().collect()}

    def zones(self, spark: SparkSession, gen: str) -> dict[int, Zones] | None:
        """What the files of a generation hold, by shard; None where that was not recorded."""
        at = (self.folder, gen)
        out = _known.get(at, ())
        if out != ():
            return out
        path = f"{self.folder}/{GEN}={gen}/_zones.json"
        found: dict[int, list[Zone]] | None = None
        if files.exists(spark, path):
            found, types = {}, self.key_types()
            for shard, file, rows, size, first, last in json.loads(files.read_text(spark, path)):
                ends = (tuple(_decode(v, t) for v, t in zip(side, types)) for side in (first, last))
                found.setdefault(shard, []).append(Zone(file, rows, size, *ends))
        if len(_known) >= MOST_KNOWN:
            _known.clear()
        out = _known[at] = None if found is None else {s: Zones(z) for s, z in found.items()}
        return out

    def record_zones(self, spark: SparkSession, gen: str) -> list[int]:
        """Looks at the keys of a new generation and notes what each of its files holds; returns its shards."""
        if any(isinstance(t, T.YearMonthIntervalType) for t in self.key_types()):  # Python has no such values
            return shards_on_disk(spark, self.folder, gen)
        keys = T.StructType([self.schema[k] for k in self.keys]).add(SHARD, T.IntegerType())
        rows = spark.read.schema(keys).parquet(f"{self.folder}/{GEN}={gen}")
        one = len(self.keys) == 1
        key = F.col(self.keys[0]) if one else key_struct(self.keys)  # a plain number stays in a hash aggregate
        of_file = rows.groupBy(F.col(SHARD).alias("s"), F.col("_metadata.file_name").alias("f")).agg(
            F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("b"), F.min(key).alias("lo"), F.max(key).alias("hi")
        )
        types = self.key_types()
        found = [[r.s, r.f, r.n, r.b, *([_encode(v, t) for v, t in zip([side] if one else side, types)] for side in (r.lo, r.hi))] for r in of_file.collect()]
        files.publish_text(spark, f"{self.folder}/{GEN}={gen}/_zones.json", json.dumps(sorted(found, key=lambda z: z[:2])))
        return sorted({z[0] for z in found})

    def stored(self, spark: SparkSession, shards: Iterable[int]) -> dict[int, list[Zone]] | None:
        """The files of these shards, of all their generations; None where any was not recorded."""
        out: dict[int, list[Zone]] = {}
        for s in shards:
            for gen in self.live.get(s, ()):
                zones = self.zones(spark, gen)
                if zones is None:
                    return None
                out.setdefault(s, []).extend(zones[self.home(gen, s)].files)
        return out

    def paths(self, spark: SparkSession, shards: Iterable[int], found: RangeSet | None = None) -> list[str]:
        """What to read: a whole generation where every shard of it is wanted, else single shards, or the files in them
        that can hold keys of the ranges."""
        wanted: dict[str, list[int]] = {}
        for s in shards:
            for gen in self.live.get(s, ()):
                wanted.setdefault(gen, []).append(s)
        out = []
        for gen, held in wanted.items():
            zones = self.zones(spark, gen) if found is not None else None
            folder, whole, parts = f"{self.folder}/{GEN}={gen}", 0, []
            for s in held:
                home = self.home(gen, s)
                some = zones[home].holding(found) if zones else None
                if some is None or len(some) == len(zones[home].files):
                    whole += 1
                    parts.append(f"{folder}/{SHARD}={home}")
                else:
                    parts += [f"{folder}/{SHARD}={home}/{z.file}" for z in some]
            out += [folder] if whole == self.written[gen] else parts
        return out

    def read(self, spark: SparkSession, shards: Iterable[int] | None = None, found: RangeSet | None = None) -> DataFrame:
        """Rows of these shards with their shard number; other shards' files are not listed or opened, nor are files
        that hold no key of the ranges, if these are given."""
        paths = self.paths(spark, self.live if shards is None else shards, found)
        schema = T.StructType(list(self.schema.fields)).add(SHARD, T.IntegerType())
        if not paths:
            return spark.createDataFrame([], schema)
        stored = T.StructType(list(schema.fields)).add(GEN, T.StringType())
        rows = spark.read.schema(stored).option("basePath", self.folder).parquet(*paths).drop(GEN)
        return rows.withColumn(SHARD, self.shard_column()) if self.homes else rows

    def after(self, gen: str, shards: Sequence[int], touched: Iterable[int] | None, row_bytes: int) -> Shards:
        """The set once a generation is written: touched shards are replaced (None: all), or appended to if empty."""
        gone = set(self.live if touched is None else touched)
        live = {s: g for s, g in self.live.items() if s not in gone}
        for s in shards:
            live[s] = live.get(s, ()) + (gen,)
        used = {g for gens in live.values() for g in gens}
        written = {g: n for g, n in {**self.written, gen: len(shards)}.items() if g in used}
        homes = {g: h for g, h in self.homes.items() if g in used}
        return replace(self, live=live, written=written, homes=homes, row_bytes=row_bytes or self.row_bytes)

    def under(self, layout: Layout, places: dict[int, int]) -> Shards:
        """The same files under another layout: ``places`` has the new number of each shard that keeps its files."""
        live = {new: self.live[old] for old, new in places.items() if old in self.live}
        used = {g for gens in live.values() for g in gens}
        homes = {g: {new: self.home(g, old) for old, new in places.items() if g in self.live.get(old, ())} for g in used}
        moved = {g: h for g, h in homes.items() if any(new != home for new, home in h.items())}
        return replace(self, layout=layout, live=live, written={g: n for g, n in self.written.items() if g in used}, homes=moved)

    def to_dict(self) -> dict:
        generations = sorted(self.written)
        number = {g: i for i, g in enumerate(generations)}
        return {
            "folder": self.folder.rsplit("/", 1)[-1],
            "schema": self.schema.jsonValue(),
            "keys": list(self.keys),
            "store": self.layout.store,
            "shards": self.layout.shards,
            "splits": [[_encode(v, t) for v, t in zip(s, self.key_types())] for s in self.layout.splits],
            "generations": [[g, self.written[g]] for g in generations],
            "row_bytes": self.row_bytes,
            "cell_rows": self.cell_rows,
            "homes": {g: {str(s): h for s, h in own.items()} for g, own in self.homes.items()},
            "live": {str(s): [number[g] for g in gens] for s, gens in self.live.items()},
        }

    @staticmethod
    def from_dict(parent: str, d: dict) -> Shards:
        schema = T.StructType.fromJson(d["schema"])
        keys = tuple(d["keys"])
        types = [schema[k].dataType for k in keys]
        splits = tuple(tuple(_decode(v, t) for v, t in zip(s, types)) for s in d["splits"])
        names = [g for g, _ in d["generations"]]
        return Shards(
            f"{parent}/{d['folder']}",
            schema,
            keys,
            Layout(d["store"], d["shards"], splits),
            {int(s): tuple(names[i] for i in gens) for s, gens in d["live"].items()},
            dict(d["generations"]),
            d["row_bytes"],
            d.get("cell_rows", ROWS_PER_CELL),
            {g: {int(s): h for s, h in own.items()} for g, own in d.get("homes", {}).items()},
        )


@dataclass(frozen=True)
class KeyedTable:
    """A snapshot of a table; writes return the next snapshot (see ``keyed.operators.write``)."""

    spark: SparkSession
    path: str
    version: int
    base: Shards
    indexes: dict[str, Shards] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()

    @property
    def keys(self) -> tuple[str, ...]:
        return self.base.keys

    @property
    def schema(self) -> T.StructType:
        return self.base.schema

    @property
    def layout(self) -> Layout:
        return self.base.layout

    @staticmethod
    def exists(spark: SparkSession, name: str, prefix: str | None = None) -> bool:
        return bool(_versions(spark, files.resolve(prefix, name)))

    @staticmethod
    def open(spark: SparkSession, name: str, prefix: str | None = None) -> KeyedTable:
        """Latest version; opening never creates a table."""
        path = files.resolve(prefix, name)
        versions = _versions(spark, path)
        if not versions:
            raise FileNotFoundError(f"no keyed table at {path}")
        record = json.loads(files.read_text(spark, _commit_path(path, max(versions))))
        return KeyedTable(
            spark,
            path,
            max(versions),
            Shards.from_dict(path, record["base"]),
            {n: Shards.from_dict(path, d) for n, d in record["indexes"].items()},
            tuple(record["dropped"]),
        )

    def commit(self, **changes: Any) -> KeyedTable:
        """Publish the next version; base and indexes switch together."""
        after = replace(self, version=self.version + 1, **changes)
        record = {
            "base": after.base.to_dict(),
            "indexes": {n: s.to_dict() for n, s in after.indexes.items()},
            "dropped": list(after.dropped),
        }
        files.publish_text(self.spark, _commit_path(self.path, after.version), json.dumps(record))
        return after

    def conditions(self, where: Sequence[Sequence]) -> Leaf | Node:
        """All of them together, with values of the columns' types; see ``keyed.plans.rangeset``."""
        return condition(("and", list(where)), self.schema)

    def read(
        self,
        where: Sequence[Sequence] = (),
        columns: Sequence[str] | None = None,
        with_shard: bool = False,
    ) -> DataFrame:
        """Scan with conditions: (column, operator, value) triples, and ``and``, ``or``, ``not`` over them.

        What they say about the key chooses the shards and, in these, the files; all conditions are applied to the rows as
        well, so they also reach the Parquet reader.
        """
        given = self.conditions(where)
        found = key_set(self.keys, given)
        df = self.base.read(self.spark, self.base.holding(self.spark, found), None if found == EVERY else found)
        if len(found.spans) == 1:
            by_range = range_condition(self.keys, self.base.key_types(), found.ranges()[0])
            if by_range is not None:
                df = df.filter(by_range)
        for part in given.parts:
            df = df.filter(as_column(part, self.schema))
        names = list(columns) if columns is not None else list(self.schema.names)
        return df.select(*names, *([SHARD] if with_shard else []))

    def ordered(self, where: Sequence[Sequence] = (), columns: Sequence[str] | None = None) -> DataFrame:
        """Rows in the order of shard and key: tasks hold consecutive key ranges, whatever files a shard has.

        The recorded files say where the ranges begin, so nothing is sampled; a layout that has no record of its files is.
        Neighbouring files of few rows share a range, so that tasks do not grow in number with such files.
        """
        names = list(columns) if columns is not None else list(self.schema.names)
        rows = self.read(where, list(dict.fromkeys([*names, *self.keys])), True)
        stored = self.base.stored(self.spark, sorted(self.base.live))
        if stored is None:
            return rows.repartitionByRange(SHARD, *self.keys).sortWithinPartitions(SHARD, *self.keys)
        unit = self.base.task_rows(sum(z.rows for zones in stored.values() for z in zones))
        starts = {}
        for s, zones in stored.items():
            work = [(z.first, max(z.rows / unit, z.rows * self.base.row_bytes / BYTES_PER_CELL)) for z in sorted(zones, key=lambda z: cut_key((z.first, -1)))]
            starts[s] = quantiles(work, max(1, math.ceil(sum(w for _, w in work))))
        firsts, cells = [], 0
        for s in range(self.layout.shards):
            firsts.append(cells)
            cells += 1 + len(starts[s]) if s in starts else 0
        cell = cell_column(self.base, firsts, starts)
        return rows.repartitionById(max(1, cells), cell).sortWithinPartitions(SHARD, *self.keys)

    def index(self, name: str) -> DataFrame:
        """An index as a table of its own: index columns, then the primary key."""
        return self.indexes[name].read(self.spark).drop(SHARD)

    def size_bytes(self) -> int:
        """Bytes of the files, as recorded when they were written."""
        stored = self.base.stored(self.spark, self.base.live)
        if stored is None:
            return files.bytes_under(self.spark, self.base.paths(self.spark, self.base.live))
        return sum(z.size for zones in stored.values() for z in zones)


def cell_column(shards: Shards, firsts: Sequence[int], cuts: dict[int, Sequence[tuple]]) -> Column:
    """The cell of a row: the first of its shard, and one more for each of the shard's cuts at or below its key."""
    at, keys, types = F.col(SHARD), [F.col(k) for k in shards.keys], shards.key_types()
    first = F.get(int_array(firsts), at)
    total = sum(map(len, cuts.values()))
    if not total:
        return first.cast("int")
    if total <= TREE_SPLITS:
        passed = F.lit(0)
        for s, own in cuts.items():
            if own:
                passed = F.when(at == s, splits_before(keys, types, own)).otherwise(passed)
        return (first + passed).cast("int")
    # all cuts as one rising list of (shard, key); those of earlier shards are taken off again
    points = [(s, *k) for s in sorted(cuts) for k in cuts[s]]
    earlier, n = [], 0
    for s in range(shards.layout.shards):
        earlier.append(n)
        n += len(cuts.get(s, ()))
    passed = count_splits([at, *keys], [T.IntegerType(), *types], points)
    return (first + passed - F.get(int_array(earlier), at)).cast("int")


def new_generation() -> str:
    return f"g{uuid.uuid4().hex[:12]}"


def shards_on_disk(spark: SparkSession, folder: str, gen: str) -> list[int]:
    names = files.child_names(spark, f"{folder}/{GEN}={gen}")
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{SHARD}="))


def _commit_path(path: str, version: int) -> str:
    return f"{path}/_commits/{version:08d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = files.child_names(spark, f"{path}/_commits")
    return [int(n[:-5]) for n in names if n.endswith(".json")]


def check_names(schema: T.StructType) -> None:
    repeated = [n for n, c in Counter(n.lower() for n in schema.names).items() if c > 1]
    reserved = [n for n in schema.names if n in (SHARD, GEN, CHANGE)]
    if repeated or reserved:
        raise ValueError(f"column names repeated {repeated} or reserved {reserved}")
