"""Resharding by minimum-cost flow: the fewest bytes change their shard, and only files that lose or split are rewritten.

A store is a folder of rows in files of bounded size, ``rows/gen=<g>/file=<f>``, and a manifest of its files (one row each)
that says whose shard a file is and which slot its first row has. Rows keep their position within a file, so moving a whole
file to another shard changes the manifest alone.

To reshard, the bytes of the old shards flow to the capacities of the new ones at a cost per byte moved. The few documents
that are large against a shard are placed first, one by one; of the rest each old shard is one run of bytes, and the flow
cuts it. Files that lie between cuts change hands whole; files with a cut in them are read and written again, in one pass
without a shuffle.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed.llm.common import cut, ready, release, repeatable

#: Bytes of a text's row besides its UTF-8 text.
ROW_BYTES = 16
#: Bytes of a file, and files of a shard at least.
FILE_BYTES, LEAST_FILES = 64 << 20, 4
#: A document is large if a new shard holds fewer than this many of its size; there are at most LARGE x shards of these.
LARGE = 64
#: Manifest rows up to which the manifest is sent to every task; beyond it Spark chooses the join.
MOST_SENT = 100_000


def size_of(text: str | Column) -> Column:
    column = F.col(f"`{text}`") if isinstance(text, str) else text
    return (F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) + ROW_BYTES).cast("long")


def transfers(old: Sequence[int], new: Sequence[int], cost: np.ndarray | None = None) -> np.ndarray:
    """Minimum-cost flow: bytes from each old shard (row) to each new one (column), whole numbers, all old bytes placed.

    ``cost`` is the price of moving a byte; without it, 0 from a shard to the one of its number and 1 elsewhere. Capacities
    must hold the bytes. Shortest augmenting paths with potentials: every path is the cheapest left.
    """
    a, b = [int(x) for x in old], [int(x) for x in new]
    m, n = len(a), len(b)
    if sum(a) > sum(b):
        raise ValueError("the new shards cannot hold the bytes")
    price = (np.arange(m)[:, None] != np.arange(n)[None, :]).astype(np.int64) if cost is None else np.asarray(cost)
    flow = np.zeros((m, n), dtype=object)
    left, room = list(a), list(b)
    high_old, high_new = np.zeros(m), np.zeros(n)  # potentials keep all reduced costs at 0 or more
    for s in range(m):
        while left[s]:
            dist_old, dist_new = np.full(m, np.inf), np.full(n, np.inf)
            from_old, from_new = np.full(n, -1), np.full(m, -1)
            dist_old[s] = 0
            done: set[tuple[int, int]] = set()
            todo, end = [(0.0, 0, s)], -1
            while todo:
                d, side, v = heapq.heappop(todo)
                if (side, v) in done:
                    continue
                done.add((side, v))
                if side:
                    if room[v] and end < 0:
                        end = v
                        break
                    for u in range(m):  # back along bytes already sent
                        if flow[u, v]:
                            e = d - price[u, v] + high_new[v] - high_old[u]
                            if e < dist_old[u]:
                                dist_old[u], from_new[u] = e, v
                                heapq.heappush(todo, (float(e), 0, u))
                else:
                    e = d + price[v] + high_old[v] - high_new
                    for w in np.flatnonzero(e < dist_new):
                        dist_new[w], from_old[w] = e[w], v
                        heapq.heappush(todo, (float(e[w]), 1, int(w)))
            reach = dist_new[end]
            high_old += np.minimum(dist_old, reach)
            high_new += np.minimum(dist_new, reach)
            path, w = [], end
            while True:
                u = int(from_old[w])
                path.append((u, w))
                if u == s:
                    break
                w = int(from_new[u])
            amount = min([left[s], room[end]] + [flow[path[i][0], path[i + 1][1]] for i in range(len(path) - 1)])
            for i, (u, w) in enumerate(path):
                flow[u, w] += amount
                if i + 1 < len(path):
                    flow[u, path[i + 1][1]] -= amount
            left[s] -= amount
            room[end] -= amount
    return flow


def place_large(large: Sequence[tuple[int, int, int, int]], capacities: np.ndarray) -> list[int]:
    """New shards of large documents (shard, file, position, size), the largest first: each stays where it fits, else goes
    where most room is left."""
    room = capacities.astype(float)
    out = [0] * len(large)
    for i in sorted(range(len(large)), key=lambda i: (-large[i][3], *large[i][:3])):
        shard, size = large[i][0], large[i][3]
        out[i] = shard if shard < len(room) and room[shard] >= size else int(np.argmax(room))
        room[out[i]] -= size
    return out


def level_rooms(small_bytes: int, taken: np.ndarray, weights: np.ndarray) -> list[int]:
    """Room for the small documents: shards filled to one common level of bytes per weight, none below what it holds."""
    order = np.argsort(taken / weights)
    held, weight, level = 0.0, 0.0, 0.0
    for i, shard in enumerate(order):
        held, weight = held + taken[shard], weight + weights[shard]
        level = (small_bytes + held) / weight
        if i + 1 == len(order) or level <= taken[order[i + 1]] / weights[order[i + 1]]:
            break
    rooms = [max(0, int(level * w - t)) for w, t in zip(weights, taken, strict=True)]
    for i in np.resize(order, max(0, small_bytes - sum(rooms))):  # what rounding left over, a byte each
        rooms[i] += 1
    return rooms


class Store:
    """A snapshot of a sharded store; resharding gives the next one."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, manifest: DataFrame, shards: int, moved: int = 0, rewritten: int = 0):
        self.spark, self.folder, self.schema, self.manifest, self.shards = spark, folder, schema, manifest, shards
        #: Bytes that changed their shard, and bytes of files written again, in the step that made this snapshot.
        self.moved, self.rewritten = moved, rewritten

    def files(self) -> DataFrame:
        """gen, file, pos (within the file), size and the row of every row on disk, of this snapshot or not."""
        stored = T.StructType([T.StructField("pos", T.LongType()), T.StructField("size", T.LongType()), T.StructField("row", self.schema)])
        return self.spark.read.schema(T.StructType([*stored.fields, T.StructField("gen", T.StringType()), T.StructField("file", T.LongType())])).parquet(f"{self.folder}/rows")

    def listed(self) -> DataFrame:
        """Rows of this snapshot with shard and slot (gapless from 0 in each shard)."""
        sizes = self.manifest.select("gen", "file", "shard", "base")
        few = self.manifest.limit(MOST_SENT + 1).count() <= MOST_SENT
        rows = self.files().join(F.broadcast(sizes) if few else sizes, ["gen", "file"])
        return rows.withColumn("slot", F.col("base") + F.col("pos"))

    def read(self) -> DataFrame:
        """The documents in ``row``, with ``size``, ``shard`` and ``slot`` beside it: no column of theirs can clash."""
        return self.listed().select("row", "size", "shard", "slot")

    def totals(self) -> DataFrame:
        return self.manifest.groupBy("shard").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def _based(files: DataFrame) -> DataFrame:
    """The manifest: the first slot of every file follows from the rows of the files before it in its shard."""
    before = Window.partitionBy("shard").orderBy("gen", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("gen", "file", "shard", "rows", "bytes", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))


def write_store(docs: DataFrame, folder: str, shard: Column, shards: int, text: str = "text", doc_id: str = "doc_id", file_bytes: int = FILE_BYTES, least_files: int = LEAST_FILES) -> Store:
    """Writes documents as a store of ``shards`` shards; ``shard`` gives the number of a row's shard.

    A shard has as many files as its bytes ask for. Rows are dealt to a shard's files by their place in the input, not by
    their key, so copies of a row or of an id do not meet in one file. Nulls, repeats and extra columns are kept as they are;
    an empty table gives an empty store. One shuffle.
    """
    spark = ready(docs.sparkSession)
    source = docs if repeatable(docs) else cut(docs, "unsharded")
    rows = source.select(F.struct(*(F.col(f"`{c}`") for c in source.columns)).alias("row"), size_of(text).alias("size"), shard.cast("int").alias("shard"), F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("hash"))
    sizes = {r.shard: (r.n, r.b) for r in rows.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}
    if any(s is None or not 0 <= s < shards for s in sizes):
        raise ValueError(f"shards must lie in 0 to {shards - 1}")
    counts = [max(1, min(sizes[s][0], max(least_files, -(-sizes[s][1] // file_bytes)))) if s in sizes else 0 for s in range(shards)]
    first = np.concatenate(([0], np.cumsum(counts))).tolist()
    gen = uuid.uuid4().hex[:12]
    numbers = F.from_json(F.lit(str(first)), "array<long>")
    begin = F.get(numbers, F.col("shard"))
    # the row's place in the input is the same when a task of the scan runs again
    file = begin + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get(numbers, F.col("shard") + 1) - begin)
    # the window is over the very column that rows are dealt by, so it needs no shuffle of its own
    dealt = rows.withColumn("cell", file.cast("int")).repartitionById(max(1, first[-1]), F.col("cell"))
    pos = F.row_number().over(Window.partitionBy("cell").orderBy("hash")) - 1
    placed = dealt.withColumn("pos", pos.cast("long")).select(F.lit(gen).alias("gen"), F.col("cell").cast("long").alias("file"), "pos", "size", "row")
    placed.write.option("compression", "zstd").mode("append").partitionBy("gen", "file").parquet(f"{folder}/rows")
    release(spark)
    store = Store(spark, folder, rows.schema["row"].dataType, None, shards)
    found = store.files().filter(F.col("gen") == gen).groupBy("gen", "file").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    owner = F.from_json(F.lit(str([s for s in range(shards) for _ in range(counts[s])])), "array<int>")
    store.manifest = cut(_based(found.withColumn("shard", F.get(owner, F.col("file").cast("int")))), "manifest")
    written = store.manifest.agg(F.sum("rows")).first()[0] or 0
    if written != sum(n for n, _ in sizes.values()):
        raise RuntimeError("the documents changed while they were written")
    return store


def reshard(store: Store, shards: int, weights: Sequence[float] | None = None, cost: np.ndarray | None = None) -> Store:
    """The same rows in ``shards`` shards whose bytes are equal, or in proportion to ``weights``; the fewest bytes move.

    The driver sees numbers of old and new shards, the large documents (at most LARGE x ``shards``) and the cuts, never the
    rows. A shard's bytes differ from its share by half a small document at each of its cuts, and by what a large one leaves
    no choice in. ``cost`` prices a byte from each old shard to each new one, as for ``transfers``.
    """
    spark = store.spark
    w = np.ones(shards) if weights is None else np.array(weights, float)
    if len(w) != shards or (w <= 0).any():
        raise ValueError("weights must be positive, one for each shard")
    total = store.manifest.agg(F.sum("bytes")).first()[0] or 0
    if not total:
        return Store(spark, store.folder, store.schema, store.manifest, shards)
    least = max(1, int(total * (w.min() / w.sum()) / LARGE))
    # positions and sizes alone: no text is read
    narrow = store.files().select("gen", "file", "pos", "size").join(store.manifest.select("gen", "file", "shard"), ["gen", "file"])
    small = F.when(F.col("size") < least, F.col("size")).otherwise(0)
    per_file = cut(narrow.groupBy("gen", "file", "shard").agg(F.sum(small).alias("small")), "file-sizes")
    large = [(r.shard, r.gen, r.file, r.pos, r.size) for r in narrow.filter(F.col("size") >= least).select("shard", "gen", "file", "pos", "size").orderBy("gen", "file", "pos").collect()]
    homes = place_large([(s, f, p, z) for s, _, f, p, z in large], total * w / w.sum())
    taken = np.zeros(shards)
    for home, item in zip(homes, large, strict=True):
        taken[home] += item[4]
    old = {r.shard: r.b for r in per_file.groupBy("shard").agg(F.sum("small").alias("b")).collect()}
    sent = transfers([old.get(s, 0) for s in range(store.shards)], level_rooms(sum(old.values()), taken, w), cost)

    # each old shard's small documents are one run of bytes; its arcs cut the run, what stays comes first
    arcs, at = [], 0
    for s in range(store.shards):
        at = 0
        for j in sorted(np.flatnonzero(sent[s]).tolist(), key=lambda j: (j != s, j)):
            arcs.append((s, j, at, at + int(sent[s, j])))
            at = arcs[-1][3]
    arc = spark.createDataFrame(arcs, "shard int, dest int, since long, until long")
    run = Window.partitionBy("shard").orderBy("gen", "file")
    spans = per_file.withColumn("stop", F.sum("small").over(run)).withColumn("start", F.col("stop") - F.col("small"))
    crossed = spans.join(F.broadcast(arc), "shard").filter("since < stop AND until > start")
    placed = [(g, f, p, home) for home, (_, g, f, p, _) in zip(homes, large, strict=True)]
    has_large = spark.createDataFrame(sorted({(g, f) for g, f, _, _ in placed}), "gen string, file long")
    owners = crossed.groupBy("gen", "file").agg(F.count("*").alias("n"), F.min("dest").alias("dest"))
    judged = cut(
        spans.join(owners, ["gen", "file"], "left").join(F.broadcast(has_large.withColumn("large", F.lit(True))), ["gen", "file"], "left")
        .select("gen", "file", "shard", "start", "n", "dest", F.coalesce("large", F.lit(False)).alias("large")),
        "judged-files",
    )
    # a file with a cut or a large document: its rows are looked at one by one (positions and sizes)
    open_files = F.broadcast(judged.filter("large OR n > 1").select("gen", "file", "start"))  # at most arcs + large documents
    inside = Window.partitionBy("gen", "file").orderBy("pos")
    rows = narrow.join(open_files, ["gen", "file"]).withColumn("middle", F.col("start") + F.sum(small).over(inside) - F.col("size") / 2)
    whither = spark.createDataFrame(placed, "gen string, file long, pos long, home int")
    rows = rows.join(F.broadcast(whither), ["gen", "file", "pos"], "left")
    small_rows = rows.filter("home IS NULL").join(F.broadcast(arc), "shard").filter("middle >= since AND middle < until")
    names = ["gen", "file", "shard", "pos", "size"]
    sent_rows = small_rows.select(*names, "dest").unionAll(rows.filter("home IS NOT NULL").select(*names, F.col("home").alias("dest")))
    new_piece = (F.lag("dest").over(inside).isNull() | (F.lag("dest").over(inside) != F.col("dest"))).cast("int")
    pieces = (
        sent_rows.withColumn("begins", new_piece).withColumn("piece", F.sum("begins").over(inside))
        .groupBy("gen", "file", "shard", "piece").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.first("dest").alias("dest"), F.sum("size").alias("bytes"))
    )
    # at most two pieces for each cut and each large document
    found = sorted(tuple(r) for r in pieces.select("gen", "file", "lo", "hi", "shard", "dest", "bytes").collect())
    return _rewrite(store, shards, judged, found)


def _rewrite(store: Store, shards: int, judged: DataFrame, pieces: list[tuple]) -> Store:
    """Writes the files whose pieces go to different shards; all other files keep their rows and may change their owner."""
    spark, gen = store.spark, uuid.uuid4().hex[:12]
    per_file: dict[tuple, list[tuple]] = {}
    for p in pieces:
        per_file.setdefault(p[:2], []).append(p)
    split = {k: ps for k, ps in per_file.items() if len({p[5] for p in ps}) > 1}
    whole = [(*k, ps[0][5]) for k, ps in per_file.items() if k not in split]
    moved = sum(p[6] for p in pieces if p[4] != p[5])
    new, numbers, listed = [], {}, {}
    for (g, f), ps in split.items():
        for _, _, lo, hi, _, dest, size in ps:
            number = numbers.setdefault((g, f, dest), len(numbers))
            held = listed.setdefault(number, [dest, 0, 0])
            new.append((g, f, lo, hi, number, held[1] - lo))
            held[1] += hi - lo + 1
            held[2] += size
    rewritten = sum(size for _, _, size in listed.values())
    if new:
        cuts = F.broadcast(spark.createDataFrame(new, "gen string, file long, lo long, hi long, number long, shift long"))
        old = sorted({(g, f) for g, f, *_ in new})
        touched = store.files().filter(F.col("gen").isin(sorted({g for g, _ in old})) & F.col("file").isin([f for _, f in old]))
        rows = touched.join(cuts, ["gen", "file"]).filter("pos >= lo AND pos <= hi")
        out = rows.select(F.lit(gen).alias("gen"), F.col("number").alias("file"), (F.col("pos") + F.col("shift")).alias("pos"), "size", "row")
        out.write.option("compression", "zstd").mode("append").partitionBy("gen", "file").parquet(f"{store.folder}/rows")
    names = "gen string, file long, dest int"
    opened = spark.createDataFrame([(g, f, None) for g, f in split] + whole, names)
    kept = (
        store.manifest.select("gen", "file", "rows", "bytes", "shard")
        .join(judged.select("gen", "file", "dest"), ["gen", "file"])
        .join(F.broadcast(opened.select("gen", "file", F.col("dest").alias("to"), F.lit(True).alias("looked"))), ["gen", "file"], "left")
        .withColumn("to", F.when(F.col("looked"), F.col("to")).otherwise(F.col("dest")))
        .filter("to IS NOT NULL")
    )
    moved += kept.filter("looked IS NULL AND to <> shard").agg(F.sum("bytes")).first()[0] or 0
    files = kept.select("gen", "file", F.col("to").alias("shard"), "rows", "bytes")
    if listed:
        added = spark.createDataFrame([(gen, number, *held) for number, held in listed.items()], "gen string, file long, shard int, rows long, bytes long")
        files = files.unionByName(added)
    manifest = cut(_based(files), "manifest")
    after = Store(spark, store.folder, store.schema, manifest, shards, moved, rewritten)
    if [tuple(manifest.agg(F.sum("rows"), F.sum("bytes")).first())] != [tuple(store.manifest.agg(F.sum("rows"), F.sum("bytes")).first())]:
        raise RuntimeError("rows were lost or doubled")
    return after
