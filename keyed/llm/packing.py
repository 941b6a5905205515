"""Packing of documents into sequences of bounded length by linear grouping.

The lengths of all pieces form a histogram with at most ``capacity`` entries, whatever the corpus holds. The plan is made
on that histogram: large lengths are put into groups of equal cardinality and rounded up to the largest of their group,
few-size configurations are chosen for the rounded lengths, actual lengths take the places of the rounded ones, and small
lengths go where they fit best. Documents get their places by rank among those of the same length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyed.llm.common import cut, per_text, ready, shuffle_partitions
from keyed.llm.tokens import encoder

#: Groups of large lengths, and the part of the capacity above which a length is large.
GROUPS, LARGE = 96, 1 / 8
#: Such pairs that are tried in turn until a plan needs no more sequences than the tokens fill. With 1/2 each large length has a
#: sequence of its own and the rest is plain best fit.
TRIED = ((96, 1 / 8), (96, 1 / 4), (96, 1 / 2), (384, 1 / 4), (384, 1 / 8))

_PIECE = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of a document of n tokens, and n. Only the first piece of a longer one may be shorter."""
    return [0, *range(n % capacity or capacity, n, capacity), n] if n else [0]


def pieces(docs: DataFrame, tokenizer: str, end: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the CRC-32 of its ids as little-endian unsigned 32-bit integers."""
    ready(docs.sparkSession)
    tail = np.array([end], "<u4").tobytes()

    def of(texts: list[str | None]) -> pa.Array:
        out = []
        for ids in encoder(tokenizer).encode(texts):
            view = memoryview(ids + tail)
            at = cut_points(len(view) // 4, capacity)
            out.append([(k, a, b - a, zlib.crc32(view[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))])
        return pa.array(out, pa.list_(_PIECE))

    column = per_text(of, "array<struct<piece:int,start:long,length:long,ids_crc32:long>>", text)
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(column).alias("p")).select("doc_id", "p.*")


def grouped(counts: dict[int, int], groups: int) -> dict[int, list[tuple[int, int]]]:
    """Linear grouping: rounded length -> its actual (length, count), longest first. Groups have about equal counts."""
    total = sum(counts.values())
    out: dict[int, list[tuple[int, int]]] = {}
    seen = 0
    for size in sorted(counts, reverse=True):
        if not out or seen * groups >= total * len(out):
            top = size
        out.setdefault(top, []).append((size, counts[size]))
        seen += counts[size]
    return out


def _fill(sizes: list[int], left: dict[int, int], room: int) -> list[int]:
    """Lengths, from what is left, whose sum comes nearest to the room; longer ones first among equals."""
    reach = np.full(room + 1, -1, np.int64)  # the last length on the way to each sum
    reach[0] = 0
    used = np.zeros(room + 1, np.int64)  # how many of the current length that way has
    for s in sizes:
        if s > room:
            continue
        used[:] = 0
        for _ in range(min(left[s], room // s)):
            free = np.flatnonzero((reach[s:] < 0) & (reach[:-s] >= 0) & (used[:-s] < left[s]))
            if not len(free):
                break
            reach[free + s] = s
            used[free + s] = used[free] + 1
    at = int(np.flatnonzero(reach >= 0)[-1])
    out = []
    while at:
        out.append(int(reach[at]))
        at -= out[-1]
    return out


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, number of such sequences): each takes the longest length left and fills up closest."""
    left = {s: n for s, n in counts.items() if n}
    out = []
    while left:
        sizes = sorted(left, reverse=True)
        top = sizes[0]
        left[top] -= 1
        rest = _fill([s for s in sizes if left[s]], left, capacity - top)
        left[top] += 1
        chosen = [top, *rest]
        need = {s: chosen.count(s) for s in set(chosen)}
        times = min(left[s] // k for s, k in need.items())
        out.append((chosen, times))
        for s, k in need.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
    return out


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS, large: float = LARGE) -> list[tuple[tuple[int, ...], int]]:
    """(actual lengths of one sequence, number of such sequences) for a histogram of lengths from 1 to capacity.

    Its size is bounded by the number of different lengths, not by their counts.
    """
    big = {s: n for s, n in counts.items() if s > capacity * large and n}
    runs = grouped(big, groups)
    queue = {top: [list(r) for r in rs] for top, rs in runs.items()}
    bins: dict[tuple[int, ...], int] = defaultdict(int)
    for chosen, times in configurations({top: sum(n for _, n in rs) for top, rs in runs.items()}, capacity):
        while times:  # documents take the places: as many sequences at once as have the same actual lengths
            need: dict[int, int] = {s: chosen.count(s) for s in chosen}
            step = min(times, *(queue[s][-1][1] // k if queue[s][-1][1] >= k else 1 for s, k in need.items()))
            actual: list[int] = []
            for s, k in need.items():
                want = k * step
                while want:  # more than one run only where step is 1, across the border of two lengths
                    run = queue[s][-1]
                    n = min(want, run[1])
                    actual += [run[0]] * (n // step)
                    run[1] -= n
                    want -= n
                    if not run[1]:
                        queue[s].pop()
            bins[tuple(sorted(actual, reverse=True))] += step
            times -= step
    rooms: dict[int, list[list]] = defaultdict(list)
    for sizes, n in bins.items():
        rooms[capacity - sum(sizes)].append([sizes, n])
    order = sorted(rooms)

    def put(sizes: tuple[int, ...], n: int) -> None:
        room = capacity - sum(sizes)
        if room not in rooms or not rooms[room]:
            if room not in rooms:
                bisect.insort(order, room)
            rooms[room] = []
        rooms[room].append([sizes, n])

    for s in sorted((s for s in counts if s <= capacity * large and counts[s]), reverse=True):
        n = counts[s]
        while n:
            at = bisect.bisect_left(order, s)
            while at < len(order) and not rooms[order[at]]:
                del rooms[order[at]], order[at]
            if at == len(order):  # nothing has room: a new sequence
                each = capacity // s
                sizes, m = (), max(1, n // each)
            else:
                room = order[at]
                each = room // s
                sizes, m = rooms[room].pop()
            take = min(each, n)
            k = min(m, n // take)
            if k < m:
                put(sizes, m - k)
            put(sizes + (s,) * take, k)
            n -= take * k
    return sorted(((sizes, n) for held in rooms.values() for sizes, n in held), key=lambda x: (-sum(x[0]), x[0]))


def fewest(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan of fewest sequences among those of TRIED; never more than best fit of falling lengths needs."""
    least = -(-sum(s * n for s, n in counts.items()) // capacity)
    best: tuple[int, list] | None = None
    for groups, large in TRIED:
        found = plan(counts, capacity, groups, large)
        n = sum(times for _, times in found)
        if best is None or n < best[0]:
            best = n, found
        if n <= least:
            break
    return best[1]


def places(packed: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan as runs of ranks: the documents of one length with ranks from ``lo`` on take sequences from ``seq`` on."""
    at: dict[int, int] = defaultdict(int)
    rows, seq = [], 0
    for sizes, times in packed:
        base = 0
        for s in dict.fromkeys(sizes):
            c = sizes.count(s)
            rows.append((s, at[s], seq, c, base))
            at[s] += c * times
            base += s * c
        seq += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return {"size": a[:, 0], "lo": a[:, 1], "seq": a[:, 2], "each": a[:, 3], "base": a[:, 4], "first": np.searchsorted(a[:, 0], np.arange(a[:, 0].max(initial=0) + 2))}


def place(runs: dict[str, np.ndarray], size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank."""
    key = (runs["size"] << 44) | runs["lo"]
    row = np.searchsorted(key, (size << 44) | rank, side="right") - 1
    nth = rank - runs["lo"][row]
    each = runs["each"][row]
    return runs["seq"][row] + nth // each, runs["base"][row] + size * (nth % each)


def ranked(rows: DataFrame, size: str, order: list[str], salt: list[str]) -> DataFrame:
    """Adds ``rank``, from 0 without gaps, within each value of ``size``. A frequent value is dealt over many tasks by a salt."""
    n = shuffle_partitions(rows.sparkSession)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*salt), F.lit(n)).cast("int"))
    before = Window.partitionBy("__size").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy(F.col(size).alias("__size"), F.col("__salt").alias("__s")).agg(F.count("*").alias("__n"))
    starts = counts.select("__size", "__s", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inner = F.row_number().over(Window.partitionBy(size, "__salt").orderBy(*order)) - 1
    joined = salted.withColumn("__inner", inner).join(starts, (F.col(size) == F.col("__size")) & (F.col("__salt") == F.col("__s")))
    return joined.withColumn("rank", F.col("__inner") + F.col("__before")).drop("__salt", "__size", "__s", "__inner", "__before")


def pack(docs: DataFrame, tokenizer: str, end: int = 0, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Packs all documents into few sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its ids and the
    id ``end``; a null or empty text is one piece of one token. Only documents longer than ``capacity`` are cut. Copies and
    rows with the same or a null id are packed one by one; extra columns are not kept; an empty table gives no rows.

    Texts are encoded once and never shuffled; pieces (some 40 bytes each) go to a table in the shared folder. The driver
    sees one count per length, at most ``capacity`` of them, and the plan sent to the tasks has about as many rows.
    """
    rows = cut(pieces(docs, tokenizer, end, capacity, doc_id, text), "pieces")
    counts = {int(r["length"]): int(r["n"]) for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = places(fewest(counts, capacity))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def where(size: pa.Array, rank: pa.Array) -> pa.Array:
        seq, offset = place(runs, size.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(seq), pa.array(offset)], ["sequence_id", "offset"])

    at = ranked(rows, "length", ["doc_id", "piece", "start", "ids_crc32"], ["doc_id", "piece", "ids_crc32"])
    found = at.withColumn("__at", where("length", F.col("rank").cast("long")))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "__at.sequence_id", "__at.offset")
