"""Removal of word sequences that an earlier document has, by suffix automata over shards of reference passages.

A window is WINDOW consecutive words; a word goes if a window over it also starts in a document with a smaller id. Every
window picks an anchor: the least hash of its runs of GRAM words, so equal windows pick equal anchors. Anchors that two
documents share name the passages that may repeat. Equal passages are aggregated by a 128-bit hash of their words before they
are shuffled: all but the first document lose theirs whole, and one row of each different passage goes on.

All different passages around one anchor are a reference shard of bounded size: they meet in one task, where each is streamed
through a suffix automaton of those of earlier documents and then added to it. An anchor with more than SHARD different
passages (a common line) is not a bounded shard. Its passages are cut again where their windows pick other runs of words under
two further orders, so what stands around the common line tells them apart; the pieces are aggregated and dealt to shards as the
passages were. Only windows of pieces that are still crowded are aggregated one by one, by hash.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import cut, ready, release, replace_columns, spread_join, utf8, words_of

WINDOW, GRAM, SHARD = 50, 8, 512
#: Hashes of words kept per worker, and grams whose least values are sought at once.
KEPT_WORDS, BLOCK = 500_000, 1 << 16
_POWERS = np.cumprod(np.full(WINDOW, 0x9E3779B97F4A7C15, np.uint64))
_POWERS2 = np.cumprod(np.full(WINDOW, 0xC2B2AE3D27D4EB4F, np.uint64))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_known = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def _rolled(h: np.ndarray, n: int, powers: np.ndarray) -> np.ndarray:
    """A hash of every n consecutive words."""
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += h[j : j + m] * powers[j]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words by hash: the anchors' hashes and places, and the first and last window that picks each."""
    if len(h) < WINDOW:
        return np.zeros(0, np.int64), *(np.zeros(0, np.int64),) * 3
    g = _rolled(h, GRAM, _POWERS)
    span = WINDOW - GRAM + 1
    n = len(h) - WINDOW + 1
    at = np.empty(n, np.int64)
    for a in range(0, n, BLOCK):
        view = np.lib.stride_tricks.sliding_window_view(g[a : min(a + BLOCK, n) + span - 1], span)
        at[a : a + len(view)] = view.argmin(axis=1) + np.arange(a, a + len(view))
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.concatenate((first[1:] - 1, [n - 1]))
    return g[at[first]].view(np.int64), at[first], first, last


class Automaton:
    """Suffix automaton of several word sequences: all their runs of words, and no others."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, size = self.next, self.link, self.size
        q = nxt[last].get(w)
        if q is not None:
            return q if size[q] == size[last] + 1 else self._clone(last, q, w)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, q, w)
        return new

    def _clone(self, p: int, q: int, w: bytes) -> int:
        nxt, link, size = self.next, self.link, self.size
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def matched(self, words: list[bytes], least: int) -> tuple[list[list[int]], bool]:
        """Maximal spans [begin, end) covered by matches of at least that length; whether the whole sequence matches."""
        nxt, link, size = self.next, self.link, self.size
        v, n, spans = 0, 0, []
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                n = size[v]
            to = nxt[v].get(w)
            if to is None:
                n = 0
            else:
                v, n = to, n + 1
                if n >= least:
                    if spans and spans[-1][1] >= i + 1 - n:
                        spans[-1][0] = min(spans[-1][0], i + 1 - n)
                        spans[-1][1] = i + 1
                    else:
                        spans.append([i + 1 - n, i + 1])
        return spans, n == len(words)


def _join(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [tuple(x) for x in out]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _anchors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("a", pa.int64()), ("p", pa.int32())]))
    for batch in batches:
        values, ends = [], [0]
        for text in batch.to_pylist():
            a, p, _, _ = anchors(word_hashes(words_of(text)))
            values.append((a, p))
            ends.append(ends[-1] + len(a))
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate([x for x, _ in values] or [[]]).astype(np.int64)), pa.array(np.concatenate([x for _, x in values] or [[]]).astype(np.int32))], ["a", "p"])
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat).cast(kind)


def _totals(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found = [(len(w), _digest(w)) for w in map(words_of, batch.to_pylist())]
        yield pa.StructArray.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.string())], ["n", "sha"])


_PASSAGES = "a long, x long, y long, i long, t long, s int, n int, words binary"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages around shared anchors, n windows each: the anchor's hash (a), that of all words (x, y), the words."""
    kinds = {"a": pa.int64(), "x": pa.int64(), "y": pa.int64(), "i": pa.int64(), "t": pa.int64(), "s": pa.int32(), "n": pa.int32(), "words": pa.binary()}
    for batch in batches:
        rows = []
        for i, t, text, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, asked = words_of(text), set(shared)
            for a, p, first, last in zip(*(x.tolist() for x in anchors(word_hashes(words))), strict=True):
                if p in asked:
                    joined = b" ".join(words[first : last + WINDOW])
                    rows.append((a, *struct.unpack("<qq", xxhash.xxh3_128_digest(joined)), i, t, first, last - first + 1, joined))
        if rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kinds])


def shard_spans(rows: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """One reference shard: (document, x, y, words) of different passages -> (x, y, begin, end) of what earlier ones have."""
    rows.sort()
    automaton, out, at = Automaton(), [], 0
    while at < len(rows):
        end = at
        new = []
        while end < len(rows) and rows[end][0] == rows[at][0]:
            _, x, y, joined = rows[end]
            words = joined.split(b" ")
            spans, whole = automaton.matched(words, WINDOW)
            out += [(x, y, b, e) for b, e in spans]
            if not whole:
                new.append(words)
            end += 1
        for words in new:
            automaton.add(words)
        at = end
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of passages of one anchor, each at most SHARD long."""
    key, rows = None, []
    kinds = {"a": pa.int64(), "x": pa.int64(), "y": pa.int64(), "b": pa.int32(), "e": pa.int32()}

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds.values(), strict=True)], names=[*kinds])

    for batch in batches:
        found: list[tuple] = []
        for a, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if a != key:
                found += [(key, *x) for x in shard_spans(rows)]
                key, rows = a, []
            rows.append(tuple(row))
        if found:
            yield table(found)
    if found := [(key, *x) for x in shard_spans(rows)]:
        yield table(found)


_PIECES = "pa long, px long, py long, i long, s int, n int, a long, x long, y long, words binary"
_ORDERS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages (a, x, y, lo, words) cut into runs of windows whose least grams in each of ORDERS are the same.

    Equal windows with one anchor have the same least grams, so they stand in pieces of one new anchor a.
    """
    kinds = {"pa": pa.int64(), "px": pa.int64(), "py": pa.int64(), "i": pa.int64(), "s": pa.int32(), "n": pa.int32(), "a": pa.int64(), "x": pa.int64(), "y": pa.int64(), "words": pa.binary()}
    span = WINDOW - GRAM + 1
    for batch in batches:
        rows = []
        for *parent, lo, joined in zip(*(batch.column(c).to_pylist() for c in ("a", "x", "y", "lo", "words")), strict=True):
            words = joined.split(b" ")
            g = _rolled(word_hashes(words), GRAM, _POWERS)
            least = np.stack([np.lib.stride_tricks.sliding_window_view(g * order, span).argmin(axis=1) for order in _ORDERS], axis=1)
            least += np.arange(len(least))[:, None]
            first = np.concatenate(([0], np.flatnonzero((np.diff(least, axis=0) != 0).any(axis=1)) + 1))
            after = np.concatenate((first[1:], [len(least)]))
            for b, e in zip(first.tolist(), after.tolist(), strict=True):
                key = xxhash.xxh64_intdigest(struct.pack("<qQQ", parent[0], *g[least[b]].tolist()))
                part = b" ".join(words[b : e - 1 + WINDOW])
                rows.append((*parent, lo, b, e - b, key - (key >> 63 << 64), *struct.unpack("<qq", xxhash.xxh3_128_digest(part)), part))
        if rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kinds])


_WINDOWS = "a long, x long, y long, lo long, b int, wx long, wy long"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two 64-bit hashes (wx, wy) of every window of passages (a, x, y, lo, words); b: its place in the passage."""
    for batch in batches:
        each = [word_hashes(w.split(b" ")) for w in batch.column("words").to_pylist()]
        if not each:
            continue
        n = np.array([len(h) - WINDOW + 1 for h in each])
        row = np.repeat(np.arange(len(n)), n)
        named = [batch.column(c).take(pa.array(row)) for c in ("a", "x", "y", "lo")]
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        hashes = [pa.array(np.concatenate([_rolled(h, WINDOW, p).view(np.int64) for h in each])) for p in (_POWERS, _POWERS2)]
        yield pa.RecordBatch.from_arrays([*named, pa.array(place.astype(np.int32)), *hashes], names=["a", "x", "y", "lo", "b", "wx", "wy"])


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        n, sha, kept = [], [], []
        for text, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if not own:
                n.append(0), sha.append(None), kept.append(None)
                continue
            data = utf8(text)
            at = [m.span() for m in _WORD.finditer(data)]
            gone = _join([(x["b"], x["e"]) for x in own])
            runs = [(a, b) for a, b in zip([0, *(e for _, e in gone)], [*(b for b, _ in gone), len(at)], strict=True) if a < b]
            n.append(sum(e - b for b, e in gone))
            sha.append(_digest([data[x:y] for a, b in runs for x, y in at[a:b]]))
            kept.append(b" ".join(data[at[a][0] : at[b - 1][1]] for a, b in runs).decode("utf-8", "replace"))
        yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], ["n", "sha", "text"])


def _with_anchors(docs: DataFrame, doc_id: str, text: str, only_digest: bool) -> DataFrame:
    """Each row with its totals and those of its anchors that another document has; written, as two later steps read it."""
    slim = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).cast("string").alias("x"))
    found = slim.filter("i IS NOT NULL AND x IS NOT NULL").select("i", F.explode(F.arrow_udf(_anchors, "array<struct<a:long,p:int>>")("x")).alias("y"))
    rows = cut(found.select("i", "y.a", "y.p"), "anchors")
    # written, so that the join below reads two plain shuffles, which Spark can split at a common anchor, and those of the count can go
    shared = cut(rows.groupBy("a").agg(F.min("i").alias("lo"), F.max("i").alias("hi")).filter("lo < hi").select("a"), "shared")
    release(docs.sparkSession)
    asked = rows.join(shared, "a").groupBy(F.col("i").alias("__of")).agg(F.collect_set("p").alias("__shared"))
    source = slim.select(F.col("i").alias("__i"), F.col("x").alias("__x")) if only_digest else docs.withColumns({"__i": F.col(doc_id).cast("long"), "__x": F.col(text).cast("string")}).drop(text)
    met = source.join(asked, F.col("__i") == F.col("__of"), "left").drop("__of")
    met = met.withColumns({"__t": F.xxhash64("__x"), "__all": F.arrow_udf(_totals, "struct<n:long,sha:string>")("__x")})
    if only_digest:
        met = met.withColumn("__x", F.when(F.col("__shared").isNotNull(), F.col("__x")))
    return cut(met, "texts")


def _repeats(different: DataFrame, again: bool) -> DataFrame:
    """(a, x, y, b, e): words [b, e) of a passage that a passage of an earlier document has."""
    crowd = different.groupBy("a").agg(F.min("lo").alias("least"), F.max("lo").alias("most"), F.count("*").alias("m")).filter("least < most").select("a", "m")
    by_shard = different.join(crowd.filter(F.col("m") <= SHARD).select("a"), "a").select("a", "lo", "x", "y", "words").repartition("a").sortWithinPartitions("a", "lo")
    most = crowd.filter(F.col("m") > SHARD)
    crowded = spread_join(different.select("a", "x", "y", "lo", "words"), most, ["a"], most, different.count(), ["x", "y"])
    if again:
        pieces = cut(crowded.mapInArrow(_pieces, _PIECES), "pieces")
        single = _gone(pieces, ["pa", "px", "py"], False).select(F.col("pa").alias("a"), F.col("px").alias("x"), F.col("py").alias("y"), F.explode("spans").alias("z")).select("a", "x", "y", "z.b", "z.e")
    else:
        # written, as both the count of a window and the look-up of the count read it
        windows = cut(crowded.mapInArrow(_windows, _WINDOWS), "windows")
        least = windows.groupBy("wx", "wy").agg(F.min("lo").alias("least"), F.max("lo").alias("most"), F.count("*").alias("m")).filter("least < most").drop("most")
        single = spread_join(windows, least, ["wx", "wy"], least, windows.count(), ["a", "x", "y", "b"]).filter("lo > least").select("a", "x", "y", "b", (F.col("b") + WINDOW).alias("e"))
    return by_shard.mapInArrow(_shards, "a long, x long, y long, b int, e int").unionByName(single)


def _gone(passages: DataFrame, owner: list[str], again: bool) -> DataFrame:
    """For each owner of passages (a, x, y, words; of document i, from word s, n windows) the spans that earlier documents have.

    ``again``: whether passages of crowded anchors are cut once more.
    """
    different = cut(passages.groupBy("a", "x", "y").agg(F.min("i").alias("lo"), F.count("*").alias("m"), F.any_value("words").alias("words")), "different")
    release(passages.sparkSession)
    found = _repeats(different, again).groupBy("a", "x", "y").agg(F.collect_set(F.struct("b", "e")).alias("part"))
    counts = different.select("a", "x", "y", "m")
    total = counts.agg(F.sum("m")).first()[0] or 0
    marks = different.select("a", "x", "y", "lo", "m").join(found, ["a", "x", "y"], "left")
    # where an earlier document has the same passage it goes whole, in its first document only what others have of it
    whole = F.array(F.struct(F.lit(0).alias("b"), (F.col("n") + (WINDOW - 1)).alias("e")))
    near = F.when(F.col("i") > F.col("lo"), whole).otherwise(F.col("part"))
    here = F.transform(near, lambda z: F.struct((z["b"] + F.col("s")).alias("b"), (z["e"] + F.col("s")).alias("e")))
    gone = spread_join(passages.drop("words"), marks, ["a", "x", "y"], counts, total, ["i", "s"]).select(*owner, here.alias("spans"))
    return gone.groupBy(*owner).agg(F.flatten(F.collect_set("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", only_digest: bool = False) -> DataFrame:
    """Takes repeated passages out of ``text`` and adds ``n_words``, ``n_removed`` and ``kept_sha256`` (kept words joined by a space).

    Repeats are judged on the input: of all documents that hold a window, those with larger ids lose it. What is left of a
    text keeps its white space within each kept run; runs are joined by a space. Texts that lose nothing stay as they are.
    Null texts have no words. Rows without an id neither lose nor cause losses; rows with the same id do not count against
    each other. Extra columns are kept, columns named like a result give way to it; an empty table gives none.
    ``only_digest`` leaves out the texts and extra columns, so that only texts with candidates are written on the way.

    Shuffles: one row per anchor (about one in 22 words), the texts once to meet their anchors, different passages around
    anchors that documents share, and the spans to remove. Each step is aggregated before it is shuffled or bounded by a document; no
    group of a common anchor is brought together.
    """
    ready(docs.sparkSession)
    base = _with_anchors(docs, doc_id, text, only_digest)
    release(docs.sparkSession)
    passages = cut(base.filter("__shared IS NOT NULL").select("__i", "__t", "__x", "__shared").mapInArrow(_passages, _PASSAGES), "passages")
    spans = _gone(passages, ["i", "t"], True).select(F.col("i").alias("__of"), F.col("t").alias("__row"), F.col("spans").alias("__spans"))
    some, none = base.filter("__shared IS NOT NULL"), base.filter("__shared IS NULL")
    met = some.join(spans, (F.col("__i") == F.col("__of")) & (F.col("__t") == F.col("__row")), "left").drop("__of", "__row")
    joined = met.unionByName(none.withColumn("__spans", F.lit(None).cast(met.schema["__spans"].dataType)))
    done = joined.withColumn("__out", F.arrow_udf(_without, "struct<n:long,sha:string,text:string>")("__x", "__spans"))
    new = {"n_words": F.col("__all.n"), "n_removed": F.col("__out.n"), "kept_sha256": F.coalesce("__out.sha", "__all.sha")}
    if only_digest:
        return done.select(F.col("__i").alias(doc_id), *(v.alias(k) for k, v in new.items()))
    changed = replace_columns(done, {text: F.coalesce("__out.text", "__x"), **new})
    added = [c for c in new if c.lower() not in {x.lower() for x in docs.columns}]
    return changed.select(*(f"`{c}`" for c in docs.columns), *added)
