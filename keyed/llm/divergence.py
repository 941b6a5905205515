"""Source divergence audit by hash-consed segment trees of term counts.

Terms of a language are dealt to chunks by hash. Within a chunk every group (language and source, and the language as a
whole) is a segment tree over the chunk's term ids; leaves are counts, and equal subtrees, of whatever group and place,
share one node. Two trees are walked together from their roots; a pair of nodes met before is not walked again, so each
different pair of nodes is priced once, and what many places share (absent terms above all) costs one price.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyed.llm.common import cut, ready

#: Documents of a language that a term must occur in.
LEAST_DOCS = 3
#: Scale of shares, and smoothing added to each count.
SCALE, SMOOTH = 1_000_000_000, 1
#: Terms of a chunk at most (on average), and counts that one task holds at a time (terms x groups).
CHUNK_TERMS, CELLS = 4096, 1 << 22
#: Different (group, term) entries that a task counts before it passes them on.
COUNTED = 500_000
#: Counts from which exact arithmetic leaves 64 bits.
_WIDE = 9_000_000_000

# bytes of a term: letters, the upper-case ones made lower, and all of other characters; anything else ends it
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), summed in each task and then over all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = terms_of(text)
                n, d = held[lang, source]
                n.update(words)
                d.update(set(words))
            if sum(len(n) for n, _ in held.values()) > COUNTED:
                yield from flush(held)
                held.clear()
        yield from flush(held)

    def flush(held) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            terms = list(n)
            if terms:
                columns = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array([d[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    found = docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Forest:
    """Segment trees of equal length over one pool of shared nodes. Level 0 are the leaves."""

    def __init__(self, counts: np.ndarray):
        rows, terms = counts.shape
        length = 1 << max(0, int(terms - 1).bit_length())
        padded = np.full((rows, length), -1, np.int64)  # places without a term
        padded[:, :terms] = counts
        self.values, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.leaves, self.left, self.right = nodes, [], []
        while nodes.shape[1] > 1:
            wide = int(nodes.max()) + 1
            pairs, nodes_flat = np.unique(nodes[:, ::2] * wide + nodes[:, 1::2], return_inverse=True)
            nodes = nodes_flat.reshape(rows, -1)
            self.left.append(pairs // wide)
            self.right.append(pairs % wide)
        self.roots = nodes[:, 0]

    def walk(self, a: int, others: np.ndarray, price) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Sums over the trees of ``a`` and of each other, of what ``price`` (other's number, count in a, in the other) gives
        for a pair of leaves and for the pair turned round; and the priced leaf pairs.

        Goes down level by level with every different pair of nodes once, and back up with their sums.
        """
        who, na, nb = np.arange(len(others)), np.full(len(others), self.roots[a]), self.roots[others]
        back = []
        for left, right in zip(reversed(self.left), reversed(self.right), strict=True):
            who2, na2, nb2 = np.concatenate((who, who)), np.concatenate((left[na], right[na])), np.concatenate((left[nb], right[nb]))
            wa, wb = int(na2.max()) + 1, int(nb2.max()) + 1
            keys, at = np.unique((who2 * wa + na2) * wb + nb2, return_inverse=True)
            back.append(at)
            who, na, nb = keys // (wa * wb), keys // wb % wa, keys % wb
        there, turned = price(who, self.values[na], self.values[nb])
        priced = (who, na, nb, there)
        for at in reversed(back):
            half = len(at) // 2
            there, turned = there[at[:half]] + there[at[half:]], turned[at[:half]] + turned[at[half:]]
        return there, turned, priced


def _shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH terms)), exactly."""
    if max(int(counts.max(initial=0)), int(totals.max(initial=0))) >= _WIDE:
        counts, totals = counts.astype(object), totals.astype(object)
    return (1 + SCALE * (counts + SMOOTH) // (totals + SMOOTH * terms)).astype(np.int64)


def _prices(totals: np.ndarray, a: int, others: np.ndarray, terms: int):
    def price(who: np.ndarray, ca: np.ndarray, cb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = ca >= 0
        p = _shares(np.where(some, ca, 0), np.full(len(ca), totals[a]), terms)
        q = _shares(np.where(some, cb, 0), totals[others[who]], terms)
        square = (p - q) * (p - q)
        return np.where(some, square // q, 0), np.where(some, square // p, 0)

    return price


def _chunk(lang: str, sources: list[str], totals: np.ndarray, terms: int, names: list[str], at: np.ndarray, who: np.ndarray, n: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    """What one chunk adds to every pair of groups, and its best terms of every group."""
    s = len(sources)
    counts = np.zeros((s + 1, max(1, len(names))), np.int64) if names else np.full((s + 1, 1), -1, np.int64)
    if names:
        counts[who, at] = n
        counts[s] = counts[:s].sum(axis=0)
    totals = np.append(totals, totals.sum())
    forest = Forest(counts)
    out: list[tuple] = []
    for a in range(s):
        others = np.arange(a + 1, s + 1)  # the language itself is the last
        price = _prices(totals, a, others, terms)
        there, turned, (leaf_who, leaf_a, leaf_b, leaf_price) = forest.walk(a, others, price)
        for b, x, y in zip(others[:-1].tolist(), there.tolist(), turned.tolist(), strict=False):
            out += [(lang, sources[a], "pair", sources[b], x), (lang, sources[b], "pair", sources[a], y)]
        held = np.flatnonzero(counts[a] > 0)
        if len(held):
            mine = np.flatnonzero(leaf_who == len(others) - 1)
            wide = len(forest.values)
            keys = leaf_a[mine] * wide + leaf_b[mine]
            order = np.argsort(keys)
            found = mine[order][np.searchsorted(keys, forest.leaves[a, held] * wide + forest.leaves[s, held], sorter=order)]
            p = _shares(forest.values[leaf_a[found]], np.full(len(found), totals[a]), terms)
            q = _shares(forest.values[leaf_b[found]], np.full(len(found), totals[s]), terms)
            held, value = held[p > q], leaf_price[found][p > q]
            for i in np.lexsort((held, -value))[:top]:
                out.append((lang, sources[a], "term", names[held[i]], int(value[i])))
        if len(out) > 10_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


_FOUND = "lang string, source string, part string, item string, value long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 4 + [pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = 200) -> DataFrame:
    """How far the term shares of each group (language and source) lie from those of each other source of its language
    (part ``pair``: all of them) and from those of the language (part ``term``: the ``top`` terms that the group has more of).

    Columns: lang, source, part, item, value, rank. A share is 1 + floor(10^9 (count + 1) / (total + V)) over the V terms of
    the language that ``least_docs`` of its documents hold; a value is the sum of floor((p - q)^2 / q), the first share the
    group's. Ranks go by falling value, then by the item's bytes. Arithmetic is exact.

    Null language, source and text count as empty ones. A group without terms has all counts 0; in a language without terms
    all pairs have value 0. Repeated rows count as documents of their own. Other columns are not read; no rows give no rows.

    Memory: a task counts COUNTED different entries at a time, then holds one chunk of at most CELLS counts or 64 terms of
    each source of a language. Nothing that grows with the documents reaches the driver but one number.
    """
    ready(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    of_term = Window.partitionBy("lang", "term")
    counted = term_counts(rows).withColumn("all", F.sum("docs").over(of_term)).filter(F.col("all") >= least_docs)
    kept = cut(counted.withColumn("first", (F.row_number().over(of_term.orderBy("source")) == 1).cast("long")).select("lang", "source", "term", "n", "first"), "terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("first").alias("first"))
    of_lang = Window.partitionBy("lang")
    groups = cut(
        rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(F.sum("first").over(of_lang), F.lit(0)).alias("terms"), F.count("*").over(of_lang).alias("sources")),
        "groups",
    )
    most, widest = groups.agg(F.max("terms"), F.max("sources")).first()
    each = max(64, min(CHUNK_TERMS, CELLS // max(1, widest or 1)))
    chunks = max(1, -(-(most or 0) // each))
    heads = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit("").alias("term"), "source", "n", "terms")
    bodies = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int").alias("chunk"), "term", "source", "n", F.lit(None).cast("long").alias("terms"))
    # a term is never empty, so the groups of a chunk stand before its terms
    runs = heads.unionAll(bodies).repartition("lang", "chunk").sortWithinPartitions("lang", "chunk", "term", "source")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            lang, chunk = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start = 0
            while start < len(lang):
                end = start
                while end < len(lang) and (lang[end], chunk[end]) == (lang[start], chunk[start]):
                    end += 1
                if (lang[start], chunk[start]) != key:
                    if held:
                        yield from priced(key[0], held)
                    key, held = (lang[start], chunk[start]), []
                held.append(batch.slice(start, end - start))
                start = end
        if held:
            yield from priced(key[0], held)

    def priced(lang: str, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        terms = table["terms"].to_numpy()
        heads = int(np.count_nonzero(~np.isnan(terms)))
        sources = table["source"].slice(0, heads).to_pylist()
        number = {x: i for i, x in enumerate(sources)}
        n = table["n"].to_numpy()
        names, at = [], []
        for t in table["term"].slice(heads).to_pylist():
            if not names or names[-1] != t:
                names.append(t)
            at.append(len(names) - 1)
        who = np.array([number[x] for x in table["source"].slice(heads).to_pylist()], np.int64)
        yield from _chunk(lang, sources, n[:heads], int(terms[0]), names, np.array(at, np.int64), who, n[heads:], top)

    found = cut(runs.mapInArrow(walk, _FOUND), "divergence")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", rank)
    terms = found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
