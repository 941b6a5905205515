"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are cut into shards of bounded size. A posting is a component of a vector; its quantised impact is its magnitude
without the low bits. A shard's postings are cut by impact into segments of about equal size, the heaviest first. A block of
queries takes the segments by descending impact: each adds its exact part to one accumulator per query and vector. What the
segments not yet seen can still add is bounded by Cauchy and Schwarz from the unseen parts of the query and of the vector. A
query stops when few vectors can still reach the k-th best proven score, or when no segment is left; all that can are scored
exactly. Vectors are dense, so a segment is held as the rows of a matrix and a block of queries meets it in one product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyed.llm.common import cut, ready, repeatable

#: Vectors in a shard and their components at most (on average), low bits that quantising drops, segments of a shard, queries
#: of a block, part of a shard that is rescored without another segment.
SHARD_ROWS, SHARD_CELLS, SHIFT, SEGMENTS, BLOCK, FEW = 8192, 1 << 19, 4, 4, 128, 1 / 16
_LONG = (1 << 63) - 1


class Shard:
    def __init__(self, ids: np.ndarray, v: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[order], np.ascontiguousarray(v[order])
        self.most = int(np.abs(self.v.astype(float)).max(initial=0))
        self.impact = np.abs(self.v) >> SHIFT
        edges = np.quantile(self.impact, np.arange(1, SEGMENTS)[::-1] / SEGMENTS, method="nearest") if v.size else []
        #: least quantised impact of each segment, falling; the last takes all
        self.least = [*sorted({int(e) for e in edges if e > 0}, reverse=True), 0]
        #: postings seen and vectors rescored, of all there were
        self.read = self.rescored = self.asked = 0

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best for one query."""
        return self.search_block(np.array([own]), q.reshape(1, -1), k)[0]

    def search_block(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and exact scores of the k best for each query, ties to smaller ids; rows with its id are left out."""
        n, dims = self.v.shape
        most = int(np.abs(queries.astype(float)).max(initial=0))
        self.asked += len(own)
        first, end = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, side="right")
        if (self.most + 1) * (most + 1) * (dims + 1) >= 1 << 62 or max(self.most, most) >= 1 << 25 or self.most * most * dims >= 1 << 52:
            return [self._exactly(o, q, k) for o, q in zip(own, queries, strict=True)]  # sums leave the whole numbers of a double
        q = queries.astype(float)
        square, size = q * q, (q * q).sum(axis=1)[:, None]
        acc, unseen = np.zeros((len(own), n)), np.repeat(size, n, axis=1)
        alive, out = np.arange(len(own)), [None] * len(own)
        upto = np.inf
        rest = (self.v.astype(float) ** 2).sum(axis=1)
        for least in self.least:
            some = (self.impact >= least) & (self.impact < upto)
            segment = np.where(some, self.v, 0).astype(float)
            rest = rest - (segment * segment).sum(axis=1)
            upto = least
            acc[alive] += q[alive] @ segment.T
            self.read += int(some.sum()) * len(alive)
            if least:
                unseen[alive] -= square[alive] @ some.T.astype(float)
                slack = np.sqrt(np.maximum(unseen[alive], 0) * np.maximum(rest, 0)) * (1 + 1e-9) + 1
            else:
                slack = np.zeros((len(alive), n))
            sofar = acc[alive]
            for i, (a, b) in enumerate(zip(first[alive], end[alive], strict=True)):
                sofar[i, a:b] = -np.inf
            upper = sofar + slack
            if n > 4 * k:  # the k-th best exact score of the likeliest vectors; below it none can be of the k best
                likely = np.argpartition(sofar, n - 4 * k, axis=1)[:, n - 4 * k :]
                known = np.einsum("ijd,id->ij", self.v[likely].astype(float), q[alive])
                known[np.take_along_axis(sofar, likely, 1) == -np.inf] = -np.inf
                floor = np.partition(known, 3 * k, axis=1)[:, 3 * k]
            else:
                floor = np.full(len(alive), -np.inf)
            possible = (upper >= floor[:, None]) & (upper > -np.inf)
            few = (possible.sum(axis=1) <= max(4 * k, n * FEW)) | (least == 0)
            for i in np.flatnonzero(few):
                rows = np.flatnonzero(possible[i])
                self.rescored += len(rows)
                out[alive[i]] = self._best(rows, self.v[rows] @ queries[alive[i]], k)
            alive = alive[~few]
            if not len(alive):
                break
        return out

    def _exactly(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Every row, in whole numbers of any size; scores beyond a long are held at its ends."""
        rows = np.flatnonzero(self.ids != own)
        exact = [min(max(sum(int(a) * int(b) for a, b in zip(self.v[i], q, strict=True)), -_LONG - 1), _LONG) for i in rows]
        return self._best(rows, np.array(exact, np.int64), k)

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        # the order of ~score is that of -score, also at the ends of a long
        best = np.lexsort((self.ids[rows], ~scores))[:k]
        return self.ids[rows][best], scores[best]


def whole_numbers(vector: str | Column, scale: int = 1024) -> Column:
    """floor(scale x) of each component as a double; null for vectors that are null or hold a null or non-finite component."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(v, lambda x: F.floor(x.cast("double") * scale)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, vec_id: str = "vec_id", vector: str = "embedding", query_id: str | None = None) -> DataFrame:
    """The k rows of ``vectors`` with the highest integer inner product for each row of ``queries``, its own id left out.

    Returns query_id, rank (from 1), vec_id and score, ties to smaller ids. Components become floor(1024 x). Rows with a null
    id, a null vector or a null or non-finite component take no part; only vectors of equal dimension are compared; scores
    beyond a long are held at its ends. A repeated id counts once per row as a candidate; rows with the query's id never do.
    Fewer candidates than k give fewer rows, none give none; extra columns are not kept.

    Each shard is one sorted run within a partition: its vectors come first and are indexed, then the queries stream past in
    blocks. Rows are dealt to shards by their place in the input, so copies of an id or of a vector do not meet in one. Queries
    are copied once per shard; only k rows per shard and query are shuffled afterwards.
    """
    ready(vectors.sparkSession)
    of = lambda df, i: df.select(F.col(i).cast("long").alias("id"), whole_numbers(vector).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    rows, asked = of(vectors if repeatable(vectors) else cut(vectors, "vectors"), vec_id), of(queries, query_id or vec_id)
    cells = F.count("*") * F.size("v") / SHARD_CELLS
    sized = rows.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.greatest(F.count("*") / shard_rows, cells)).cast("int").alias("shards"))
    sizes = {r.dim: r.shards for r in sized.collect()}  # one row per dimension
    if not sizes:
        return asked.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    shards = F.element_at(F.create_map(*(F.lit(x) for kv in sizes.items() for x in kv)), F.size("v"))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), shards).cast("int")).withColumn("kind", F.lit(0))
    copied = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.coalesce(shards, F.lit(0)) - 1))).filter(shards.isNotNull()).withColumn("kind", F.lit(1))
    both = dealt.unionByName(copied).withColumn("dim", F.size("v"))
    n = sum(sizes.values())
    runs = both.repartition(n, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "id").select("dim", "shard", "kind", "id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard, held, block, waiting = None, None, [], [], 0

        def found() -> Iterator[pa.RecordBatch]:
            own, q = np.concatenate([i for i, _ in block]), np.concatenate([x for _, x in block])
            best = shard.search_block(own, q, k)
            names = np.repeat(own, [len(i) for i, _ in best])
            columns = [names, np.concatenate([i for i, _ in best]), np.concatenate([x for _, x in best])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

        for batch in batches:
            dim, no, kind, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            flat, at = batch.column(4).flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(dim)))
            cuts = np.flatnonzero((np.diff(dim) != 0) | (np.diff(no) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if b == a:
                    continue
                v = flat[at[a] : at[b]].reshape(b - a, int(dim[a]))
                if (dim[a], no[a]) != key:
                    if block:
                        yield from found()
                    key, shard, held, block, waiting = (dim[a], no[a]), None, [], [], 0
                if kind[a] == 0:
                    held.append((ids[a:b], v))
                elif held or shard:
                    if shard is None:
                        shard, held = Shard(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])), []
                    block.append((ids[a:b], v))
                    waiting += b - a
                    if waiting >= BLOCK:
                        yield from found()
                        block, waiting = [], 0
        if block:
            yield from found()

    found = runs.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
