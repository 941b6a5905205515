"""Quality by a byte-level convolutional network in numpy.

Learned filters run over overlapping chunks that cover the whole text; each filter's largest value in a chunk is kept, and
the mean, least and largest of these over the chunks are combined into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import label_share, per_text, ready, replace_columns, sampled_labels, utf8

#: Numbers per byte, bytes under a filter, bytes from one place of a filter to the next, filters.
DEPTH, WIDTH, STRIDE, FILTERS = 8, 8, 2, 24
#: Bytes of a chunk and from one chunk to the next: chunks overlap.
CHUNK, STEP = 576, 512
#: Chunks worked on at once.
LOT = 64
#: Documents of each class that the network is fitted on at most, and chunks drawn from each per pass.
SAMPLE, DRAWN = {0: 2500, 1: 3500}, 24


def chunks(data: bytes) -> np.ndarray:
    """All chunks of a text, one a row. Padded with zero bytes; an empty text is one chunk of padding."""
    n = max(1, -(-(len(data) - (CHUNK - STEP)) // STEP))
    whole = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    whole[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(whole, CHUNK)[::STEP]


def _patches(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(chunks, places, WIDTH x DEPTH) inputs of the filters."""
    x = table[c].reshape(len(c), -1)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(x, WIDTH * DEPTH, axis=1)[:, :: STRIDE * DEPTH])


@dataclass
class Net:
    table: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    dense: np.ndarray
    bias: float
    params: tuple = field(default=("table", "filters", "shift", "dense"), repr=False)

    @classmethod
    def new(cls, seed: int = 5) -> Net:
        r = np.random.default_rng(seed)
        b = np.arange(256)
        kinds = np.stack([(b >= 97) & (b <= 122), (b >= 65) & (b <= 90), (b >= 48) & (b <= 57), b == 32, b == 10, (b > 32) & (b < 127), b > 127, b == 0], 1)
        table = (kinds + r.normal(0, 0.3, (256, DEPTH))).astype(np.float32)
        return cls(table, r.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), np.zeros(3 * FILTERS, np.float32), 0.0)

    def pooled(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter in each chunk, and its place."""
        v = _patches(c, self.table).reshape(-1, WIDTH * DEPTH) @ self.filters
        v = v.reshape(len(c), -1, FILTERS)
        at = v.argmax(axis=1)
        return np.tanh(np.take_along_axis(v, at[:, None], 1)[:, 0] + self.shift), at

    def fast_pooled(self, c: np.ndarray) -> np.ndarray:
        v = _patches(c, self.table).reshape(-1, WIDTH * DEPTH) @ self.filters
        return np.tanh(v.reshape(len(c), -1, FILTERS).max(axis=1) + self.shift)

    def logit(self, p: np.ndarray) -> float:
        return float(np.concatenate([p.mean(0), p.min(0), p.max(0)]) @ self.dense + self.bias)

    def probability(self, text: str | None) -> float:
        c = chunks(utf8(text))
        total, least, most = np.zeros(FILTERS), np.full(FILTERS, np.inf), np.full(FILTERS, -np.inf)
        for a in range(0, len(c), LOT):
            p = self.fast_pooled(c[a : a + LOT])
            total, least, most = total + p.sum(0), np.minimum(least, p.min(0)), np.maximum(most, p.max(0))
        f = np.concatenate([total / len(c), least, most]) @ self.dense + self.bias
        return float(1 / (1 + np.exp(-np.clip(f, -60, 60))))

    def probabilities(self, texts: list[str | None]) -> list[float]:
        """Several texts at once: short ones share the matrix products."""
        out: list[float] = []
        lot: list[np.ndarray] = []

        def flush() -> None:
            if lot:
                p = self.fast_pooled(np.concatenate(lot))
                at = np.cumsum([0] + [len(c) for c in lot])[:-1]
                n = np.array([len(c) for c in lot])[:, None]
                q = np.concatenate([np.add.reduceat(p, at) / n, np.minimum.reduceat(p, at), np.maximum.reduceat(p, at)], 1)
                out.extend((1 / (1 + np.exp(-np.clip(q @ self.dense + self.bias, -60, 60)))).tolist())
                lot.clear()

        for t in texts:
            c = chunks(utf8(t))
            if sum(map(len, lot)) + len(c) > LOT:
                flush()
            if len(c) > LOT:
                out.append(self.probability(t))
            else:
                lot.append(c)
        flush()
        return out


def fit(texts: list[str | None], y: np.ndarray, passes: int = 6, lot: int = 32, seed: int = 5, prior: float | None = None) -> Net:
    """Adam on the log loss; gradients flow through the places of the largest values.

    ``prior`` is the share of label 1 to calibrate to, where classes were sampled unevenly. Without both classes the network
    gives the prior alone.
    """
    net, r = Net.new(seed), np.random.default_rng(seed)
    y = np.asarray(y, float)
    share = float(y.mean()) if len(y) else 0.5
    prior = min(max(share if prior is None or not len(y) else prior, 1e-3), 1 - 1e-3)
    net.bias = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return net
    each = np.where(y == 1, prior / share, (1 - prior) / (1 - share))  # weights that restore the prior
    cut = [chunks(utf8(t)) for t in texts]
    passes = max(passes, min(40, 6000 // len(y)))
    m = {k: 0.0 for k in net.params} | {"bias": 0.0}
    v = {k: 0.0 for k in net.params} | {"bias": 0.0}
    t, last = 0, passes * -(-len(y) // lot)
    for _ in range(passes):
        order = r.permutation(len(y))
        for a in range(0, len(y), lot):
            t += 1
            ids = order[a : a + lot]
            own = [c if len(c) <= DRAWN else c[np.sort(r.choice(len(c), DRAWN, replace=False))] for c in (cut[i] for i in ids)]
            c = np.concatenate(own)
            p, at = net.pooled(c)
            begin = np.cumsum([0] + [len(x) for x in own])
            g = {"dense": np.zeros(3 * FILTERS), "bias": 0.0}
            gp = np.zeros_like(p)
            for k, i in enumerate(ids):
                q = p[begin[k] : begin[k + 1]]
                h = np.concatenate([q.mean(0), q.min(0), q.max(0)])
                e = (1 / (1 + np.exp(-np.clip(h @ net.dense + net.bias, -30, 30))) - y[i]) * each[i] / len(ids)
                g["dense"] += e * h
                g["bias"] += e
                d = (e * net.dense).reshape(3, FILTERS)
                view = gp[begin[k] : begin[k + 1]]
                view += d[0] / len(q)
                view[q.argmin(0), np.arange(FILTERS)] += d[1]
                view[q.argmax(0), np.arange(FILTERS)] += d[2]
            gv = gp * (1 - p**2)
            under = (at * STRIDE)[:, :, None] + np.arange(WIDTH)  # bytes under the filter at its largest value
            b = np.take_along_axis(c[:, None, :], under, 2)
            x = net.table[b].reshape(len(c), FILTERS, -1)
            g["filters"] = np.einsum("cf,cfx->xf", gv, x)
            g["shift"] = gv.sum(0)
            gx = gv[:, :, None] * net.filters.T[None]
            flat = gx.reshape(-1, DEPTH)
            g["table"] = np.stack([np.bincount(b.ravel(), flat[:, j], 256) for j in range(DEPTH)], 1)
            rate = 0.01 * (1 - t / (last + 1)) + 0.0005
            for k, grad in g.items():
                grad = grad + 1e-5 * getattr(net, k)
                m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.99 * v[k] + 0.01 * grad**2
                step = rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
                now = getattr(net, k) - step
                setattr(net, k, float(now) if k == "bias" else now.astype(np.float32))
    return net


def train(docs: DataFrame, labels: DataFrame, where: Column, label: str = "quality") -> Net:
    """Fits on a bounded sample of the labelled rows that ``where`` (on the labels' doc_id) admits, calibrated to all of them."""
    spark = ready(docs.sparkSession)
    sample = spark.createDataFrame(sampled_labels(labels, label, where, SAMPLE).collect(), "doc_id long, y int")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").collect()  # at most sum(SAMPLE) rows
    rows.sort(key=lambda r: (r.doc_id, r.text or ""))
    return fit([r.text for r in rows], np.array([r.y for r in rows], float), prior=label_share(labels, label, where))


def probability_column(net: Net, text: str | Column = "text") -> Column:
    def of(texts: list[str | None]) -> pa.Array:
        return pa.array(net.probabilities(texts), pa.float64())

    return F.round(per_text(of, "double", text), 9)


def score(docs: DataFrame, net: Net, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, from all chunks of the text) and ``predicted`` (1 from the threshold on) to every row.

    A null or empty text is one chunk of padding. Copies get equal scores up to rounding in the last digits of a product of
    other shape; rows, null ids and extra columns are kept; columns named like a result give way. Only texts go to Python,
    LOT chunks at a time; no shuffle.
    """
    ready(docs.sparkSession)
    scored = replace_columns(docs, {"score": probability_column(net, text)})
    return replace_columns(scored, {"predicted": (F.col("score") >= threshold).cast("int")})
