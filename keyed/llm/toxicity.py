"""Toxicity by a linear classifier on character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import per_text, ready, replace_columns, sampled_labels

#: Lengths of the n-grams, buckets they are hashed to (a power of two), characters hashed at once.
ORDERS, BITS, BLOCK = (4, 5, 6, 7), 20, 1 << 18
#: Documents of each class that the model is fitted on at most (those with the lowest hash of their id).
SAMPLE = {0: 4000, 1: 2000}
#: Added to every count; least absolute z-value of a log-count ratio that is used.
SMOOTH, LEAST_Z = 0.5, 3.0


def _blocks(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the lower-cased text, a block of characters at a time. Shorter texts count as one n-gram."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for a in range(0, max(len(c), 1), BLOCK):
        part = c[a : a + BLOCK + max(ORDERS) - 1]
        h = np.zeros(len(part), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(n)
            if n in ORDERS:
                yield ((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


@dataclass(frozen=True)
class Model:
    """Weight of each used bucket (ratio x linear weight), ascending buckets, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        slot = np.zeros(1 << BITS, np.int32)
        slot[self.buckets] = np.arange(1, len(self.buckets) + 1)

        def score(text: str | None) -> float:
            hits = [s[s > 0] for s in (slot[b] for b in _blocks(text))]
            own = np.unique(np.concatenate(hits)) - 1 if hits else np.zeros(0, np.int32)
            return float(1 / (1 + np.exp(-np.clip(self.weights[own].sum() + self.bias, -60, 60))))

        return score


def fit(texts: list[str | None], y: np.ndarray, prior: float | None = None, steps: int = 600, decay: float = 1e-4) -> Model:
    """Log-count ratios of n-gram presence, then logistic regression on the ratios of the n-grams present.

    ``prior`` is the share of label 1 to calibrate to, where classes were sampled unevenly. Without both classes the model
    is the prior alone.
    """
    y = np.asarray(y, np.float64)
    share = float(y.mean()) if len(y) else 0.5
    prior = min(max(share if prior is None or not len(y) else prior, 1e-3), 1 - 1e-3)
    flat = float(np.log(prior / (1 - prior)))
    if not len(y) or not 0 < share < 1:
        return Model(np.zeros(0, np.int64), np.zeros(0), flat)
    count = np.zeros((2, 1 << BITS))
    seen = np.zeros(1 << BITS, bool)
    for text, label in zip(texts, y, strict=True):
        for b in _blocks(text):
            seen[b] = True
        count[int(label), seen] += 1
        seen[:] = False
    q, p = count + SMOOTH
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    ratio = np.log(p / (n1 + 2 * SMOOTH)) - np.log(q / (n0 + 2 * SMOOTH))
    z = ratio / np.sqrt(1 / p + 1 / q)
    buckets = np.flatnonzero(np.abs(z) >= LEAST_Z)
    slot = np.full(1 << BITS, -1)
    slot[buckets] = np.arange(len(buckets))
    cols, ends = [], []
    for text in texts:
        found = [s[s >= 0] for s in (slot[b] for b in _blocks(text))]
        cols.append(np.unique(np.concatenate(found)) if found else np.zeros(0, int))
        ends.append(len(cols[-1]))
    col, row = np.concatenate(cols), np.repeat(np.arange(len(y)), ends)
    r = ratio[buckets]
    scale = 1 / max(np.sqrt((r[col] ** 2).sum() / len(y)), 1e-9)
    x = r[col] * scale
    w, b = np.zeros(len(buckets)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    each = np.where(y == 1, prior / share, (1 - prior) / (1 - share)) / len(y)  # weights that restore the prior
    for t in range(1, steps + 1):  # Adam on the whole sample
        f = np.bincount(row, x * w[col], len(y)) + b
        g = (1 / (1 + np.exp(-np.clip(f, -60, 60))) - y) * each
        gw, gb = np.bincount(col, x * g[row], len(w)) + decay * w / max(len(w), 1), g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = 0.05 / (1 + t / 100)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-9)
    return Model(buckets, w * r * scale, float(b))


def train(docs: DataFrame, labels: DataFrame, where: Column, label: str = "toxic") -> Model:
    """Fits on a bounded sample of the labelled rows that ``where`` (on the labels' doc_id) admits."""
    spark = ready(docs.sparkSession)
    sample = spark.createDataFrame(sampled_labels(labels, label, where, SAMPLE).collect(), "doc_id long, y int")
    share = labels.filter(where).agg(F.avg(F.when(F.col(label).isin(0, 1), F.col(label)))).first()[0]
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").collect()  # at most sum(SAMPLE) rows
    rows.sort(key=lambda r: (r.doc_id, r.text or ""))
    return fit([r.text for r in rows], np.array([r.y for r in rows], float), share)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, from the whole text) and ``predicted`` (1 from the threshold on) to every row.

    A null or empty text has no n-grams and gets the bias alone. Copies get equal scores; extra columns and null ids are
    kept; columns named like a result give way. Only texts go to Python, one at a time, in blocks; no shuffle.
    """
    ready(docs.sparkSession)
    state: list = []

    def of(texts: list[str | None]) -> pa.Array:
        if not state:
            state.append(model.scorer())
        return pa.array([state[0](t) for t in texts], pa.float64())

    scored = replace_columns(docs, {"score": per_text(of, "double", text)})
    return replace_columns(scored, {"predicted": (F.col("score") >= threshold).cast("int")})
