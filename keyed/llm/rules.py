"""Quality rules: document statistics, and gradient-boosted trees over them with monotonic constraints."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import label_share, per_text, ready, replace_columns, sampled_labels, utf8

#: Documents of each class that the trees are fitted on at most.
SAMPLE = {0: 10_000, 1: 10_000}
TREES, DEPTH, BINS, RATE, LEAST_ROWS, RIDGE = 80, 3, 64, 0.15, 5, 1.0
_SYMBOL = re.compile(r"[#*$%&|<>]")

#: Counts of a text, all long.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks")
#: Inputs of the trees, and the way quality may change with each: -1 only falls, 1 only rises, 0 either.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "words_per_line": 0,
    "distinct_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "marks_per_word": 0,
}


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows whose words occur as a window twice or more in the text."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.int64)
    pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    _, at, n = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    again = n[at] > 1
    covered = np.zeros(len(w), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of a whole text. Null is empty."""
    text = text or ""
    data = utf8(text)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.split()]
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    return (
        len(words),
        chars,
        len(_SYMBOL.findall(text)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(set(words)),
        sum(map(data.count, _UPPER)),
        sum(map(data.count, _DIGITS)),
        sum(map(data.count, _MARKS)),
    )


_UPPER, _DIGITS, _MARKS = ([bytes([b]) for b in s] for s in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,!?;:"))


def features(c: np.ndarray) -> np.ndarray:
    """Rows of COUNTS -> rows of FEATURES."""
    c = np.asarray(c, float).reshape(-1, len(COUNTS))
    words, chars, symbols, dup, repeat, lines, distinct, upper, digits, marks = c.T
    w, ch, li = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack([np.log1p(words), chars / w, symbols / w, dup / li, repeat / w, words / li, distinct / w, upper / ch, digits / ch, marks / w], 1)


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays: a node's feature (-1 at a leaf), threshold, left child (right is the next) and value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            f = self.feature[at]
            right = x[rows, np.maximum(f, 0)] > self.threshold[at]
            at = np.where(f < 0, at, self.left[at] + right)
        return 1 / (1 + np.exp(-np.clip(self.base + self.value[at].sum(1), -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int] | None = None, prior: float | None = None) -> Trees:
    """Second-order boosting of the log loss on binned features.

    A split on a constrained feature must order its two values, and every node below keeps to its side of their middle; so
    the sum of trees is monotonic in that feature. ``prior`` is the share of label 1 to calibrate to, where classes were
    sampled unevenly. Without both classes the result is the prior alone.
    """
    signs = list(FEATURES.values()) if signs is None else signs
    x, y = np.asarray(x, float), np.asarray(y, float)
    share = float(y.mean()) if len(y) else 0.5
    prior = min(max(share if prior is None or not len(y) else prior, 1e-3), 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    score = np.full(len(y), base)
    if len(y) and y.min() < y.max():
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        each = np.where(y == 1, prior / share, (1 - prior) / (1 - share))  # weights that restore the prior
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = (p - y) * each, np.maximum(p * (1 - p), 1e-6) * each

            def grow(rows: np.ndarray, depth: int, low: float, high: float, at: int, g=g, h=h) -> None:
                own = float(np.clip(-g[rows].sum() / (h[rows].sum() + RIDGE), low, high))
                best = None
                if depth < DEPTH and len(rows) >= 2 * LEAST_ROWS:
                    for j, e in enumerate(edges):
                        b = binned[rows, j]
                        gs, hs, ns = (np.bincount(b, w, len(e) + 1).cumsum() for w in (g[rows], h[rows], None))
                        gl, hl, nl = gs[:-1], hs[:-1], ns[:-1]
                        gr, hr, nr = gs[-1] - gl, hs[-1] - hl, ns[-1] - nl
                        vl, vr = (np.clip(-a / (c + RIDGE), low, high) for a, c in ((gl, hl), (gr, hr)))
                        ok = (nl >= LEAST_ROWS) & (nr >= LEAST_ROWS) & (signs[j] * (vr - vl) >= 0)
                        gain = np.where(ok, -(gl * vl + (hl + RIDGE) * vl**2 / 2) - (gr * vr + (hr + RIDGE) * vr**2 / 2), -np.inf)
                        if len(gain) and (best is None or gain.max() > best[0]):
                            k = int(gain.argmax())
                            best = (float(gain[k]), j, k, float(vl[k]), float(vr[k]))
                flat = -(g[rows].sum() * own + (h[rows].sum() + RIDGE) * own**2 / 2)
                if best is None or best[0] <= flat + 1e-6:
                    nodes[at][:] = [-1, 0.0, 0, RATE * own]
                    score[rows] += RATE * own
                    return
                _, j, k, vl, vr = best
                left = len(nodes)
                nodes[at][:] = [j, float(edges[j][k]), left, 0.0]
                nodes.extend([[0.0] * 4, [0.0] * 4])
                mid = (vl + vr) / 2
                below = binned[rows, j] <= k
                a, b = ((low, mid), (mid, high)) if signs[j] > 0 else ((mid, high), (low, mid)) if signs[j] < 0 else ((low, high),) * 2
                grow(rows[below], depth + 1, *a, left)
                grow(rows[~below], depth + 1, *b, left + 1)

            roots.append(len(nodes))
            nodes.append([0.0] * 4)
            grow(np.arange(len(y)), 0, -np.inf, np.inf, roots[-1])
    flat = np.array(nodes or [[-1, 0.0, 0, 0.0]])
    return Trees(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3], np.array(roots or [0]), base)


def statistics(text: str | Column) -> Column:
    """A struct of COUNTS for each whole text."""

    def of(texts: list[str | None]) -> pa.Array:
        columns = zip(*map(counts, texts), strict=True) if texts else [[]] * len(COUNTS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COUNTS))

    return per_text(of, "struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">", text)


def train(docs: DataFrame, labels: DataFrame, where: Column | None = None, label: str = "quality") -> Trees:
    """Fits on the statistics of a bounded sample of labelled rows, calibrated to all of them."""
    spark = ready(docs.sparkSession)
    where = F.lit(True) if where is None else where
    sample = spark.createDataFrame(sampled_labels(labels, label, where, SAMPLE).collect(), "doc_id long, y int")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", statistics("text").alias("s")).collect()
    rows.sort(key=lambda r: (r.doc_id, tuple(r.s)))
    return fit(features(np.array([tuple(r.s) for r in rows], float)), np.array([r.y for r in rows], float), prior=label_share(labels, label, where))


def judge(docs: DataFrame, trees: Trees, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Adds the counts, ``base_failed`` (under 50 words, or over half of them in repeated windows), ``score`` and ``kept``.

    ``kept`` is false where the base rules fail, else whether the trees' probability reaches the threshold. A null or empty
    text has zero counts and fails. Copies, null ids and extra columns are kept; columns named like a result give way. One
    pass over the texts, no shuffle.
    """
    ready(docs.sparkSession)

    @F.arrow_udf("double")
    def probability(*columns: pa.Array) -> pa.Array:
        return pa.array(trees.probability(features(np.stack([c.to_numpy(zero_copy_only=False) for c in columns], 1))))

    s = "__counts"
    counted = replace_columns(docs, {s: statistics(text)})
    plain = replace_columns(counted, {c: F.col(f"{s}.{c}") for c in COUNTS}).drop(s)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = replace_columns(plain, {"score": probability(*COUNTS), "base_failed": failed})
    return replace_columns(scored, {"kept": ~F.col("base_failed") & (F.col("score") >= threshold)})
