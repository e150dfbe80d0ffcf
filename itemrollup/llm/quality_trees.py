"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are cut into at most 64 bins at quantiles of the training rows; trees are grown by
depth on gradient histograms with second-order gains; the ensemble is flattened into arrays
(feature, threshold, left child, leaf value) that all rows of a block walk together.

Defined cases: null and empty texts have the statistics of a text without words and get a
score like any other; without labelled rows of both classes the score is the smoothed share
of label 1; repeated rows are scored each on its own; extra columns pass by.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, map_blocks, ref, schema_of
from .doc_stats import FEATURES, features
from .labelled import labelled_texts, usable_labels

BINS = 64
SAMPLE_PER_CLASS = 3000
THRESHOLD = 0.3


@dataclass
class Forest:
    """All trees in one set of arrays; node i's children are left[i] and left[i] + 1, leaves have feature -1."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                down = self.left[node] + (x[rows, np.maximum(f, 0)] > self.threshold[node])
                node = np.where(f >= 0, down, node)
            z += self.value[node]
        return 1 / (1 + np.exp(-z))


def _grow(codes, edges, g, h, depth, lam, min_rows):
    """One tree as node lists, and the leaf value of every row."""
    n, k = codes.shape
    feature, threshold, left, value = [-1], [0.0], [0], [0.0]
    out = np.zeros(n)
    level = [(0, np.arange(n))]
    for d in range(depth + 1):
        nxt = []
        for node, rows in level:
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = -gs / (hs + lam)
            out[rows] = value[node]
            if d == depth or len(rows) < 2 * min_rows:
                continue
            flat = (codes[rows] + np.arange(k) * BINS).ravel()
            gl = np.bincount(flat, weights=np.repeat(g[rows], k), minlength=k * BINS).reshape(k, BINS).cumsum(1)
            hl = np.bincount(flat, weights=np.repeat(h[rows], k), minlength=k * BINS).reshape(k, BINS).cumsum(1)
            cl = np.bincount(flat, minlength=k * BINS).reshape(k, BINS).cumsum(1)
            gain = gl**2 / (hl + lam) + (gs - gl) ** 2 / (hs - hl + lam) - gs**2 / (hs + lam)
            gain[(cl < min_rows) | (len(rows) - cl < min_rows)] = 0
            f, b = divmod(int(gain.argmax()), BINS)
            if gain[f, b] <= 1e-9 or b >= len(edges[f]):
                continue
            goes = codes[rows, f] > b
            feature[node], threshold[node], left[node] = f, float(edges[f][b]), len(feature)
            for part in (rows[~goes], rows[goes]):
                nxt.append((len(feature), part))
                feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
        level = nxt
    return feature, threshold, left, value, out


def fit(x: np.ndarray, y: np.ndarray, prior: float, trees: int = 80, depth: int = 4, rate: float = 0.15, lam: float = 1.0, min_rows: int = 10) -> Forest:
    """Boost on the logistic loss; ``prior`` is the label-1 share before class sampling.

    Rows are weighted so that the two sampled classes stand for their shares.
    """
    base = float(np.log(prior / (1 - prior)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1]).astype(np.float32)) for c in x.T] if len(x) else []
    if not len(x) or y.min() == y.max():
        one = np.zeros(1)
        return Forest(base, np.zeros(0, np.int64), one.astype(int), one, one.astype(int), one, depth)
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    codes = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    z = np.full(len(y), base)
    roots, feature, threshold, left, value = [], [], [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        f, t, l, v, out = _grow(codes, edges, weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6), depth, lam, min_rows)
        shift = len(feature)
        roots.append(shift)
        feature += f
        threshold += t
        left += [c + shift for c in l]
        value += [rate * c for c in v]
        z += rate * out
    return Forest(base, np.array(roots), np.array(feature), np.array(threshold, np.float32), np.array(left), np.array(value), depth)


def _rows(batch, buf, offs):
    x = features(buf, offs)
    return {"doc_id": batch.column(0).cast(pa.string()), "label": batch.column(1),
            "x": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))}


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS, eligible=None) -> Forest:
    """Fit on at most ``per_class`` labelled rows of each class; the class shares come from all labels."""
    n = usable_labels(labels, label, eligible).agg(F.sum("label").alias("one"), F.count("label").alias("all")).collect()[0]
    prior = ((n["one"] or 0) + 1) / (n["all"] + 2)
    t = map_blocks(labelled_texts(docs, labels, label, per_class, eligible), "doc_id string, label int, x array<float>", _rows).toArrow().sort_by("doc_id")
    x = np.array([r.values.to_numpy() for r in t.column("x")]).reshape(-1, len(FEATURES))
    return fit(x, t.column("label").to_numpy().astype(float), prior)


def score(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with score (probability of label 1) and predicted (score >= threshold)."""
    plain = docs.select(*[ref(c) for c in dict.fromkeys([*keep, text])])
    at = {c: i for i, c in enumerate(plain.columns)}
    sent = docs.sparkSession.sparkContext.broadcast(forest)  # fixed size

    def predict(batch, buf, offs):
        p = sent.value.scores(features(buf, offs))
        return {c: batch.column(at[c]) for c in keep} | {"score": p, "predicted": (p >= threshold).astype(np.int32)}

    return map_blocks(plain, ", ".join([schema_of(docs, keep), "score double, predicted int"]), predict, text=text)


def quality_classifier(docs: DataFrame, labels: DataFrame, fold: int = 5, held_fold: int = 0) -> DataFrame:
    """Learn from labels outside the held-out fold and score every row."""
    out = score(docs, train(docs, labels, eligible=crc_fold("doc_id", fold) != held_fold))
    return out.select("doc_id", F.coalesce(crc_fold("doc_id", fold) == held_fold, F.lit(False)).alias("held_out"), "score", "predicted")
