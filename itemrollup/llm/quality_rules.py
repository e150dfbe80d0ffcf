"""Quality rules: base counts plus a calibrated logistic regression over hashed n-grams.

The features of a text are the shares of its hashed words, word pairs and byte 3-grams.  The
regression is trained on a bounded sample of labelled rows (AdaGrad), its logits are turned
into probabilities on rows left out of training (Platt scaling), and texts are scored in
Arrow batches against fixed thresholds: below 50 words or with over half the words in
repeated 3-word windows the base rules reject; a probability of good quality under
``THRESHOLD`` rejects too.  The sample holds a bounded number of rows of each class, so rows
are weighted to the classes' shares among all labels, in training and in calibration: the
threshold means the same probability at every table size.

Defined cases: null and empty texts have no words, so the base rules reject them; without any
labelled row of either class the base rules decide alone and score is null; repeated rows are
judged each on its own; extra columns pass by.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .common import map_blocks, ref, schema_of
from .doc_stats import base_counts
from .labelled import labelled_texts, share_of_ones

BITS = 12  # buckets of each of the three feature groups
GROUPS = 3
THRESHOLD = 0.3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_PER_CLASS = 2000


def hashed(buf: np.ndarray, offs: np.ndarray, words: B.Words, h: np.ndarray, doc: np.ndarray):
    """Per feature group: (bucket of every occurrence, its document)."""
    shift = np.uint64(64 - BITS)
    yield (h >> shift).astype(np.int64), doc
    pairs, at = B.ngram_hashes(h, words.ranges, 2)
    yield (pairs >> shift).astype(np.int64), doc[at] if len(at) else np.empty(0, np.int64)
    if len(buf) < 3:
        yield np.empty(0, np.int64), np.empty(0, np.int64)
        return
    w = buf.astype(np.uint32)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    ok = np.flatnonzero(owner[:-2] == owner[2:])
    g = (w[:-2] | (w[1:-1] << np.uint32(8)) | (w[2:] << np.uint32(16)))[ok]
    yield ((g * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64), owner[ok]


def sparse_rows(batch, buf: np.ndarray, offs: np.ndarray) -> dict:
    """The texts as sparse shares over GROUPS << BITS features."""
    s = base_counts(buf, offs)
    n = len(offs) - 1
    keys, values = [], []
    for g, (ids, doc) in enumerate(hashed(buf, offs, s["_words"], s["_hashes"], s["_doc"])):
        both, c = np.unique(doc << (BITS + 2) | g << BITS | ids, return_counts=True)
        size = np.maximum(np.bincount(doc, minlength=n), 1)
        keys.append(both)
        values.append(c / size[both >> (BITS + 2)])
    keys, values = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order].astype(np.float32)
    cuts = pa.array(np.searchsorted(keys >> (BITS + 2), np.arange(n + 1)), pa.int32())
    ids = (keys & ((1 << (BITS + 2)) - 1)).astype(np.int32)
    return {"doc_id": batch.column(0).cast(pa.string()), "label": batch.column(1), "ids": pa.ListArray.from_arrays(cuts, pa.array(ids)), "vals": pa.ListArray.from_arrays(cuts, pa.array(values))}


@dataclass
class Model:
    weights: np.ndarray  # one per feature, calibration slope included
    bias: float

    def probabilities(self, buf, offs, words, h, doc) -> np.ndarray:
        n = len(offs) - 1
        z = np.full(n, self.bias)
        for g, (ids, d) in enumerate(hashed(buf, offs, words, h, doc)):
            w = self.weights[g << BITS:(g + 1) << BITS]
            z += np.bincount(d, weights=w[ids], minlength=n) / np.maximum(np.bincount(d, minlength=n), 1)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def class_weights(y: np.ndarray, prior: float) -> np.ndarray:
    """Row weights under which label 1 has the share ``prior`` (1 each if only one label occurs)."""
    ones = y.mean()
    return np.where(y == 1, prior / ones, (1 - prior) / (1 - ones)) if 0 < ones < 1 else np.ones(len(y))


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the probability given a logit, by weighted Newton steps on smoothed targets."""
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    t = np.where(y == 1, hi, lo)
    scale = max(np.abs(z).std(), 1e-6)
    z = z / scale
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-6)
        off = weight * (p - t)
        grad = np.array([(off * z).sum() + 1e-3 * a, off.sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return a / scale, b


def train(rows: DataFrame, prior: float | None = None, epochs: int = 12, rate: float = 0.5, l2: float = 1e-7, batch: int = 32, seed: int = 7) -> Model | None:
    """Fit on (doc_id, label, text) rows; the driver sees their bounded sparse features only.

    ``prior`` is the label-1 share before class sampling (None: that of the rows).
    """
    t = map_blocks(rows, "doc_id string, label int, ids array<int>, vals array<float>", sparse_rows).toArrow().sort_by("doc_id")
    y = t.column("label").to_numpy().astype(float)
    if len(set(y)) < 2:
        return None
    prior = y.mean() if prior is None or not 0 < prior < 1 else prior
    weight = class_weights(y, prior)
    ids = [x.values.to_numpy() for x in t.column("ids")]
    vals = [x.values.to_numpy() for x in t.column("vals")]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = order[:len(y) // 5] if len(y) >= 50 else order
    fit = order[len(y) // 5:] if len(y) >= 50 else order
    w, seen, bias = np.zeros(GROUPS << BITS), np.full(GROUPS << BITS, 1e-12), 0.0

    def logits(at):
        i, v = np.concatenate([ids[k] for k in at]), np.concatenate([vals[k] for k in at])
        owner = np.repeat(np.arange(len(at)), [len(ids[k]) for k in at])
        return i, v, owner, np.bincount(owner, weights=w[i] * v, minlength=len(at)) + bias

    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(fit), max(1, len(fit) // batch)):
            i, v, owner, z = logits(at)
            g = weight[at] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) / len(at)
            grad = np.bincount(i, weights=v * g[owner], minlength=len(w)) + l2 * w
            seen += grad * grad
            w -= rate * grad / np.sqrt(seen)
            bias -= 0.05 * g.sum()
    a, b = platt(logits(held)[3], y[held], class_weights(y[held], prior))
    return Model(w * a, bias * a + b)


def trained(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """The model of at most ``per_class`` labelled rows of each class and the class shares of all labels."""
    return train(labelled_texts(docs, labels, "quality", per_class), share_of_ones(labels, "quality"))


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, the base counts, base_failed, score (null without a model) and kept."""
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = ", ".join([schema_of(docs, keep), *(f"{c} bigint" for c in base), "base_failed boolean, score double, kept boolean"])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    plain = docs.select(*[ref(c) for c in dict.fromkeys([*keep, text])])
    at = {c: i for i, c in enumerate(plain.columns)}

    def score(batch, buf, offs):
        s = base_counts(buf, offs)
        failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
        m = sent.value
        if m is None:
            p, good = pa.nulls(len(offs) - 1, pa.float64()), np.ones(len(offs) - 1, dtype=bool)
        else:
            p = m.probabilities(buf, offs, s["_words"], s["_hashes"], s["_doc"])
            good = p >= threshold
        out = {c: batch.column(at[c]) for c in keep} | {c: s[c] for c in base}
        return out | {"base_failed": failed, "score": p, "kept": ~failed & good}

    return map_blocks(plain, schema, score, text=text)


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows that the rules and the model keep, with all columns of ``docs`` unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    names = docs.columns

    def choose(batch, buf, offs):
        s = base_counts(buf, offs)
        good = ~((s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"]))
        if sent.value is not None:
            good &= sent.value.probabilities(buf, offs, s["_words"], s["_hashes"], s["_doc"]) >= threshold
        kept = pa.array(good)
        return {c: batch.column(i).filter(kept) for i, c in enumerate(names)}

    return map_blocks(docs, schema_of(docs), choose, text=text)


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Train on at most ``per_class`` labelled rows of each class, then judge every row."""
    return judge(docs, trained(docs, labels, per_class), keep=keep)
