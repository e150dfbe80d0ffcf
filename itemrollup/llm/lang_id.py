"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the bag of its subwords: the byte 3-grams and 4-grams of its lower-cased words with
a boundary mark on either side, hashed into a fixed table.  Its vector is the average of the
subword embeddings, and a linear softmax over it gives the languages' probabilities.  Both
layers are trained by stochastic gradient descent in numpy on a bounded sample of each label,
so a rare label is learned from a table of any size; the bias then takes the log of the labels'
shares among all rows over those in the sample.  For scoring,
the two layers collapse into one table of class scores per subword, so a text costs a few
array operations a byte and all of it counts.

Calibration: on sample rows left out of training, one temperature is fitted to the logits and
the rejection threshold is the lowest score whose accepted rows, weighted to the labels' shares
among all rows, are right as often as asked.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows without a
label are never learned from; if no label can be learned from at all, every text is ``und``;
repeated rows are scored each on its own; extra columns pass by.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from .common import crc_fold, map_blocks, one_per_key, segment_ids

UNKNOWN = "und"
BITS = 14
_MARK = 0x20  # word boundary

# Bytes of a subword: letters of any script (lower-cased ASCII and every non-ASCII byte).
_LETTER = B.byte_table(lambda b: 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)
_NORMAL = np.where(_LETTER, B.LOWER, _MARK).astype(np.uint8)


def subword_ids(buf: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, its document), over all bytes of the block.

    The texts are laid out with a mark before each and two after the last, so subwords at a
    text's edge see a boundary and none mixes two texts.
    """
    lens = np.diff(offs)
    doc = segment_ids(lens)
    x = np.full(len(buf) + len(lens) + 2, _MARK, dtype=np.uint8)
    x[np.arange(len(buf)) + doc + 1] = _NORMAL[buf]
    owner = np.zeros(len(x), dtype=np.int32)
    owner[np.arange(len(buf)) + doc + 1] = doc
    owner[offs[:-1] + np.arange(len(lens))] = np.arange(len(lens))
    w = x.astype(np.uint32)
    in_word = x != _MARK
    ids, docs = [], []
    g = w[:-2] | (w[1:-1] << np.uint32(8)) | (w[2:] << np.uint32(16))
    # the middle byte belongs to a word: the gram is "abc", " ab", "ab " or " a "
    ok = np.flatnonzero(in_word[1:-1])
    ids.append((g[ok] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits))
    docs.append(owner[ok + 1])
    if len(x) > 3:
        g4 = g[:-1] | (w[3:] << np.uint32(24))
        ok = np.flatnonzero(in_word[1:-2] & in_word[2:-1])
        ids.append((g4[ok] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits))
        docs.append(owner[ok + 1])
    return np.concatenate(ids).astype(np.int64), np.concatenate(docs)


@dataclass
class Model:
    """labels; class scores of every subword (temperature included); bias; rejection threshold."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    threshold: float

    def scores(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        ids, docs = subword_ids(buf, offs)
        size = np.maximum(np.bincount(docs, minlength=n), 1)
        z = np.empty((n, len(self.labels)))
        for c in range(len(self.labels)):
            z[:, c] = np.bincount(docs, weights=self.table[c][ids], minlength=n) / size + self.bias[c]
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)


def training_rows(docs: DataFrame, eligible, n: int, text: str = "text", lang: str = "lang", key: str = "doc_id") -> list:
    """At most ``n`` rows of each label as sparse subword counts: (label, ids, counts).

    The sample is chosen on keys and labels alone (a top-n a label, of which every task sends at
    most n on), then only its rows' whole texts are read, one row of each key and label, and
    reduced to counts over the fixed table, in the tasks.  The driver gets n rows a label.
    """
    rows = docs.where(eligible & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(key, F.col(lang).alias("label"), F.col(text).alias("text"))
    least = Window.partitionBy("label").orderBy(F.xxhash64(F.col(key), F.lit(17)), F.col(key))
    keys = rows.select(key, "label").distinct().withColumn("_nth", F.row_number().over(least)).where(F.col("_nth") <= n).drop("_nth")
    rows = one_per_key(rows, keys).select("label", "text")

    def counts(batch, buf, offs):
        ids, owner = subword_ids(buf, offs)
        both, c = np.unique(owner.astype(np.int64) << BITS | ids, return_counts=True)
        cut = np.searchsorted(both >> BITS, np.arange(len(offs)))
        return {"label": batch.column(0),
                "ids": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array((both & ((1 << BITS) - 1)).astype(np.int32))),
                "n": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(c.astype(np.int32)))}

    found = map_blocks(rows, "label string, ids array<int>, n array<int>", counts).toArrow()
    out = []
    for label, ids, n_of in zip(found.column(0).to_pylist(), found.column(1), found.column(2)):
        ids, c = ids.values.to_numpy(), n_of.values.to_numpy()
        if len(ids):
            out.append((label, ids.astype(np.int64), c / c.sum()))
    out.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))  # the same order however tasks were cut
    return out


def label_counts(docs: DataFrame, eligible, lang: str = "lang", key: str = "doc_id") -> dict[str, int]:
    """Rows of every label that can be learned from: one entry a label."""
    found = docs.where(eligible & F.col(lang).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(lang).alias("label")).count().collect()
    return {r["label"]: r["count"] for r in found}


def train(rows: list, counts: dict[str, int] | None = None, dim: int = 12, epochs: int = 8, steps: int = 600, rate: float = 2.0, batch: int = 32, precision: float = 0.99, seed: int = 5) -> Model | None:
    """SGD on the softmax loss (``epochs`` passes, and at least ``steps`` batches); then temperature and rejection threshold on left-out rows.

    ``counts`` are the rows of every label before sampling (None: those of the sample).
    """
    labels = sorted({r[0] for r in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5]
    order = order[len(rows) // 5:] if len(rows) >= 25 else order
    of = {x: i for i, x in enumerate(labels)}
    y = np.array([of[r[0]] for r in rows])
    had = np.bincount(y, minlength=len(labels))
    full = had if counts is None else np.array([max(counts.get(x, 0), 1) for x in labels])
    lift = full / full.sum() * had.sum() / had  # of every label: its share of all rows over that of the sample
    emb = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim))
    out = np.zeros((dim, len(labels)))
    bias = np.zeros(len(labels))

    def vectors(at):
        ids = np.concatenate([rows[i][1] for i in at])
        wts = np.concatenate([rows[i][2] for i in at])
        cuts = np.concatenate([[0], np.cumsum([len(rows[i][1]) for i in at])])
        return ids, wts, cuts, np.add.reduceat(emb[ids] * wts[:, None], cuts[:-1], axis=0)

    def soft(z):
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    epochs = max(epochs, -(-steps * batch // max(1, len(order))))
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        seen = rng.permutation(order)
        for lo in range(0, len(seen), batch):
            at = seen[lo:lo + batch]
            ids, wts, cuts, v = vectors(at)
            g = soft(v @ out + bias)
            g[np.arange(len(at)), y[at]] -= 1
            g /= len(at)
            back = g @ out.T
            out -= lr * (v.T @ g)
            bias -= lr * 0.1 * g.sum(axis=0)
            # the averaged gradient is spread over many subwords, hence the larger step
            step = 20 * lr * wts[:, None] * np.repeat(back, np.diff(cuts), axis=0)
            np.subtract.at(emb, ids, step)

    temperature, threshold = 1.0, 0.0
    if len(rows) >= 25:
        z = vectors(held)[3] @ out + bias
        fits = [(-np.log(np.maximum(soft(z * t)[np.arange(len(held)), y[held]], 1e-12)).mean(), t) for t in np.geomspace(0.1, 10, 41)]
        temperature = min(fits)[1]
        p = soft(z * temperature + np.log(lift))
        top, right, weight = p.max(axis=1), p.argmax(axis=1) == y[held], lift[y[held]]
        by = np.argsort(-top, kind="stable")
        good = np.cumsum((right * weight)[by]) / np.cumsum(weight[by]) >= precision
        threshold = float(top[by][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(labels, np.ascontiguousarray((emb @ out).T * temperature), bias * temperature + np.log(lift), threshold)


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred, score and accepted (score at or above the threshold)."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep) + ", lang_pred string, score double, accepted boolean"
    rows = docs.select(*keep, F.col(text).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2**BITS x labels

    def predict(batch, buf, offs):
        m, n = sent.value, len(offs) - 1
        letters = batch.column(len(keep) + 1).to_numpy(zero_copy_only=False)
        if m is None:
            best, p = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        else:
            q = m.scores(buf, offs)
            best, p = np.array(m.labels, dtype=object)[q.argmax(axis=1)], q.max(axis=1)
            best, p = np.where(letters, best, UNKNOWN), np.where(letters, p, 0.0)
        limit = 2.0 if m is None else m.threshold
        out = {c: batch.column(i) for i, c in enumerate(keep)}
        return out | {"lang_pred": pa.array(best.tolist(), pa.string()), "score": p, "accepted": letters & (p >= limit)}

    return map_blocks(rows, schema, predict, text="_text")


def language_id(docs: DataFrame, sample: int = 1000, fold: int = 4, held_fold: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold (at most ``sample`` of each label) and predict every row."""
    eligible = crc_fold("doc_id", fold) != held_fold
    model = train(training_rows(docs, eligible, sample), label_counts(docs, eligible))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(crc_fold("doc_id", fold) == held_fold, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
