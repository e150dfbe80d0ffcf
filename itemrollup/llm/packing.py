"""Optimal length buckets: padding-minimal bucket boundaries and token-budget batches inside.

A text of n tokens becomes ceil(n / max_len) sequences of at most ``max_len`` tokens.  Tokens are
the pieces of an automaton (see ``token_counts``), or words where none is given.  A sequence begins
where its first token does and ends where the next one begins, so the sequences of a row are its
text's bytes without a gap; a row id tells rows of equal or no key apart.  The global histogram of sequence lengths has at most ``max_len`` entries, whatever the corpus, and
is all the driver sees.  Texts are tokenised twice, for the histogram and to write the sequences:
then a sequence knows its bucket when it is written, its task numbers it within the bucket, and
no sequence is shuffled.  Counts per (bucket, task) give where each task's numbers begin.  Dynamic programming over it chooses at most ``buckets`` upper bounds
with the least total padding; every batch holds sequences of one bucket, padded to its bound,
and at most ``budget`` padded tokens.

Defined cases: null, empty and blank texts have no token, hence one row with n_tokens 0 and no
bucket or batch; a token may end inside a character, hence sequences are bytes (null for null); ties in length share a bucket; repeated rows are packed each on its own;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut, freed, map_blocks, ref
from .token_counts import BLOCK_BYTES, Automaton, tokens_of

BROADCAST_BEGINS = 1 << 20  # rows of (bucket, task, begin) that may be broadcast; more are joined by a shuffle


def sequence_starts(buf: np.ndarray, offs: np.ndarray, max_len: int, automaton: Automaton | None) -> tuple[np.ndarray, ...]:
    """Per sequence of a block's texts: its document, piece number, tokens and first byte."""
    words = B.Words(buf, offs, B.NON_BLANK)
    per = np.ones(len(words), dtype=np.int64) if automaton is None else tokens_of(automaton, words)
    before = np.concatenate([[0], np.cumsum(per)])  # tokens before every word
    first, total = before[words.ranges[:-1]], np.diff(before[words.ranges])
    n = np.maximum(1, -(-total // max_len))
    doc = np.repeat(np.arange(len(n)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = offs[doc].copy()
    later = np.flatnonzero(piece)
    token = first[doc[later]] + piece[later] * max_len
    word = np.searchsorted(before, token, side="right") - 1
    start[later] = words.starts[word]
    inside, known = token - before[word], (-1, [])
    for i in np.flatnonzero(inside):  # the sequence begins within a word
        w = int(word[i])
        if known[0] != w:
            known = w, automaton.token_starts(buf[words.starts[w]:words.ends[w]].tobytes())
        start[later[i]] += known[1][inside[i]]
    return doc, piece, np.minimum(max_len, total[doc] - piece * max_len), start


def length_histogram(rows: DataFrame, max_len: int, sent: Broadcast) -> dict[int, int]:
    """Sequences of every number of tokens: at most ``max_len`` + 1 entries."""

    def count(batch, buf, offs):
        _, _, tokens, _ = sequence_starts(buf, offs, max_len, sent.value)
        sizes, n = np.unique(tokens, return_counts=True)
        return {"n_tokens": sizes.astype(np.int64), "n": n}

    counts = map_blocks(rows, "n_tokens bigint, n bigint", count, block_bytes=BLOCK_BYTES).groupBy("n_tokens").agg(F.sum("n").alias("n"))
    return {r["n_tokens"]: r["n"] for r in counts.collect()}


def sequences(rows: DataFrame, kind: str, max_len: int, sent: Broadcast, bounds: list[int]) -> DataFrame:
    """Stored rows: doc_id, row_id, piece, n_tokens, start_byte, end_byte, sequence, bucket (null: no
    token), task and place, the number of the row among those of its bucket and task."""
    names = ["doc_id", "row_id", "piece", "n_tokens", "start_byte", "end_byte", "sequence", "bucket", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(len(bounds) + 1, dtype=np.int64)
        for batch in batches:
            buf, offs = B.buffers(batch.column(2))
            for lo, hi in B.split_blocks(offs, BLOCK_BYTES):
                yield split(batch.slice(lo, hi - lo), buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], used)

    def split(batch: pa.RecordBatch, buf: np.ndarray, offs: np.ndarray, used: np.ndarray) -> pa.RecordBatch:
        doc, piece, tokens, start = sequence_starts(buf, offs, max_len, sent.value)
        stop = np.append(start[1:], offs[-1])
        wide = pa.large_binary() if offs[-1] >= 1 << 31 else pa.binary()
        at = np.append(start, offs[-1]).astype(np.int64 if pa.types.is_large_binary(wide) else np.int32)
        body = pa.Array.from_buffers(wide, len(doc), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(buf))])
        own = pa.array(doc)
        none = pc.is_null(batch.column(2)).take(own)
        bucket = np.where(tokens > 0, np.searchsorted(bounds, tokens), len(bounds))
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=len(used))
        place = np.empty(len(bucket), dtype=np.int64)
        place[order] = used[bucket[order]] + np.arange(len(order)) - (np.cumsum(size) - size)[bucket[order]]
        used += size
        columns = [batch.column(0).take(own), batch.column(1).take(own), piece, tokens, start - offs[doc], stop - offs[doc],
                   pc.if_else(none, pa.scalar(None, wide), body), pa.array(bucket.astype(np.int32), mask=bucket == len(bounds)), place]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    schema = (f"doc_id {kind}, row_id bigint, piece bigint, n_tokens bigint, start_byte bigint, end_byte bigint, sequence binary, "
              "bucket int, place bigint")
    out = rows.mapInArrow(freed(run), schema)
    return cut(out.withColumn("task", F.shiftrightunsigned("row_id", 33)), "sequences")


def slots(rows: DataFrame) -> DataFrame:
    """``rows`` of ``sequences`` with ``_slot``, gapless from 0 within every bucket.

    Where a task's numbers begin is a row a (bucket, task): a window over tasks, not rows.
    """
    counts = rows.groupBy("bucket", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(F.col("bucket").alias("_b"), F.col("task").alias("_t"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    begins = cut(begins, "slot-begins")
    if begins.count() <= BROADCAST_BEGINS:
        begins = F.broadcast(begins)
    joined = rows.join(begins, rows["bucket"].eqNullSafe(begins["_b"]) & (rows["task"] == begins["_t"]))
    return joined.withColumn("_slot", F.col("_first") + F.col("place")).drop("_b", "_t", "_first")


def bucket_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets with the least total padding.

    cost(i, j) = bound_j * rows(i..j) - tokens(i..j); best[k][j] = min over i of
    best[k-1][i] + cost(i, j).  Each of the k rows is one numpy minimum over all (i, j).
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if n > 0 and c > 0), dtype=np.int64)
    if not len(lengths):
        return []
    # The tokens are the same for every choice, so the padded tokens alone are minimised.
    rows = np.concatenate([[0], np.cumsum([histogram[int(n)] for n in lengths])]).astype(np.float64)
    m, k = len(lengths), min(buckets, len(lengths))
    best = lengths * rows[1:]  # one bucket over the first j+1 lengths
    split = np.zeros((k, m), dtype=np.int64)
    for level in range(1, k):
        new = np.empty(m)
        for j in range(m):
            # the last bucket starts after i (i = -1: it is the only one)
            costs = np.concatenate([[0.0], best[:j]]) + lengths[j] * (rows[j + 1] - rows[:j + 1])
            at = int(np.argmin(costs))
            new[j], split[level, j] = costs[at], at
        best = new
    out, j = [], m - 1
    for level in range(k - 1, -1, -1):
        out.append(int(lengths[j]))
        start = int(split[level, j]) if level else 0
        if start == 0:
            break
        j = start - 1
    return out[::-1]


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", automaton: Automaton | None = None,
         max_len: int = 2048, buckets: int = 8, budget: int = 16_384) -> DataFrame:
    """One row a sequence: doc_id, piece, n_tokens, bucket, bucket_len, batch, slot, padding, and
    row_id (unique per row of ``docs``), start_byte, end_byte and sequence (the text's bytes there).

    ``batch`` numbers the batches of a bucket from 0; ``slot`` is the row within the batch.
    ``budget`` must be at least ``max_len``.
    """
    if budget < max_len:
        raise ValueError("budget must hold one sequence of max_len tokens")
    # the row id holds the number of the task that reads the row
    rows = docs.select(ref(key).alias("doc_id"), F.monotonically_increasing_id().alias("row_id"), ref(text).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(automaton)  # the vocabulary's size
    bounds = bucket_bounds(length_histogram(rows, max_len, sent), buckets)
    rows = sequences(rows, rows.schema["doc_id"].dataType.simpleString(), max_len, sent, bounds)
    width = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1) if bounds else F.lit(None).cast("long")
    out = slots(rows).withColumn("bucket_len", width)
    room = F.floor(F.lit(budget) / F.col("bucket_len")).cast("long")
    return out.select(
        "doc_id", "piece", "n_tokens", "bucket", "bucket_len",
        F.floor(F.col("_slot") / room).cast("long").alias("batch"),
        F.when(F.col("bucket").isNotNull(), F.col("_slot") % room).cast("long").alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
        "row_id", "start_byte", "end_byte", "sequence",
    )
