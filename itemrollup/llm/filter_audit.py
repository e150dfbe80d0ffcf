"""Filter interaction audit: what every filter removes in every order, by decision diagrams.

One map pass turns each document into its failure mask.  The masks are counted per part, and a
part's counts become a decision diagram: a node tests one filter, its low edge holds the
documents that pass it and its high edge those that fail, the leaves hold counts.  Nodes are
shared (equal sub-diagrams are one node) and zero-suppressed (a filter that no document below
fails has no node).  The weight of a node is the sum of its leaves.

In a diagram whose levels stand in the order of application, the all-pass path (low edges from
the root) yields the steps: before step k it stands on the documents that passed the filters
before, the high child of filter k holds those removed there, the low child those kept.  The
next order comes from swapping two adjacent levels, which touches the nodes of the upper level
only; a chain of such swaps runs through all orders.

Weights are vectors (documents, good ones, toxic ones), so one walk gives all counts.

Defined cases: a null text is the empty text; a null source is the empty part; documents with a
null key have no label, and neither fail the copy filter nor make another fail it; documents
with equal key and equal text do not fail it through each other; a key with several label rows
is good (toxic) if any of them says so; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut, freed, map_blocks, ref

FILTERS = "ABCDE"  # short, few distinct words, many capitals, symbols, copy of an earlier document
COPY = FILTERS.index("E")
_CAPITAL = B.byte_table(lambda b: 0x41 <= b <= 0x5A)
_SYMBOL = B.byte_table(lambda b: b in b"#$%&*|")
U64 = np.uint64


class Diagram:
    """A zero-suppressed decision diagram over failure masks with vector weights.

    ``order[level]`` is the filter tested at a level.  A node is (level, low, high) under an
    id; leaves are the ids of distinct weight vectors; 0 is the empty diagram.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int):
        self.size = len(next(iter(counts.values()), (0, 0, 0)))
        self.order = list(range(filters))
        self.nodes: list[tuple] = [()]  # id -> (level, low, high), or () for a leaf
        self.weights: list[tuple[int, ...]] = [(0,) * self.size]
        self.unique: dict[tuple, int] = {}
        self.root = self._build(0, dict(counts))

    def leaf(self, weight: tuple[int, ...]) -> int:
        return self._intern(("leaf", weight), (), weight) if any(weight) else 0

    def node(self, level: int, low: int, high: int) -> int:
        if not high:
            return low
        weight = tuple(a + b for a, b in zip(self.weights[low], self.weights[high]))
        return self._intern((level, low, high), (level, low, high), weight)

    def _intern(self, key: tuple, node: tuple, weight: tuple[int, ...]) -> int:
        at = self.unique.get(key)
        if at is None:
            at = self.unique[key] = len(self.nodes)
            self.nodes.append(node)
            self.weights.append(weight)
        return at

    def _build(self, level: int, counts: dict[int, tuple[int, ...]]) -> int:
        """The diagram of masks shifted so that the lowest bit is this level's filter."""
        if not counts:
            return 0
        if level == len(self.order):
            return self.leaf(counts[0])
        low = {m >> 1: c for m, c in counts.items() if not m & 1}
        high = {m >> 1: c for m, c in counts.items() if m & 1}
        return self.node(level, self._build(level + 1, low), self._build(level + 1, high))

    def _edges(self, at: int, level: int) -> tuple[int, int]:
        """(low, high) of a diagram read at ``level``; a suppressed node has no high side."""
        node = self.nodes[at]
        return (node[1], node[2]) if node and node[0] == level else (at, 0)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and ``level + 1``; nodes below them are kept as they are."""
        done: dict[int, int] = {}

        def turned(at: int) -> int:
            node = self.nodes[at]
            if not node or node[0] > level + 1:
                return at
            if at not in done:
                if node[0] < level:
                    done[at] = self.node(node[0], turned(node[1]), turned(node[2]))
                else:
                    low, high = self._edges(at, level)
                    (ll, lh), (hl, hh) = self._edges(low, level + 1), self._edges(high, level + 1)
                    done[at] = self.node(level, self.node(level + 1, ll, hl), self.node(level + 1, lh, hh))
            return done[at]

        self.root = turned(self.root)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, kept after it, removed by it) along the all-pass path, as weights."""
        out, at = [], self.root
        for level, which in enumerate(self.order):
            at, high = self._edges(at, level)
            out.append((which, self.weights[at], self.weights[high]))
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one so that all n! orders come up (each once)."""
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        level = next(inner, None)
        if level is None:
            return
        yield level + down  # the moving filter stands at the top or at the bottom
        down = not down


def audit(counts: dict[int, tuple[int, int, int]], filters: str = FILTERS) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    n = len(filters)
    failing = [sum(c[0] for m, c in counts.items() if m >> f & 1) for f in range(n)]
    alone = [counts.get(1 << f, (0,))[0] for f in range(n)]
    diagram, found, shapley = Diagram(counts, n), {}, [0] * n
    swaps = adjacent_swaps(n)
    while True:
        steps = diagram.steps()
        found["".join(filters[f] for f, _, _ in steps)] = steps
        for f, _, removed in steps:
            shapley[f] += removed[0]
        level = next(swaps, None)
        if level is None:
            break
        if len(diagram.nodes) > 4096:  # earlier orders' nodes are of no use any more
            diagram = _reordered(counts, diagram.order)
        diagram.swap(level)
    return [
        (order, k + 1, kept[0], gone[0], failing[f] - gone[0], alone[f], gone[1], gone[2], shapley[f])
        for order in ("".join(p) for p in permutations(filters)) for k, (f, kept, gone) in enumerate(found[order])
    ]


def _reordered(counts: dict[int, tuple[int, int, int]], order: list[int]) -> Diagram:
    """A fresh diagram in the given order."""
    moved = {sum((m >> f & 1) << level for level, f in enumerate(order)): c for m, c in counts.items()}
    out = Diagram(moved, len(order))
    out.order = list(order)
    return out


def failure_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, doc_id, mask of the text's own filters (A-D) and a 128-bit digest of the text, a row a document."""
    rows = docs.select(ref(key).alias("doc_id"), F.coalesce(ref(part).cast("string"), F.lit("")).alias("part"), ref(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def digest(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        n = words.counts
        mixed = B.mix(words.hashes() + words.doc_of().astype(U64) * U64(0x9E3779B97F4A7C15))
        _, first = np.unique(mixed, return_index=True)
        distinct = np.bincount(words.doc_of()[first], minlength=len(n))
        chars = B.sums_by_doc((buf & 0xC0) != 0x80, offs)
        fails = [n < 200, 100 * distinct < 50 * n, 100 * B.sums_by_doc(_CAPITAL[buf], offs) > 2 * chars, B.sums_by_doc(_SYMBOL[buf], offs) > 0]
        mask = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
        raw = memoryview(np.ascontiguousarray(buf))
        same = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offs[:-1], offs[1:])]
        return {"doc_id": batch.column(0), "part": batch.column(1), "mask": mask.astype(np.int32), "digest": pa.array(same, pa.binary())}

    return map_blocks(rows, f"doc_id {kind}, part string, mask int, digest binary", digest)


def mask_counts(digests: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """part, mask (the copy filter included), n, good, toxic.  ``digests`` must be stored (see ``cut``).

    Both join sides are stored tables, so AQE can split a hot key.  A text's copies are counted per
    (text, part, labels) before any of them meet; only these counts, never documents, share a window.
    """
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = cut(labels.where(ref(key).isNotNull()).groupBy(ref(key).alias("_key")).agg(flag("quality"), flag("toxic")), "audit-labels")
    rows = digests.join(known, digests["doc_id"] == known["_key"], "left").select(
        "digest", "part", "mask", "doc_id", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    group = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*group, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    keyed = F.col("doc_id").isNotNull()
    # the rows of the group's smallest key; rows without a key never fail the copy filter
    by_text = by_id.groupBy(*group).agg(
        F.min(F.when(keyed, F.struct("doc_id", "n"))).alias("first"), F.sum("n").alias("n"),
        F.sum(F.when(keyed, F.lit(0)).otherwise(F.col("n"))).alias("loose"))
    lowest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    by_text = by_text.withColumn("own", F.col("loose") + F.when(F.col("first.doc_id") == lowest, F.col("first.n")).otherwise(F.lit(0)))
    split = F.explode(F.array(
        F.struct(F.col("mask"), F.col("own").alias("n")),
        F.struct((F.col("mask") + F.lit(1 << COPY)).alias("mask"), (F.col("n") - F.col("own")).alias("n")),
    )).alias("x")
    out = by_text.select("part", "good", "toxic", split).where("x.n > 0")
    return out.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step and the counts: 120 orders of 5 steps for every part."""
    counts = mask_counts(cut(failure_digests(docs, key, text, part), "audit"), labels)
    # at most 2 ** 5 masks a part
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = audit({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks})
                order, step, *numbers = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), pa.array(order), pa.array(step, pa.int32()), *(pa.array(x, pa.int64()) for x in numbers)],
                    names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(freed(run), "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))
