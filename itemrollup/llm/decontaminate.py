"""Benchmark decontamination over a stored positional inverted index.

``build_index`` turns documents into index shards, one stored row each: the shard's documents
with the range of their word positions, its sorted term hashes, and per term the ascending
list of positions (the postings).  Shards are made where the documents are read, so no word
is shuffled and a word that every document holds is spread like the documents.

``search`` looks phrases up in every shard: the terms of a phrase are taken from the rarest
(shortest list in the shard) on, and its list, shifted by the term's offset, is intersected
with the shifted lists of the others.  With a slop, the other terms may stand that many words
away from their place: proximity matches.

Benchmark items reach the tasks as broadcast blocks of at most ``ITEM_BLOCK_BYTES`` of text;
a larger benchmark is searched block by block over the same stored index and the hits are
merged per document, so nothing that grows is broadcast whole.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters, known by
64-bit hashes of their bytes.  Defined cases: null, empty and word-free texts have no words;
items without a word are not searched for; items without an id add to the hit words and make
a document contaminated, but are not in its items; equal item rows count once; repeated documents
are searched each on its own; extra columns pass by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut, free_name, freed, ref

WINDOW = 10
SLOP = 2
ITEM_BLOCK_BYTES = 4 << 20
SHARD_BYTES = 1 << 19  # a shard is one row of the index, held whole by the task that writes it and by the one that searches it
CANDIDATES_AT_ONCE = 1 << 20  # phrase starts held at once while searching a shard

def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[B.Words, np.ndarray]:
    words = B.Words(B.LOWER[buf], offs, B.ALNUM)
    return words, words.hashes()


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """The stored index of rows (key, text): one row a shard.

    Columns: key (array of the shard's keys), rid (array, unique over the index), first_word
    and n_words (per document), terms (sorted hashes), lists (where each term's positions begin,
    and the end of the last) and positions (uint32, ascending per term).  With a ``vocabulary``
    (sorted term hashes, bounded) only its terms get postings.
    """
    sent = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = (f"key array<{docs.schema['key'].dataType.simpleString()}>, rid array<bigint>, first_word array<int>, n_words array<int>, "
              "terms array<bigint>, lists array<int>, positions binary")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x))
        for batch in batches:
            buf, offs = B.buffers(batch.column(2))
            for lo, hi in B.split_blocks(offs, SHARD_BYTES):
                words, h = _words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                at = np.arange(len(h))
                if sent is not None:
                    known = sent.value
                    at = np.flatnonzero(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h) if len(known) else at[:0]
                order = at[np.argsort(h[at], kind="stable")]
                terms, first = np.unique(h[order], return_index=True)
                yield pa.RecordBatch.from_arrays([
                    one(batch.column(0).slice(lo, hi - lo)), one(batch.column(1).slice(lo, hi - lo)),
                    one(words.ranges[:-1].astype(np.int32)), one(words.counts.astype(np.int32)), one(terms.view(np.int64)),
                    one(np.append(first, len(order)).astype(np.int32)), pa.array([order.astype(np.uint32).tobytes()], pa.binary())],
                    names=["key", "rid", "first_word", "n_words", "terms", "lists", "positions"])

    rows = docs.select("key", F.monotonically_increasing_id().alias("rid"), "text")
    return cut(rows.mapInArrow(freed(index), schema), "positional-index")


class Phrases:
    """The phrases of a block of items: distinct windows of term numbers, grouped by length.

    ``groups`` has per length (matrix of term numbers, item offsets, item numbers): window w
    belongs to the items numbered items[offsets[w]:offsets[w + 1]]; ``ids`` ends with the number
    of all items without an id.
    """

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        raw = [t.encode() for _, t in items]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        words, h = _words(np.frombuffer(b"".join(raw), np.uint8), offs)
        self.ids = [*sorted({i for i, _ in items if i is not None}), None]
        of = {x: k for k, x in enumerate(self.ids)}
        number = np.array([of[i] for i, _ in items], dtype=np.int64)
        self.vocabulary, term = np.unique(h, return_inverse=True)
        self.groups = []
        doc, counts = words.doc_of(), words.counts
        for size in sorted({min(int(c), window) for c in counts if c}):
            if size == window:
                grams, at = B.ngram_hashes(h, words.ranges, size)
            else:  # whole items shorter than a window
                at = words.ranges[:-1][counts == size]
                grams = np.array([B.ngram_hashes(h[s:s + size], np.array([0, size]), size)[0][0] for s in at], dtype=np.uint64)
            _, first, inverse = np.unique(grams, return_index=True, return_inverse=True)
            pair = np.unique(inverse.astype(np.int64) * len(self.ids) + number[doc[at]])
            matrix = term[at[first][:, None] + np.arange(size)].astype(np.int32)
            cuts = np.searchsorted(pair, np.arange(len(first) + 1) * len(self.ids))
            self.groups.append((matrix, cuts, (pair % len(self.ids)).astype(np.int32)))


def _intersect(phrases: Phrases, matrix: np.ndarray, terms: np.ndarray, lists: np.ndarray, positions: np.ndarray, slop: int):
    """(window, start, exact) of all matches in one shard.

    ``lists`` delimit the terms' positions; list * span + position is ascending over the whole
    shard, so being in a shifted list is one binary search.
    """
    span = np.int64(int(positions.max()) + 1 + 2 * (slop + matrix.shape[1]) if len(positions) else 1)
    size = np.diff(lists)
    keyed = np.repeat(np.arange(len(terms), dtype=np.int64), size) * span + positions
    # vocabulary id -> list number of this shard, -1 where the shard has no such term
    place = np.searchsorted(phrases.vocabulary, terms)
    inside = np.minimum(place, max(len(phrases.vocabulary) - 1, 0))
    ours = np.flatnonzero(phrases.vocabulary[inside] == terms) if len(phrases.vocabulary) else np.empty(0, int)
    number = np.full(len(phrases.vocabulary), -1, dtype=np.int64)
    number[place[ours]] = ours
    m = number[matrix]
    live = np.flatnonzero((m >= 0).all(axis=1))
    if not len(live):
        return
    m = m[live]
    order = np.argsort(size[m], axis=1, kind="stable")  # rarest first
    rows = np.arange(len(m))
    rarest = m[rows, order[:, 0]]
    cost = np.cumsum(size[rarest])
    for part in np.split(rows, np.searchsorted(cost, np.arange(CANDIDATES_AT_ONCE, cost[-1], CANDIDATES_AT_ONCE))):
        if not len(part):
            continue
        n = size[rarest[part]]
        window = np.repeat(part, n)
        inner = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        start = positions[lists[rarest[window]] + inner].astype(np.int64) - order[window, 0]
        exact = start >= 0
        window, start, exact = window[exact], start[exact], exact[exact]
        for k in range(1, m.shape[1]):
            off = order[window, k]
            want = m[window, off] * span + start + off
            at = np.searchsorted(keyed, want)
            hit = (at < len(keyed)) & (keyed[np.minimum(at, len(keyed) - 1)] == want)
            near = hit
            if slop and not hit.all():
                low = np.maximum(want - slop, m[window, off] * span)
                at = np.searchsorted(keyed, low)
                near = hit | ((at < len(keyed)) & (keyed[np.minimum(at, len(keyed) - 1)] <= want + slop)
                              & (keyed[np.minimum(at, len(keyed) - 1)] >= low))
            window, start, exact = window[near], start[near], (exact & hit)[near]
            if not len(window):
                break
        if len(window):
            yield live[window], start, exact


_RANGES = "rid bigint, starts array<int>, ends array<int>, items array<string>, near_items array<string>"
_RANGES_ARROW = pa.schema([("rid", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                           ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])


def search(index: DataFrame, phrases: Phrases, slop: int = SLOP) -> DataFrame:
    """Per document with a match (rid): word ranges of the exact matches, counted from the
    document's first word, the items matched exactly, and those matched exactly or nearby."""
    sent = index.sparkSession.sparkContext.broadcast(phrases)  # bounded by ITEM_BLOCK_BYTES

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for batch in batches:
            for r in range(batch.num_rows):
                rids, first, n_words, terms, lists = (batch.column(i)[r].values.to_numpy() for i in range(5))
                positions = np.frombuffer(batch.column(5)[r].as_py(), np.uint32)
                stop = first + n_words
                got: dict[int, tuple[set, set, set]] = {}
                for matrix, cuts, items in p.groups:
                    size = matrix.shape[1]
                    for window, start, exact in _intersect(p, matrix, terms.view(np.uint64), lists, positions, slop):
                        doc = np.searchsorted(first, start, side="right") - 1
                        ok = start + size <= stop[doc]  # the window lies in one document
                        for w, s, e, d in zip(window[ok].tolist(), start[ok].tolist(), exact[ok].tolist(), doc[ok].tolist()):
                            ranges, sure, near = got.setdefault(d, (set(), set(), set()))
                            own = items[cuts[w]:cuts[w + 1]].tolist()
                            near.update(own)
                            if e:
                                ranges.add((s - int(first[d]), s - int(first[d]) + size))
                                sure.update(own)
                named = lambda found: [p.ids[i] for i in found if p.ids[i] is not None]
                if got:
                    yield pa.RecordBatch.from_pydict({
                        "rid": [int(rids[d]) for d in got],
                        "starts": [[s for s, _ in x[0]] for x in got.values()], "ends": [[e for _, e in x[0]] for x in got.values()],
                        "items": [named(x[1]) for x in got.values()], "near_items": [named(x[2]) for x in got.values()],
                    }, schema=_RANGES_ARROW)

    return index.select("rid", "first_word", "n_words", "terms", "lists", "positions").mapInArrow(freed(find), _RANGES)


def covered(starts: list[int], ends: list[int]) -> int:
    """Words inside the union of the ranges."""
    total, last = 0, 0
    for s, e in sorted(zip(starts, ends)):
        total += max(0, e - max(s, last))
        last = max(last, e)
    return total


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rid, starts, ends, items, near = (batch.column(i).to_pylist() for i in range(5))
        names = [sorted(set(x)) for x in items]
        yield pa.RecordBatch.from_arrays([
            pa.array(rid, pa.int64()), pa.array([covered(s, e) for s, e in zip(starts, ends)], pa.int64()),
            pa.array([len(x) for x in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
            pa.array([len(set(x)) for x in near], pa.int64())], names=["rid", "n_hit", "n_items", "items_sha256", "n_near_items"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, key: str | Column = "doc_id",
                  block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """Every document: doc_id (the key), n_words, n_hit, n_items, items_sha256, contaminated, n_near_items."""
    rows = docs.select((F.col(key) if isinstance(key, str) else key).alias("key"), F.col("text"))
    items = benchmark.where(F.col("text").isNotNull())
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).collect()[0]["b"] or 0
    n = max(1, -(-size // (block_bytes // 2)))  # aims at half the bound, as hashed blocks vary
    index = None
    hits = None
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        phrases = Phrases([(r["item_id"], r["text"]) for r in own.collect()], window)
        if index is None:
            index = build_index(rows)
        found = search(index, phrases, slop)
        found = found if n == 1 else cut(found, "phrase-hits")
        hits = found if hits is None else hits.unionByName(found)
    if n > 1:
        flat = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items", "near_items")]  # an entry a block
        hits = hits.groupBy("rid").agg(*flat)
    hits = hits.mapInArrow(freed(_finish), "rid bigint, n_hit bigint, n_items bigint, items_sha256 string, n_near_items bigint")
    every = index.select(F.explode(F.arrays_zip("key", "rid", "n_words")).alias("d")).select("d.*")
    zero = F.lit(0).cast("long")
    return every.join(hits, "rid", "left").select(
        F.col("key").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), F.coalesce("n_near_items", zero).alias("n_near_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without an exact benchmark window, with all columns unchanged."""
    # rows with equal key and text share their fate; two hashes, as one would name a clean row too in 10^11
    row = F.struct(F.xxhash64(ref(key), ref(text)).alias("a"), F.xxhash64(ref(key), ref(text), F.lit(1)).alias("b"))
    found = decontaminate(docs.select(row.alias("doc_id"), ref(text).alias("text")), benchmark)
    named = [free_name(docs.columns, f"__{c}") for c in ("bad", "worse")]
    bad = found.where("contaminated").select(*(F.col(f"doc_id.{f}").alias(n) for f, n in zip("ab", named))).distinct()
    rows = docs.withColumns({n: row[f] for f, n in zip("ab", named)})
    return rows.join(bad, named, "left_anti").select(*[ref(c) for c in docs.columns])
