"""Substring dedup: word spans that an earlier document already has are removed.

Text is streamed through suffix automata of reference text; the maximal spans whose matching
statistic reaches the threshold, in the text of a smaller doc_id, go.  When a corpus is its own
reference, its automata can neither be broadcast nor can every document visit every one, so
they are dealt into shards and window hashes route a passage to the shards it visits:

1. Equal texts are one unit, judged at its smallest doc_id; the other copies lose every window.
2. Winnowing: in every ``n`` consecutive words one k-gram is the fingerprint, the same one
   wherever those words stand.  Only windows under a fingerprint of two units go on; their
   text is stored as segments (the passages that may repeat, and nothing else).
3. Reference text: of every repeated window its first place (smallest doc_id), by a partial
   aggregate over window hashes.  Runs of first places are the reference passages, cut into pieces
   of at most PIECE windows, so every window is in exactly one piece.
4. Pieces are dealt into shards of about SHARD words.  A zone of ZONE words of a segment visits,
   whole, the shards of its windows' first places.  (Routing by fingerprint was tried: a common
   passage has first places in a shard of every family of copies around it, and the routes grew
   with the square of the families.  A window has one first place, so its route is one row.)
5. A shard builds one suffix automaton over its pieces, every state marked with the document it
   is from, and streams its visitors: words under matching statistics of at least ``n`` words in
   a smaller doc_id are the spans.
6. The spans meet the whole texts again, which are cut to the kept words.

No group is gathered by fingerprint or window: both are counted with partial aggregation, and
windows meet their stored first places, one row a window, so AQE can split a hot window.  The
visitors of a shard are dealt over as many tasks as their words ask for, each with the shard's
pieces (of bounded size) sent once; a hot passage only makes its shard visited more often.

A word is a run of non-blank characters.  Defined cases: null, empty and short texts (under
``n`` words) keep all their words; a null doc_id counts as larger than every other; rows with
equal doc_id never remove from each other; repeated rows get equal results; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut, freed, map_blocks

WINDOW = 50
GRAM = 10
SHARD = 32_768  # words of reference text in a shard's automaton, on average
PIECE = 4_096  # most windows of a piece, so no shard is much larger than the average
TOGETHER = 8  # segments that follow each other, mostly of one document, share a shard
ZONE = 256  # words of a segment that visit a shard together
VISITS = 1_000_000  # words that visit one copy of a shard
U64 = np.uint64


class SuffixAutomaton:
    """All substrings of the added word sequences, as a minimal automaton over words."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list = [None]

    def add(self, words, owner=None) -> None:
        """Append one sequence (matches never run from one sequence into the next).

        ``owner`` marks the states made on the way: a string that only sequences of one owner hold
        ends in a state of that owner.
        """
        last = 0
        for w in words:
            last = self._extend(last, w, owner)

    def _extend(self, last: int, w, owner) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(w)
        if q is not None:  # the word path exists already (a later sequence)
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1), self.owner.append(owner)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1), self.owner.append(self.owner[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def statistics(self, words) -> tuple[list[int], list[int]]:
        """For every position, the length of the longest match that ends there, and its state."""
        nxt, link, length = self.next, self.link, self.length
        state, match, out, states = 0, 0, [], []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                match = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                match += 1
            else:
                match = 0
            out.append(match), states.append(state)
        return out, states


def spans_over(stats: list[int], threshold: int) -> list[tuple[int, int]]:
    """Maximal word ranges [start, end) covered by matches of at least ``threshold`` words."""
    out: list[list[int]] = []
    for end, m in enumerate(stats, 1):
        if m >= threshold:
            if out and end - m <= out[-1][1]:
                out[-1] = [min(out[-1][0], end - m), end]
            else:
                out.append([end - m, end])
    return [(s, e) for s, e in out]


def winnow(words: B.Words, h: np.ndarray, n: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, first window start, document) of a block: the fingerprint's windows start
    there and go on up to the document's next entry.

    The k-gram with the smallest hash among the n - k + 1 of a window is its fingerprint, the
    leftmost on ties, so equal windows have equal fingerprints at equal places.
    """
    none = np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
    starts = B.ngram_hashes(h, words.ranges, n)[1]
    if not len(starts):
        return none
    grams, at = B.ngram_hashes(h, words.ranges, k)
    bits = U64(max(20, int(len(h)).bit_length()))
    key = np.full(len(h), np.iinfo(np.uint64).max, dtype=U64)
    key[at] = (grams >> bits << bits) | at.astype(U64)
    span, low, have = n - k + 1, key, 1
    while have * 2 <= span:  # minimum over doubled spans
        low = np.minimum(low[:len(low) - have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[:len(low) - (span - have)], low[span - have:])
    place = (low[starts] & U64((1 << int(bits)) - 1)).astype(np.int64)
    doc = words.doc_of()[starts]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]))
    full = np.zeros(len(h), dtype=U64)
    full[at] = grams
    return full[place[new]], starts[new] - words.ranges[doc[new]], doc[new]


def _before(a: Column, b: Column) -> Column:
    """a is a smaller id than b, null being the largest."""
    return F.coalesce(a.isNotNull() & (b.isNull() | (a < b)), F.lit(False))


def _identity(text: Column) -> list[Column]:
    """128 bits that name a text."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("h1"), F.xxhash64(t, F.lit(1)).alias("h2")]


def fingerprints(docs: DataFrame, n: int, k: int) -> DataFrame:
    """Stored rows (pid, doc_id, h1, h2, n_words, fps, starts) of every document."""

    def make(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        fp, start, doc = winnow(words, words.hashes(), n, k)
        cuts = pa.array(np.searchsorted(doc, np.arange(len(offs))), pa.int32())
        return {"doc_id": batch.column(0), "h1": batch.column(1), "h2": batch.column(2), "n_words": words.counts.astype(np.int32),
                "fps": pa.ListArray.from_arrays(cuts, pa.array(fp.view(np.int64))), "starts": pa.ListArray.from_arrays(cuts, pa.array(start.astype(np.int32)))}

    rows = docs.select("doc_id", *_identity(F.col("text")), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_blocks(rows, f"doc_id {kind}, h1 bigint, h2 bigint, n_words int, fps array<bigint>, starts array<int>", make)
    return cut(out.withColumn("pid", F.monotonically_increasing_id()), "fingerprints")


def segments(docs: DataFrame, units: DataFrame, prints: DataFrame, n: int) -> DataFrame:
    """Stored rows (gid, doc_id, h1, h2, start, text): passages whose windows have a
    fingerprint that another unit has too."""
    own = prints.join(units.select("pid"), "pid", "left_semi")
    places = own.select("pid", "h1", "n_words", F.col("starts"), F.posexplode("fps").alias("i", "fp")).select(
        "pid", "h1", "fp", F.col("starts")[F.col("i")].alias("lo"),
        (F.coalesce(F.get("starts", F.col("i") + 1), F.col("n_words") - (n - 1)) - 1).alias("hi"))
    shared = places.groupBy("fp").agg(F.min("pid").alias("a"), F.max("pid").alias("b")).where("a < b").select("fp")
    hit = places.select("pid", "fp", "lo", "hi").join(shared, "fp", "left_semi")
    hit = hit.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("parts"))  # one document's parts
    wanted = units.join(hit, "pid").select("h1", "h2", F.col("doc_id").alias("first_doc"), "parts")

    rows = docs.select("doc_id", *_identity(F.col("text")), "text").join(wanted, ["h1", "h2"])
    rows = rows.where(F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("doc_id", "h1", "h2", F.col("parts.lo").alias("lo"), F.col("parts.hi").alias("hi"), "text")

    def take(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        row, start, text = [], [], []
        for d in range(len(offs) - 1):
            base = int(words.ranges[d])
            merged: list[list[int]] = []
            for lo, hi in zip(batch.column(3)[d].values.to_pylist(), batch.column(4)[d].values.to_pylist()):
                if merged and lo == merged[-1][1] + 1:
                    merged[-1][1] = hi
                else:
                    merged.append([lo, hi])
            for lo, hi in merged:
                row.append(d), start.append(lo)
                text.append(buf[words.starts[base + lo]:words.ends[base + hi + n - 1]].tobytes().decode("utf-8", "replace"))
        at = pa.array(row, pa.int64())
        return {"doc_id": batch.column(0).take(at), "h1": batch.column(1).take(at), "h2": batch.column(2).take(at),
                "start": pa.array(start, pa.int32()), "text": pa.array(text, pa.string())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_blocks(rows, f"doc_id {kind}, h1 bigint, h2 bigint, start int, text string", take)
    out = out.dropDuplicates(["h1", "h2", "start"])  # repeated rows
    return cut(out.withColumn("gid", F.monotonically_increasing_id()), "segments")


def windows(segs: DataFrame, n: int) -> DataFrame:
    """(w, gid, doc_id, pos): the hash of every window of every segment."""

    def make(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        grams, at = B.ngram_hashes(words.hashes(), words.ranges, n)
        doc = words.doc_of()[at] if len(at) else np.empty(0, np.int64)
        take = pa.array(doc, pa.int64())
        return {"w": pa.array(grams.view(np.int64)), "gid": batch.column(0).take(take), "doc_id": batch.column(1).take(take),
                "pos": (at - words.ranges[doc]).astype(np.int32)}

    kind = segs.schema["doc_id"].dataType.simpleString()
    return map_blocks(segs.select("gid", "doc_id", "text"), f"w bigint, gid bigint, doc_id {kind}, pos int", make)


def runs(at, n: int) -> list[tuple[int, int]]:
    """Word ranges [start, end) of consecutive window starts (ascending, repeats allowed)."""
    out: list[list[int]] = []
    for x in at:
        if out and x <= out[-1][1] - n + 1:
            out[-1][1] = max(out[-1][1], x + n)
        else:
            out.append([x, x + n])
    return [(a, b) for a, b in out]


def first_places(segs: DataFrame, n: int, shard: int) -> DataFrame:
    """Stored rows (w, ref, pos, shard): where a window that stands twice is first, and the shard that has it."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("gid").alias("gid"), F.col("pos").alias("pos"))
    first = windows(segs, n).groupBy("w").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1")
    first = cut(first.select("w", F.col("m.gid").alias("ref"), F.col("m.pos").alias("pos")), "first-places")
    shards = max(1, -(-first.count() // shard))  # from the stored table's footers
    return first.withColumn("shard", shard_of("ref", "pos", shards, min(PIECE, shard)))


def shard_of(gid: str, pos: str, shards: int, piece: int) -> Column:
    near = F.floor(F.col(gid) / TOGETHER), F.floor(F.col(pos) / piece)
    return F.pmod(F.xxhash64(*near), F.lit(shards)).cast("long")


def pieces(segs: DataFrame, first: DataFrame, n: int) -> DataFrame:
    """(shard, doc_id, text): the reference text, every window of ``first`` in exactly one piece."""
    starts = first.groupBy("ref", "shard").agg(F.sort_array(F.collect_list("pos")).alias("at"))  # one segment's windows
    rows = segs.join(starts, F.col("gid") == F.col("ref")).select("shard", "doc_id", "at", "text")

    def take(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        row, text = [], []
        for d in range(len(offs) - 1):
            base = int(words.ranges[d])
            for lo, hi in runs(batch.column(2)[d].values.to_pylist(), n):
                row.append(d), text.append(buf[words.starts[base + lo]:words.ends[base + hi - 1]].tobytes().decode("utf-8", "replace"))
        at = pa.array(row, pa.int64())
        return {"shard": batch.column(0).take(at), "doc_id": batch.column(1).take(at), "text": pa.array(text, pa.string())}

    return map_blocks(rows, f"shard bigint, doc_id {segs.schema['doc_id'].dataType.simpleString()}, text string", take)


def visits(segs: DataFrame, first: DataFrame, n: int) -> DataFrame:
    """Stored rows (shard, doc_id, h1, h2, start, n_words, text): what streams through a shard."""
    own = windows(segs, n).select("w", "gid", F.floor(F.col("pos") / ZONE).cast("int").alias("zone"))
    routes = own.join(first.select("w", "ref", "shard"), "w").where("gid <> ref")  # its own text removes nothing of a segment
    zones = routes.groupBy("gid", "shard").agg(F.sort_array(F.collect_set("zone")).alias("zones"))  # one segment's zones
    rows = segs.join(zones, "gid").select("shard", "doc_id", "h1", "h2", "start", "zones", "text")

    def take(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        row, start, size, text = [], [], [], []
        for d in range(len(offs) - 1):
            base, first_word = int(words.ranges[d]), batch.column(4)[d].as_py()
            for z, end in runs(batch.column(5)[d].values.to_pylist(), 1):
                lo, hi = z * ZONE, min(int(words.counts[d]), end * ZONE + n - 1)
                row.append(d), start.append(first_word + lo), size.append(hi - lo)
                text.append(buf[words.starts[base + lo]:words.ends[base + hi - 1]].tobytes().decode("utf-8", "replace"))
        at = pa.array(row, pa.int64())
        return {c: batch.column(i).take(at) for i, c in enumerate(("shard", "doc_id", "h1", "h2"))} | {
            "start": pa.array(start, pa.int32()), "n_words": pa.array(size, pa.int64()), "text": pa.array(text, pa.string())}

    kind = segs.schema["doc_id"].dataType.simpleString()
    return cut(map_blocks(rows, f"shard bigint, doc_id {kind}, h1 bigint, h2 bigint, start int, n_words bigint, text string", take), "visits")


def repeated_spans(segs: DataFrame, n: int, shard: int = SHARD, most: int = VISITS, make: type = SuffixAutomaton) -> DataFrame:
    """(h1, h2, spans): per unit the word ranges that an earlier document has."""
    first = first_places(segs, n, shard)
    refs, seen = pieces(segs, first, n), visits(segs, first, n)
    # copies of a shard, as many as its visitors' words ask for (rows for shards, not for texts)
    copies = cut(seen.groupBy("shard").agg(F.ceil(F.sum("n_words") / most).cast("int").alias("copies")), "copies")
    none = F.lit(None)
    build = refs.join(copies, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("visitor"),
                                              "doc_id", none.cast("long").alias("h1"), none.cast("long").alias("h2"), none.cast("int").alias("start"), "text")
    stream = seen.join(copies, "shard").select("shard", F.pmod(F.xxhash64("h1", "h2", "start"), "copies").cast("int").alias("copy"),
                                               F.lit(1).alias("visitor"), "doc_id", "h1", "h2", "start", "text")
    dealt = build.unionByName(stream).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "visitor")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, automaton, ids = None, make(), {}
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            shards, copy, visitor, doc, h1, h2, start, texts = (batch.column(i).to_pylist() for i in range(8))
            for r in range(batch.num_rows):
                if (shards[r], copy[r]) != at:
                    at, automaton, ids = (shards[r], copy[r]), make(), {}
                me = (doc[r] is None, doc[r])
                if not visitor[r]:
                    automaton.add([ids.setdefault(w, len(ids)) for w in split(texts[r])], me)
                    continue
                lengths, states = automaton.statistics([ids.get(w, -1) for w in split(texts[r])])
                earlier = [m if m >= n and before(automaton.owner[s], me) else 0 for m, s in zip(lengths, states)]
                for s, e in spans_over(earlier, n):
                    for column, value in zip(out, (h1[r], h2[r], start[r] + s, start[r] + e)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                                              pa.array(out[3], pa.int32())], names=["h1", "h2", "s", "e"])

    found = dealt.mapInArrow(freed(match), "h1 bigint, h2 bigint, s int, e int")
    return found.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))


_BLANK = re.compile(r"[\x20\x09-\x0D]+")


def split(text: str) -> list[str]:
    """The words of a passage (it starts and ends with a word)."""
    return _BLANK.split(text)


def before(a: tuple, b: tuple) -> bool:
    """(is null, id) a is a smaller id than b, null being the largest."""
    return a[0] < b[0] or (a[0] == b[0] and not a[0] and a[1] < b[1])


def dedup_substrings(docs: DataFrame, n: int = WINDOW, k: int = GRAM, key: str = "doc_id", text: str = "text", with_text: bool = False,
                     shard: int = SHARD, most: int = VISITS) -> DataFrame:
    """Every row: doc_id, n_words, n_removed, kept_sha256 (and kept_text).  ``shard`` and ``most`` are the words of
    a shard's automaton and of the visitors of one copy of it; the result does not depend on them."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    prints = fingerprints(docs, n, k)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("pid").alias("pid"))
    units = prints.groupBy("h1", "h2").agg(F.min(order).alias("m")).select("h1", "h2", F.col("m.id").alias("doc_id"), F.col("m.pid").alias("pid"))
    units = cut(units, "units")
    found = repeated_spans(segments(docs, units, prints, n), n, shard, most)
    known = units.select("h1", "h2", F.col("doc_id").alias("first_doc")).join(found, ["h1", "h2"], "left")
    rows = docs.select("doc_id", *_identity(F.col("text")), "text").join(known, ["h1", "h2"], "left").select(
        "doc_id", _before(F.col("first_doc"), F.col("doc_id")).alias("copy"), F.col("spans.s").alias("s"), F.col("spans.e").alias("e"), "text")

    def keep(batch, buf, offs):
        words = B.Words(buf, offs, B.NON_BLANK)
        copies, raw = batch.column(1).to_pylist(), buf.tobytes()
        removed, digest, kept = [], [], []
        for d in range(len(offs) - 1):
            lo, hi = int(words.ranges[d]), int(words.ranges[d + 1])
            drop = np.zeros(hi - lo, dtype=bool)
            if copies[d]:
                drop[:] = hi - lo >= n
            elif batch.column(2)[d].is_valid:
                for s, e in zip(batch.column(2)[d].values.to_pylist(), batch.column(3)[d].values.to_pylist()):
                    drop[s:e] = True
            if drop.any():
                left = np.flatnonzero(~drop) + lo
                body = b" ".join([raw[s:e] for s, e in zip(words.starts[left].tolist(), words.ends[left].tolist())])
            else:
                body = b" ".join(raw[offs[d]:offs[d + 1]].split())
            removed.append(int(drop.sum())), digest.append(hashlib.sha256(body).hexdigest())
            if with_text:
                kept.append(body.decode("utf-8", "replace"))
        out = {"doc_id": batch.column(0), "n_words": words.counts.astype(np.int64), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        return out | ({"kept_text": pa.array(kept, pa.string())} if with_text else {})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_blocks(rows, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else ""), keep)
