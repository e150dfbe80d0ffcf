"""Near-duplicates by DartMinHash signatures and a banded join.

A text is a weighted set: its five-word shingles, weighted by how often they occur.  Darts are
thrown at the plane of an element's weight axis and a rank axis, from hashes alone, one
Poisson draw a unit square; a text receives the darts that lie under its weights.  Per
signature coordinate it keeps the dart of the smallest rank, so two texts agree in a
coordinate with the probability of their weighted Jaccard similarity, and the work is the
number of shingles plus k log k, not their product.

Equal texts are one unit.  Units that share a band of coordinates meet in a bucket, and no
bucket emits all its pairs:

* every unit of a bucket is compared with the bucket's lead, the unit that meets the most others
  over all buckets, and links merge classes, so
  a family of copies of any size collapses with one comparison a member and bucket;
* a bucket that still holds several classes, and is within ``LOCAL_UNITS`` and ``LOCAL_BYTES``,
  is compared inside one task over an inverted index of its elements; members of its largest
  class are not compared with each other, and only links that join classes leave it;
* a larger one is dealt into chunks, and any two chunks that can hold a link meet in a task of
  their own, within about the same limits; two chunks of its largest class need not meet.

Every link is decided by the exact similarity of the whole shingle sets, and every two units
that share a band are compared or already in one class.  The cost of a large bucket is its
units times those outside its largest class, spread over tasks; only a pair that shares no
band at all is lost.

Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters; a text of one to
four words is one shingle.  Defined cases: null and empty texts are each a class of their
own; texts without a word are near only to equal texts; repeated rows share a class; the class
id is the smallest doc_id of the class (null ids last); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut, cuts, drop_cuts, free_name, freed, map_blocks, ref
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6  # at similarity 0.8 a pair shares no band with probability 6e-5
K = BANDS * ROWS
U64 = np.uint64
CELLS_AT_ONCE = 1 << 20
LOCAL_UNITS, LOCAL_BYTES = 4096, 32 << 20  # a bucket that one task compares (larger ones are dealt over several)
_POISSON = np.cumsum([0.36787944117144233, 0.36787944117144233, 0.18393972058572117, 0.06131324019524039, 0.015328310048810098,
                      0.0030656620097620196, 0.00051094366829367, 7.299195261338e-05, 9.12399407667e-06, 1.01377711963e-06, 1.0137771196e-07])


def elements(buf: np.ndarray, offs: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle occurrence, its text): the i-th occurrence of a shingle in a text
    is an element of its own, so the weighted similarity is the plain one of these elements."""
    words = B.Words(B.LOWER[buf], offs, B.ALNUM)
    h, doc = words.hashes(), words.doc_of()
    grams, at = B.ngram_hashes(h, words.ranges, n)
    owner = doc[at] if len(at) else np.empty(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        few = [B.ngram_hashes(h[words.ranges[d]:words.ranges[d + 1]], np.array([0, words.counts[d]]), int(words.counts[d]), seed=int(words.counts[d]))[0][0] for d in short]
        grams, owner = np.concatenate([grams, np.array(few, dtype=U64)]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    if not len(grams):
        return grams, owner
    new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    nth = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
    return B.mix(grams + nth.astype(U64) * U64(0x9E3779B97F4A7C15)), owner


def signatures(e: np.ndarray, cuts: np.ndarray, k: int = K) -> np.ndarray:
    """DartMinHash: k coordinates for the weighted sets e[cuts[d]:cuts[d + 1]] (none empty)."""
    n = np.diff(cuts)
    sig = np.zeros((len(n), k), dtype=U64)
    todo, darts = np.arange(len(n)), k * (np.log(k) + 3)
    while len(todo):  # a set with an empty coordinate is thrown twice as many darts
        theta = darts / n[todo]
        cost = np.cumsum(n[todo] * np.ceil(theta))
        parts = np.split(np.arange(len(todo)), np.searchsorted(cost, np.arange(CELLS_AT_ONCE, cost[-1], CELLS_AT_ONCE)))
        empty = []
        for part in parts:
            if not len(part):
                continue
            own, top = todo[part], theta[part]
            best = np.full(len(part) * k, np.inf)
            won = np.zeros(len(part) * k, dtype=U64)
            rows = np.ceil(top).astype(np.int64)
            size = n[own]
            item = np.repeat(cuts[own], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            place = np.repeat(np.arange(len(part)), size)
            per = rows[place]  # unit squares of an element: one a rank row
            cell = np.repeat(np.arange(len(item)), per)
            b = np.arange(len(cell)) - np.repeat(np.cumsum(per) - per, per)
            g = B.mix(e[item][cell] + (b + 1).astype(U64) * U64(0xD6E8FEB86659FD93))
            count = np.searchsorted(_POISSON, (g >> U64(11)).astype(np.float64) / (1 << 53), side="right")
            which = np.repeat(np.arange(len(cell)), count)
            j = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            dart = B.mix(g[which] + (j + 1).astype(U64) * U64(0xA0761D6478BD642F))
            rank = b[which] + (dart >> U64(11)).astype(np.float64) / (1 << 53)
            of = place[cell[which]]
            ok = rank < top[of]
            dart, rank, of = dart[ok], rank[ok], of[ok]
            slot = of * k + ((dart & U64(0x7FF)).astype(np.int64) * k >> 11)
            np.minimum.at(best, slot, rank)
            least = rank == best[slot]
            won[slot[least]] = dart[least]
            sig[own] = won.reshape(-1, k)
            empty.append(own[np.isinf(best.reshape(-1, k)).any(axis=1)])
        todo, darts = np.concatenate(empty), darts * 2
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash per band of a signature."""
    n, k = sig.shape
    parts = sig.reshape(n, bands, k // bands)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(0x9E3779B97F4A7C15), (n, bands)).copy()
    for r in range(k // bands):
        out = B.mix(out ^ parts[:, :, r]) + U64(r)
    return out


def _identity():
    return [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")]


def units_of(docs: DataFrame) -> DataFrame:
    """Stored distinct texts: uid, h1, h2, doc_id (the smallest that has it), keys (band hashes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batch, buf, offs):
        e, owner = elements(buf, offs)
        cuts = np.searchsorted(owner, np.arange(len(offs)))
        full = np.flatnonzero(np.diff(cuts))
        keys = [None] * (len(offs) - 1)
        if len(full):
            found = band_keys(signatures(e, np.append(cuts[full], len(e)))).view(np.int64)
            for d, x in zip(full.tolist(), found):
                keys[d] = x
        return {"doc_id": batch.column(0), "h1": batch.column(1), "h2": batch.column(2), "keys": pa.array(keys, pa.list_(pa.int64()))}

    rows = docs.where(F.octet_length("text") > 0).select("doc_id", *_identity(), "text")
    signed = cut(map_blocks(rows, f"doc_id {kind}, h1 bigint, h2 bigint, keys array<bigint>", sign).withColumn("row", F.monotonically_increasing_id()), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    first = signed.groupBy("h1", "h2").agg(F.min(order).alias("m")).select(F.col("m.row").alias("row"))
    return cut(signed.join(first, "row", "left_semi").withColumnRenamed("row", "uid"), "units")


def element_sets(docs: DataFrame, units: DataFrame) -> DataFrame:
    """Stored (uid, elements): the sorted 64-bit elements of the given units' whole texts."""

    def make(batch, buf, offs):
        e, owner = elements(buf, offs)
        cuts = np.searchsorted(owner, np.arange(len(offs)))
        return {"uid": batch.column(0), "elements": pa.array([np.sort(e[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())}

    rows = docs.select("doc_id", *_identity(), "text").join(units.select("uid", "h1", "h2", F.col("doc_id").alias("own")), ["h1", "h2"])
    rows = rows.where(F.col("doc_id").eqNullSafe(F.col("own"))).select("uid", "text")
    return cut(map_blocks(rows, "uid bigint, elements binary", make).dropDuplicates(["uid"]), "elements")


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity reaches the threshold."""
    both = pairs.join(sets.select(F.col("uid").alias("b"), F.col("elements").alias("eb")), "b").join(
        sets.select(F.col("uid").alias("a"), F.col("elements").alias("ea")), "a").select("a", "b", "ea", "eb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(i)[r].as_buffer(), U64) for i in (2, 3))
                if len(x) > len(y):
                    x, y = y, x
                if len(x) < threshold * len(y):
                    continue
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if common >= threshold * (len(x) + len(y) - common):
                    keep.append(r)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(freed(verify), "a bigint, b bigint")


def bucket_links(uid: list[int], c: list[int], sets: list[bytes], side: list[bool], threshold: float) -> Iterator[tuple[int, int]]:
    """Links that join the classes of a bucket's units, by exact similarity (at most a link a unit).

    If ``side`` has both values, units are compared with those of the other side only.
    """
    if len(set(c)) < 2:
        return
    size = np.array([len(x) // 8 for x in sets])
    all_e = np.frombuffer(b"".join(sets), U64)
    owner = np.repeat(np.arange(len(uid)), size)
    of, far = np.array(c), np.array(side)
    if far.any() and not far.all():
        left, right = np.flatnonzero(~far), far
    else:
        left, right = np.flatnonzero(of != max(dict.fromkeys(c), key=c.count)), np.ones(len(uid), dtype=bool)
    _, inverse = np.unique(all_e, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    order = order[right[owner[order]]]
    posting = owner[order]
    counts = np.bincount(inverse[order], minlength=int(inverse.max()) + 1)
    ends = np.cumsum(counts)
    own = np.concatenate([[0], np.cumsum(size)])
    for i in left:
        terms = inverse[own[i]:own[i + 1]]
        n = counts[terms]
        at = np.repeat(ends[terms] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        common = np.bincount(posting[at], minlength=len(uid))
        hit = right & (common >= threshold * (size + size[i] - common)) & (of != of[i])
        for j in np.flatnonzero(hit):
            if of[j] != of[i]:  # not joined by an earlier link
                yield min(uid[i], uid[j]), max(uid[i], uid[j])
                of[of == of[j]] = of[i]


def local_links(members: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of rows (bucket, uid, c, elements, side); buckets hold at most about LOCAL_UNITS
    rows and LOCAL_BYTES of elements, so a task holds one such bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, ([], [], [], [])
        for batch in batches:
            out: list[tuple[int, int]] = []
            bucket, uid, c, side = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for r in range(batch.num_rows):
                if bucket[r] != at:
                    out += bucket_links(*rows, threshold)
                    at, rows = bucket[r], ([], [], [], [])
                rows[0].append(uid[r]), rows[1].append(c[r]), rows[2].append(batch.column(3)[r].as_py()), rows[3].append(side[r])
            yield _pairs(out)
        yield _pairs(list(bucket_links(*rows, threshold)))

    dealt = members.select("bucket", "uid", "c", "elements", "side").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(freed(run), "a bigint, b bigint").distinct()


def chunk_cells(large: DataFrame) -> DataFrame:
    """Rows (bucket, uid, c, bytes) of large buckets dealt into cells (bucket, uid, c, side) of about
    LOCAL_UNITS rows and LOCAL_BYTES at most, so that any two units of a bucket meet in a cell
    unless both are of the bucket's largest class."""
    main = large.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "c")).alias("m"))
    told = large.join(main.select("bucket", F.col("m.c").alias("main")), "bucket").withColumn("rest", F.col("c") != F.col("main"))
    half = F.greatest(F.ceil(F.count(F.lit(1)) * 2 / F.lit(LOCAL_UNITS)), F.ceil(F.sum("bytes") * 2 / F.lit(LOCAL_BYTES))).cast("long")
    parts = told.groupBy("bucket", "rest").agg(half.alias("k")).groupBy("bucket").agg(
        F.max(F.when(F.col("rest"), F.col("k"))).alias("k_rest"), F.max(F.when(~F.col("rest"), F.col("k"))).alias("k_main"))
    dealt = told.join(parts, "bucket").withColumn("h", F.xxhash64("uid", F.lit(3)))
    # the chunks of other classes come first and meet every chunk, those of the largest class only them
    p = F.when(F.col("rest"), F.pmod("h", "k_rest")).otherwise(F.col("k_rest") + F.pmod("h", "k_main"))
    last = F.when(F.col("rest"), F.col("k_rest") + F.col("k_main")).otherwise(F.col("k_rest")) - 1
    met = dealt.select("bucket", "uid", "c", p.alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("q"))
    return met.select(F.xxhash64("bucket", F.least("p", "q"), F.greatest("p", "q")).alias("bucket"), "uid", "c", (F.col("p") > F.col("q")).alias("side"))


def _pairs(of: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in of], pa.int64()) for k in (0, 1)], names=["a", "b"])


def link_units(docs: DataFrame, units: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(labels (node, root) of the units in any link, links (a, b)) over all buckets."""
    members = shared(units.select("uid", F.explode("keys").alias("bucket")))
    sets = element_sets(docs, units.join(members.select("uid").distinct(), "uid", "left_semi"))
    # the lead is the unit that meets the most others over all its buckets: the original of a
    # family, which its copies are nearer to than to each other
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    meets = members.join(sizes, "bucket").groupBy("uid").agg(F.sum("n").alias("met"))
    weighed = cut(members.join(meets, "uid"), "weighed")
    lead = weighed.groupBy("bucket").agg(F.max(F.struct("met", "uid")).alias("m")).select("bucket", F.col("m.uid").alias("lead"))
    pairs = weighed.join(lead, "bucket").where("uid <> lead").select(F.least("uid", "lead").alias("a"), F.greatest("uid", "lead").alias("b")).distinct()
    links = cut(similar(pairs, sets, threshold), "linked")

    limits = ((F.col("n") <= LOCAL_UNITS) & (F.col("bytes") <= LOCAL_BYTES)).alias("fits")
    known = classed(members, components(links), sets, limits)
    here = known.where("fits").join(sets, "uid").withColumn("side", F.lit(False))
    links = links.unionByName(cut(local_links(here, threshold), "linked"))
    labels = components(links)
    large = known.where("not fits")
    if large.isEmpty():
        return labels, links.distinct()
    large = classed(large.select("bucket", "uid"), labels, sets, limits)  # the small buckets joined classes too
    cells = chunk_cells(large).join(sets, "uid")
    links = links.unionByName(cut(local_links(cells, threshold), "linked"))
    return components(links), links.distinct()


def classed(members: DataFrame, labels: DataFrame, sets: DataFrame, limits: Column) -> DataFrame:
    """Stored (bucket, uid, c, bytes, fits) of the buckets that hold several classes c."""
    known = members.join(labels, members["uid"] == labels["node"], "left").select("bucket", "uid", F.coalesce("root", "uid").alias("c"))
    known = cut(known.join(sets.select("uid", F.octet_length("elements").cast("long").alias("bytes")), "uid"), "classed")
    open_ = known.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    return cut(known.join(open_.where("lo < hi").select("bucket", limits), "bucket"), "open")


def shared(members: DataFrame) -> DataFrame:
    """Stored (bucket, uid) of the buckets with more than one unit."""
    more = members.groupBy("bucket").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo < hi").select("bucket")
    return cut(members.join(more, "bucket", "left_semi").select("bucket", "uid"), "buckets")


def text_classes(docs: DataFrame, threshold: float) -> DataFrame:
    """Per distinct non-empty text of (doc_id, text): h1, h2, own (its smallest doc_id), class_id
    and kept (it is the class's one kept text)."""
    units = units_of(docs)
    labels, _ = link_units(docs, units, threshold)
    named = units.select("uid", "h1", "h2", "doc_id").join(labels, F.col("uid") == labels["node"], "left").select(
        "uid", "h1", "h2", "doc_id", F.coalesce("root", "uid").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("uid").alias("uid"))
    lead = named.groupBy("root").agg(F.min(order).alias("m")).select("root", F.col("m.id").alias("class_id"), F.col("m.uid").alias("lead"))
    return named.join(lead, "root").select("h1", "h2", F.col("doc_id").alias("own"), "class_id", (F.col("uid") == F.col("lead")).alias("kept"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id and class_id."""
    docs = docs.select(ref(key).alias("doc_id"), ref(text).alias("text"))
    classes = text_classes(docs, threshold).select("h1", "h2", "class_id")
    rows = docs.select("doc_id", *_identity(), (F.coalesce(F.octet_length("text"), F.lit(0)) == 0).alias("blank"))
    out = rows.where("not blank").join(classes, ["h1", "h2"]).select("doc_id", "class_id")
    return out.unionByName(rows.where("blank").select("doc_id", F.col("doc_id").alias("class_id")))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every class stays (smallest doc_id), with all columns; null and empty texts stay."""
    spark = docs.sparkSession
    with cuts() as made:
        kept = text_classes(docs.select(ref(key).alias("doc_id"), ref(text).alias("text")), threshold).where("kept")
        kept = cut(kept.select("h1", "h2", "own"), "kept-texts")  # a stored side: AQE can split a text with many copies
    drop_cuts(spark, made[:-1])
    a, b, own = (free_name(docs.columns, f"__{c}") for c in ("h1", "h2", "own"))
    kept = kept.select(F.col("h1").alias(a), F.col("h2").alias(b), F.col("own").alias(own))
    full = F.octet_length(ref(text)) > 0
    rows = docs.where(full).withColumns({a: F.xxhash64(ref(text)), b: F.xxhash64(ref(text), F.lit(1))})
    rows = rows.join(kept, [a, b]).where(ref(key).eqNullSafe(ref(own)))
    columns = [ref(c) for c in docs.columns]
    one = rows.dropDuplicates([a, b]).select(*columns)  # repeated rows
    return one.unionByName(docs.where(~F.coalesce(full, F.lit(False))))
