"""Phrase collocations: phrases of 2 to 4 words that occur far more often than chance cuts of them.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into
words at blanks.  Counting is by HAT-tries: every task puts the phrases of its texts into a trie
of word ids (see ``hat_trie``) with bounded memory; what leaves the trie are sorted runs, which
Spark merges per prefix partition (all words but the last and the first six bits of the last
one's id, so that one hot prefix is spread over 64 partitions).

A phrase of at least ``least`` occurrences has only parts of at least as many.  So texts are
read three times: words; pairs of frequent words; triples and quadruples of frequent pairs.
"Frequent" is asked of a bit filter of a fixed size (``filter_bits``, 8 MB), the only thing that
is broadcast.  It answers yes too often when it fills up, never no: counts are exact at every
size, the filter only spares rows.

A word id is a 64-bit hash of language and word.  The word table shows if two words share an
id, and counting then starts anew with another seed, so results do not rest on hashes.

Defined cases: a null text is empty, a null language ``und``; equal rows count each; pieces,
words and texts of any length are read whole; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut, freed, map_blocks, ref
from .hat_trie import HatTrie, Run

U64 = np.uint64
WIDTH = 4  # words of the longest phrase
_BREAK = B.byte_table(lambda b: b in b".,;:!?\n\x0b\x0c\r")
_WORD = B.byte_table(lambda b: b not in b".,;:!?\n\x0b\x0c\r \t")
_LONG = 512  # the rolling hash is not trusted with longer words


class Phrases:
    """The words of a block: ids (language and word, never 0) and whether the next word is in the same piece."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, langs: pa.Array, seed: int):
        self.buf = B.LOWER[buf]
        self.words = words = B.Words(self.buf, offs, _WORD)
        h, size = words.hashes(), words.ends - words.starts
        for i in np.flatnonzero(size > _LONG):
            h[i] = self._digest(self.buf[words.starts[i]:words.ends[i]].tobytes(), seed)
        code = pc.dictionary_encode(langs)
        own = np.array([self._digest(x.encode(), seed) for x in code.dictionary.to_pylist()], dtype=U64)
        self.doc = words.doc_of()
        if len(h):
            h = B.mix(h + own[np.asarray(code.indices)[self.doc]], seed)
            h[h == 0] = 1
        self.ids = h
        breaks = np.zeros(len(self.buf) + 1, dtype=np.int32)
        np.cumsum(_BREAK[self.buf], out=breaks[1:])
        self.linked = (breaks[words.starts[1:]] == breaks[words.ends[:-1]]) & (self.doc[1:] == self.doc[:-1])

    @staticmethod
    def _digest(raw: bytes, seed: int) -> np.uint64:
        return U64(int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little"))


def _known(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(ref(lang).cast("string"), F.lit("und")).alias("lang"), ref(text).alias("text"))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """id, lang, word, n of every word."""

    def count(batch, buf, offs):
        p = Phrases(buf, offs, batch.column(0), seed)
        ids, first, n = np.unique(p.ids, return_index=True, return_counts=True)
        raw = p.buf.tobytes()
        spelt = [raw[a:b] for a, b in zip(p.words.starts[first], p.words.ends[first])]
        return {"id": ids.view(np.int64), "lang": batch.column(0).take(pa.array(p.doc[first])), "word": pa.array(spelt, pa.binary()).cast(pa.string()), "n": n}

    rows = map_blocks(docs, "id bigint, lang string, word string, n bigint", count)
    return rows.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


def _probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit positions of every column of ids."""
    h = keys[0]
    for k in keys[1:]:
        h = B.mix(h * U64(0x9E3779B97F4A7C15) + k)
    h = B.mix(h, 0x51)
    yield h & U64(bits - 1)
    yield (h >> U64(32)) & U64(bits - 1)


def bit_filter(rows: DataFrame, columns: list[str], bits: int) -> np.ndarray:
    """A filter of ``bits`` bits that has every row's ids; at most bits / 64 rows reach the driver."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, dtype=U64)
        for batch in batches:
            keys = np.stack([np.asarray(c).view(U64) for c in batch.columns])
            for at in _probes(keys, bits):
                np.bitwise_or.at(words, (at >> U64(6)).astype(np.int64), U64(1) << (at & U64(63)))
        used = np.flatnonzero(words)
        for lo in range(0, len(used), 1 << 16):
            part = used[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part].view(np.int64))], names=["slot", "bits"])

    found = rows.select(*columns).mapInArrow(freed(slots), "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=U64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(U64)
    return out


def in_filter(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which columns of ids the filter has (all that were put in, and a few more)."""
    ok = np.ones(keys.shape[1], dtype=bool)
    for at in _probes(keys, len(words) * 64):
        ok &= (words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63)) & U64(1)).astype(bool)
    return ok


def pair_runs(p: Phrases, frequent: np.ndarray) -> Iterator[Run]:
    """The block's pairs of frequent words as a sorted run."""
    ok = in_filter(frequent, p.ids[None, :])
    at = np.flatnonzero(p.linked & ok[:-1] & ok[1:])
    if not len(at):
        return
    ids, of = np.unique(p.ids, return_inverse=True)  # ascending, so codes sort like the ids
    codes, n = np.unique(of[at] * len(ids) + of[at + 1], return_counts=True)
    yield np.stack([ids[codes // len(ids)], ids[codes % len(ids)]]), n


def long_runs(p: Phrases, frequent: np.ndarray) -> Iterator[Run]:
    """The block's triples and quadruples of frequent pairs as sorted runs (triples end with id 0)."""
    ok = np.zeros(len(p.ids), dtype=bool)
    at = np.flatnonzero(p.linked)
    ok[at] = in_filter(frequent, np.stack([p.ids[at], p.ids[at + 1]]))
    at = np.flatnonzero(ok)
    if not len(at):
        return
    ids, of = np.unique(p.ids, return_inverse=True)
    pairs, pair_at = np.unique(of[at] * len(ids) + of[at + 1], return_inverse=True)
    pair = np.zeros(len(p.ids), dtype=np.int64)
    pair[at] = pair_at
    three = at[ok[at + 1]]  # the last word begins no pair, so none of these indices runs over
    four = three[ok[three + 2]]
    first, second = ids[pairs // len(ids)], ids[pairs % len(ids)]
    if len(three):
        codes, n = np.unique(pair[three] * len(ids) + of[three + 2], return_counts=True)
        yield np.stack([first[codes // len(ids)], second[codes // len(ids)], ids[codes % len(ids)], np.zeros(len(codes), U64)]), n
    if len(four):
        codes, n = np.unique(pair[four] * len(pairs) + pair[four + 2], return_counts=True)
        lead, tail = codes // len(pairs), codes % len(pairs)
        yield np.stack([first[lead], second[lead], first[tail], second[tail]]), n


def prefix(words: list[str]) -> Column:
    """The prefix partition of a phrase: all its words but the last, and the leading bits of the last."""
    lead = lambda c: F.shiftrightunsigned(c, 58)
    out = F.xxhash64(*words[:-1], lead(words[-1]))
    if len(words) > 2:
        out = F.when(F.col(words[-1]) == 0, F.xxhash64(*words[:-2], lead(words[-2]))).otherwise(out)
    return out


def phrase_counts(docs: DataFrame, seed: int, width: int, runs_of, frequent: np.ndarray, least: int, capacity: int, budget: int) -> DataFrame:
    """w1..w<width>, n of the phrases that ``runs_of`` finds and that occur at least ``least`` times."""
    words = [f"w{i + 1}" for i in range(width)]
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # a fixed size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(width, capacity, budget)

        def rows(runs: Iterator[Run]) -> Iterator[pa.RecordBatch]:
            for keys, n in runs:
                for lo in range(0, len(n), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    yield pa.RecordBatch.from_arrays([*(pa.array(k[part].view(np.int64)) for k in keys), pa.array(n[part])], names=[*words, "n"])

        for batch in batches:
            buf, offs = B.buffers(batch.column(1))
            for lo, hi in B.split_blocks(offs):
                p = Phrases(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], batch.column(0).slice(lo, hi - lo), seed)
                for keys, n in runs_of(p, sent.value) if len(p.ids) > 1 else ():
                    yield from rows(trie.add(keys, n))
        yield from rows(trie.drain())

    runs = docs.mapInArrow(freed(count), ", ".join(f"{c} bigint" for c in [*words, "n"]))
    # rows of a phrase meet in its prefix partition; grouping by prefix and words needs no other shuffle
    merged = runs.withColumn("prefix", prefix(words)).repartition("prefix").groupBy("prefix", *words).agg(F.sum("n").alias("n"))
    return merged.where(F.col("n") >= least).drop("prefix")


def frequent_phrases(docs: DataFrame, text: str, lang: str, least: int, filter_bits: int, capacity: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """(all words: id, lang, word, n; phrases of 1 to 4 words with n >= least: key array of ids, n), both stored."""
    rows = _known(docs, text, lang)
    seed = 0
    while True:
        words = cut(word_counts(rows, seed), "collocation-words")
        if not words.groupBy("id").count().where("count > 1").limit(1).count():
            break
        seed += 1
    often = words.where(F.col("n") >= least).select("id", "n")
    pairs = cut(phrase_counts(rows, seed, 2, pair_runs, bit_filter(often, ["id"], filter_bits), least, capacity, budget), "collocation-pairs")
    longer = phrase_counts(rows, seed, WIDTH, long_runs, bit_filter(pairs, ["w1", "w2"], filter_bits), least, capacity, budget)
    key = F.when(F.col("w4") == 0, F.array("w1", "w2", "w3")).otherwise(F.array("w1", "w2", "w3", "w4"))
    phrases = often.select(F.array("id").alias("key"), "n").unionByName(pairs.select(F.array("w1", "w2").alias("key"), "n"))
    return words, cut(phrases.unionByName(longer.select(key.alias("key"), "n")), "collocation-phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """key, a, k, l, r, score of every phrase of two words and more: its lowest-scoring cut."""
    cuts = phrases.where(F.size("key") > 1).select("key", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("key") - 1)).alias("k"))
    cuts = cuts.select("key", "a", "k", F.slice("key", F.lit(1), F.col("k")).alias("_l"), F.slice("key", F.col("k") + 1, F.size("key") - F.col("k")).alias("_r"))
    part = lambda name: phrases.select(F.col("key").alias(f"_{name}"), F.col("n").alias(name))
    cuts = cuts.join(part("l"), "_l").join(part("r"), "_r")
    exact = F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    best = cuts.select("key", "a", F.struct(exact.cast("bigint").alias("score"), "k", "l", "r").alias("c")).groupBy("key", "a").agg(F.min("c").alias("c"))
    return best.select("key", "a", "c.k", "c.l", "c.r", "c.score")


def covered(phrases: DataFrame) -> DataFrame:
    """key, most: the count of the most frequent longer phrase around a phrase."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("key") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("key") - m + 1), lambda s: F.slice("key", s, m))))
    return phrases.where(F.size("key") > 2).select(F.explode(inner).alias("key"), "n").groupBy("key").agg(F.max("n").alias("most"))


def spelt(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with lang and phrase in place of key."""
    keep = [c for c in rows.columns if c != "key"]
    each = rows.select("key", F.posexplode("key").alias("pos", "id")).join(words.select("id", "lang", "word"), "id")
    text = each.groupBy("key").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))  # 4 words at most
    return rows.join(text, "key").select("lang", F.concat_ws(" ", "w.word").alias("phrase"), *keep)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000,
                 filter_bits: int = 1 << 26, capacity: int = 1 << 16, budget: int = 1 << 21) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of every language's first ``top`` phrases.

    ``capacity`` is a container's rows, ``budget`` the trie's (about 40 bytes a row).
    """
    words, phrases = frequent_phrases(docs, text, lang, least, filter_bits, capacity, budget)
    kept = scored(phrases).join(covered(phrases), "key", "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(22,0)") * 100 < F.col("a").cast("decimal(22,0)") * 80)).drop("most")
    rows = spelt(cut(kept, "collocation-kept"), words.where(F.col("n") >= least)).withColumn("_deal", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first of every deal, then the first of these: no task sees a whole language
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_deal").orderBy(*order))).where(F.col("_at") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
