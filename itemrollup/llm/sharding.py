"""Jump consistent hashing: stable keys to shards without a ring table (native columns only).

A key walks a chain of buckets 0 = b0 < b1 < ...: from bucket b it jumps to
floor((b + 1) / r), with r in (0, 1] drawn from a hash of (key, b).  The chain depends on the
key alone, and the shard among n is the chain's last bucket below n.  So one more shard takes
rows only into itself, and a fraction 1/(n + 1) of them in expectation.

Defined cases: a null text has no bytes (size 1, crc32 0); a null key is a key like any other;
repeated rows are separate rows of the same shard with their own slots; extra input columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 .. shards - 1) of ``key``.  About ln(shards) hashes a key, at most ``shards``."""
    if shards < 1:
        raise ValueError("shards must be positive")

    def jump(state: Column, _: Column) -> Column:
        at = state["next"]
        r = (F.shiftrightunsigned(F.xxhash64(key, at), 11) + 1) / F.lit(float(1 << 53))
        moved = F.struct(at.alias("at"), F.floor((at + 1) / r).cast("long").alias("next"))
        return F.when(at < shards, moved).otherwise(state)

    start = F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["at"].cast("int"))


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its shard, a gapless slot in the shard and its shard after one is added.

    Columns: key, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard.  Text is
    read once, in the scan; only the narrow digest rows are stored and numbered.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    k = F.col(key).cast("string")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        jump_shard(k, shards).alias("shard"),
        jump_shard(k, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("rid"),
    )
    out = numbered(cut(rows, "shards"), "shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
