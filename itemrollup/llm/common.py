"""Helpers the operators share: table access, cuts on shared storage, gapless numbering."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_run_dir, new_run_dir
from . import blocks as B


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ref(name: str) -> Column:
    """The column of this very name, also where it holds dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, lengthened until no column of ``taken`` has it (column names ignore case)."""
    have = {t.lower() for t in taken}
    while base.lower() in have:
        base += "_"
    return base


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (no-op if installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


_scopes: list[list[str]] = []


@contextmanager
def cuts() -> Iterator[list[str]]:
    """The folders that ``cut`` writes inside the block, for ``drop_cuts`` once no frame reads them."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.pop(next(i for i, x in enumerate(_scopes) if x is made))


def drop_cuts(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        drop_run_dir(spark, path)


def schema_of(df: DataFrame, columns: Iterable[str] | None = None) -> str:
    """The columns (default: all) as DDL, with names that may hold dots or back-ticks."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join("`" + c.replace("`", "``") + "` " + kinds[c] for c in (df.columns if columns is None else columns))


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared staging folder and read it back.

    Ends the lineage there: a lost executor repeats work from this table only, and later
    readers all see the same rows (also where a column was not deterministic).
    """
    path = new_run_dir(df.sparkSession, label)
    for made in _scopes:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_fold(key: str | Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus`` (null keys: null)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % modulus


def numbered(df: DataFrame, group: str, slot: str = "slot", rows_per_part: int = 20_000) -> DataFrame:
    """Number the rows of every ``group`` value from 0 without gaps, without one task per group.

    ``df`` must be a stored table (see ``cut``) with a unique long column ``rid``.  Rows of a
    group are dealt over parts by a hash of ``rid``; only the part counts meet in a window,
    and each part then numbers its own bounded share.  A group with a third of all rows is
    spread over as many parts as its size asks for.
    """
    n = df.count()  # answered from the stored table's footers
    parts = max(1, -(-n // rows_per_part))
    df = df.withColumn("_part", F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int"))
    counts = df.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy(group, "_part").orderBy("rid")
    ranked = df.withColumn("_rn", F.row_number().over(own) - 1)
    joined = ranked.join(offsets, ranked[group].eqNullSafe(offsets["_g"]) & (ranked["_part"] == offsets["_p"]))
    return joined.withColumn(slot, F.col("_off") + F.col("_rn")).drop("_part", "_g", "_p", "_off", "_rn")


def freed(run: Callable) -> Callable:
    """``run`` for mapInArrow, whose Python worker gives its freed memory back when the task ends.

    Workers are kept for later stages; without this each holds its largest task's memory on.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return task


def map_blocks(df: DataFrame, schema: str, make: Callable, text: str = "text", block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Apply ``make(batch_part, buf, offs) -> dict of arrays`` to blocks of whole texts.

    ``batch_part`` is the Arrow slice of the block's rows, ``buf``/``offs`` its UTF-8 bytes and
    text offsets.  Memory is bounded by one Arrow batch plus a few arrays per block.
    """
    names = [f.name for f in df.sparkSession.createDataFrame([], schema).schema.fields]
    at = df.columns.index(text)
    if any("." in c or "`" in c for c in df.columns):  # mapInArrow resolves plain names only
        df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = B.buffers(batch.column(at))
            for lo, hi in B.split_blocks(offs, block_bytes):
                out = make(batch.slice(lo, hi - lo), buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                if out is not None:
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)], names=names)

    return df.mapInArrow(freed(run), schema)


def sample_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows with the smallest hash of ``key``: the bounded training samples.

    A top-n over (key and label columns only); every task keeps n rows at most.
    """
    return df.orderBy(F.xxhash64(F.col(key), F.lit(17)), F.col(key)).limit(n)


def one_per_key(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` joined to the distinct sampled ``keys`` (bounded, broadcast) on their common columns, one
    row a key: that of the smallest hash of its own columns.  A key in many rows brings no more rows on."""
    on = [c for c in keys.columns if c in rows.columns]
    rows = rows.withColumn("_h", F.xxhash64(*[c for c in rows.columns if c not in on]))
    first = rows.select(*on, "_h").join(F.broadcast(keys), on).groupBy(*keys.columns).agg(F.min("_h").alias("_h"))
    return rows.join(F.broadcast(first), [*on, "_h"]).dropDuplicates(on).drop("_h")


def segment_ids(counts: np.ndarray) -> np.ndarray:
    """0,0,..,1,1,..: the segment number of every element of segments with these sizes."""
    return np.repeat(np.arange(len(counts)), counts)
