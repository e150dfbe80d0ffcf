"""Reusable DataFrame operators.

All operators are lazy, keep the work distributed, and never collect.  They
close three gaps between SQL-Server-style set statements and Spark:

* ``not_in``: exact NULL-aware ``NOT IN (subquery)`` without the broadcast
  null-aware anti join Spark plans for it (unsafe for a large right side).
* ``keyed_update``: ``UPDATE ... FROM`` that keeps the target's rows and
  duplicates, lets a matching NULL overwrite, and reads pre-update values.
* ``first_per_key``: one whole row per key under an explicit total order,
  computed as a partial (map-side) aggregate, so a hot key never lands in one
  sorted window partition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, text_key

__all__ = [
    "not_in",
    "global_position",
    "existence_flag",
    "keyed_update",
    "first_per_key",
    "delete_where",
    "conditional_totals",
    "current_and_archive",
    "rekey",
    "distinct_keys",
    "group_text",
    "FusedSource",
    "fused_sources",
    "fused_join",
]


def distinct_keys(df: DataFrame, key: str | Column, alias: str = "_key") -> DataFrame:
    """Distinct non-NULL values of one key (partial aggregation before the shuffle)."""
    return df.select(col(key).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def group_text(df: DataFrame, texts: Sequence[str], aggs: Sequence[Column] = (), by: Sequence[str] = ()) -> DataFrame:
    """``groupBy(by, texts)`` that takes ``texts`` as equal without regard to case and trailing blanks.

    A group shows the smallest of its spellings, column by column; ``by`` is compared exactly.
    """
    keys = [text_key(t).alias(f"_g_{t}") for t in texts]
    out = df.groupBy(*by, *keys).agg(*[F.min(t).alias(t) for t in texts], *aggs)
    return out.drop(*[f"_g_{t}" for t in texts])


def not_in(
    left: DataFrame,
    left_key: str | Column,
    right: DataFrame,
    right_key: str | Column,
    by: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of ``left`` for which ``left_key NOT IN (SELECT right_key FROM right)`` is TRUE.

    Three-valued semantics: an empty right side keeps every row (NULL keys
    too); one NULL on the right removes every row; a NULL left key is removed
    when the right side is not empty.

    ``by`` correlates the subquery: ``{left_col: right_col}`` pairs restrict
    the right side per left row (``x NOT IN (... WHERE r.item = l.item)``).

    Plan: the right side's (count, non-NULL count) is a one-row scalar
    subquery (or a per-group aggregate when correlated), then a plain
    ``left_anti`` join on distinct non-NULL keys that Spark may shuffle or
    broadcast as it measures.
    """
    lk = col(left_key)
    rk = col(right_key)
    if not by:
        # One de-duplicated key set (NULL kept as one value) feeds both the
        # statistics and the anti join, so the right side is scanned once.
        keys = right.select(rk.alias("_nk")).distinct()
        stats = keys.select(
            F.struct(F.count(F.lit(1)).alias("n"), F.count("_nk").alias("nn")).alias("s")
        ).scalar()
        n, nn = stats.getField("n"), stats.getField("nn")
        kept = left.where((n == 0) | ((n == nn) & lk.isNotNull()))
        return kept.join(keys.where(F.col("_nk").isNotNull()), lk == F.col("_nk"), "left_anti")

    lcols, rcols = list(by.keys()), list(by.values())
    stats = right.groupBy(*[F.col(r).alias(f"_nb{i}") for i, r in enumerate(rcols)]).agg(
        F.count(F.lit(1)).alias("_nn_all"), F.count(rk).alias("_nn_key")
    )
    cond = [left[lc] == stats[f"_nb{i}"] for i, lc in enumerate(lcols)]
    with_stats = left.join(stats, cond, "left")
    kept = with_stats.where(
        F.col("_nn_all").isNull() | ((F.col("_nn_all") == F.col("_nn_key")) & lk.isNotNull())
    ).select(*left.columns)
    keys = (
        right.select(*[F.col(r).alias(f"_nb{i}") for i, r in enumerate(rcols)], rk.alias("_nk"))
        .where(F.col("_nk").isNotNull())
        .distinct()
    )
    cond = [kept[lc] == keys[f"_nb{i}"] for i, lc in enumerate(lcols)] + [lk == keys["_nk"]]
    return kept.join(keys, cond, "left_anti")


def existence_flag(
    df: DataFrame, keys: DataFrame, on: Mapping[str, str] | Sequence[str], name: str
) -> DataFrame:
    """Add boolean ``name``: TRUE when ``df``'s key occurs in ``keys`` (``IN`` inside OR).

    Row count is preserved: the key list is de-duplicated before a left join.
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
    right = (
        keys.select(*[F.col(r).alias(f"_ef{i}") for i, (_, r) in enumerate(pairs)])
        .dropna()
        .distinct()
        .withColumn(f"_hit_{name}", F.lit(True))
    )
    cond = [df[left] == right[f"_ef{i}"] for i, (left, _) in enumerate(pairs)]
    out = df.join(right, cond, "left")
    return out.select(*df.columns, F.coalesce(F.col(f"_hit_{name}"), F.lit(False)).alias(name))


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    descending: bool = False,
) -> DataFrame:
    """One whole row per key: the smallest (or largest) under ``order`` + all columns.

    The row is chosen with ``min``/``max`` over a struct whose leading fields are
    the order expressions followed by every payload column, which makes the
    choice a total order (deterministic under any input partitioning).  In a
    struct comparison NULL sorts first, so with ``descending=True`` NULLs come
    last; prepend ``c.isNull()`` to put NULLs last in ascending order.
    It runs as a partial aggregate, so skewed keys are combined map-side.
    """
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in payload]
    )
    pick = (F.max if descending else F.min)(packed).alias("_w")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col("_w").getField(c).alias(c) for c in payload])


def keyed_update(
    target: DataFrame,
    source: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    assignments: Mapping[str, Column],
    where: Column | None = None,
) -> DataFrame:
    """``UPDATE target SET ... FROM target JOIN source ON ... WHERE ...``.

    ``source`` must hold at most one row per key (aggregate it or use
    ``first_per_key``).  Every target row is kept, duplicates included; only
    rows with a match and a TRUE ``where`` change; a matching NULL overwrites;
    all assignments read pre-update values.  Non-key source columns must not
    collide with target columns.  Column types of the target are kept.
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
    src_keys = {r for _, r in pairs}
    src = source.select(
        *[F.col(r).alias(f"_uk{i}") for i, (_, r) in enumerate(pairs)],
        *[F.col(c) for c in source.columns if c not in src_keys],
        F.lit(True).alias("_upd_hit"),
    )
    cond = [target[t] == src[f"_uk{i}"] for i, (t, _) in enumerate(pairs)]
    joined = target.join(src, cond, "left")
    apply = F.coalesce(F.col("_upd_hit"), F.lit(False))
    if where is not None:
        apply = apply & F.coalesce(where, F.lit(False))
    out = []
    for c in target.columns:
        if c in assignments:
            dtype = target.schema[c].dataType
            out.append(F.when(apply, assignments[c].cast(dtype)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


@dataclass(frozen=True)
class FusedSource:
    """One source of a group of keyed updates: raw or aggregated rows and what to keep of them per key.

    ``aggs`` gets an accessor for the source's columns and returns the aggregates by name, e.g.
    ``lambda c: {"on_hand": F.sum(c("quantity"))}``.  A choice among rows is a ``max``/``min`` over
    a struct, so it is combined map-side like a sum.
    """

    rows: DataFrame
    key: str
    aggs: Callable[[Callable[[str], Column]], Mapping[str, Column]]


def fused_sources(sources: Mapping[str, FusedSource], key: str = "_fk") -> DataFrame:
    """One row a key with a struct column per source: its aggregates, or NULL where it has no row.

    The rows of all sources are united, each in a struct column of its own, and grouped once: the
    sources share one shuffle, into which each sends at most one partial row a key and task.
    """
    kinds = {n: F.struct(*[F.col(c) for c in s.rows.columns]) for n, s in sources.items()}
    typed = {n: s.rows.select(kinds[n].alias("x")).schema["x"].dataType for n, s in sources.items()}
    parts = None
    for name, s in sources.items():
        part = s.rows.where(F.col(s.key).isNotNull()).select(
            F.col(s.key).alias(key), *[(kinds[n] if n == name else F.lit(None).cast(typed[n])).alias(n) for n in sources])
        parts = part if parts is None else parts.unionByName(part)
    aggs, shapes = [], []
    for name, s in sources.items():
        own = s.aggs(lambda c, n=name: F.col(n).getField(c))
        aggs.append(F.max(F.col(name).isNotNull()).alias(f"_{name}_hit"))
        aggs += [agg.alias(f"_{name}_{out}") for out, agg in own.items()]
        inner = F.struct(F.lit(True).alias("hit"), *[F.col(f"_{name}_{out}").alias(out) for out in own])
        shapes.append(F.when(F.col(f"_{name}_hit"), inner).alias(name))
    return parts.groupBy(key).agg(*aggs).select(key, *shapes)


def fused_join(target: DataFrame, sources: Mapping[str, FusedSource], on: str) -> DataFrame:
    """``target`` with one struct column per source (see ``fused_sources``), by one left join.

    The caller writes the statements of the group in their order as column assignments over the
    structs; ``<source>.hit`` is TRUE where the source has the row's key.
    """
    fused = fused_sources(sources)
    return target.join(fused, target[on] == fused["_fk"], "left").drop("_fk")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Remove rows where ``predicate`` is TRUE; rows where it is NULL stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def conditional_totals(
    df: DataFrame,
    keys: Sequence[str | Column],
    measures: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """Many ``SUM(CASE WHEN pred THEN value ELSE 0 END)`` measures in one pass."""
    aggs = [F.sum(F.when(pred, value).otherwise(F.lit(0))).alias(name) for name, (pred, value) in measures.items()]
    return df.groupBy(*keys).agg(*aggs)


def current_and_archive(current: DataFrame, archive: DataFrame) -> DataFrame:
    """One logical table from a current and an archive table with the same columns."""
    if sorted(current.columns) != sorted(archive.columns):
        raise ValueError(f"current/archive columns differ: {current.columns} vs {archive.columns}")
    return current.unionByName(archive)


def rekey(df: DataFrame, mapping: DataFrame, key: str, from_col: str, to_col: str, out: str) -> DataFrame:
    """Attribute rows to a parent key: ``out`` = mapped key where ``key`` is in ``mapping``.

    Rows whose key is mapped take the mapped value even when it is NULL (no
    fallback to the original key); others keep their key.  A key mapped to
    several parents yields one row per parent, like the join it replaces.
    """
    m = mapping.select(F.col(from_col).alias("_rk_from"), F.col(to_col).alias("_rk_to"), F.lit(True).alias("_rk_hit"))
    j = df.join(m, df[key] == m["_rk_from"], "left")
    return j.select(
        *df.columns,
        F.when(F.col("_rk_hit").isNotNull(), F.col("_rk_to")).otherwise(F.col(key)).alias(out),
        F.col("_rk_hit").isNotNull().alias("_rekeyed"),
    )


def global_position(df: DataFrame, order: Sequence[Column], store: Callable[[DataFrame], DataFrame], name: str = "position") -> DataFrame:
    """``df`` with its 1-based position under ``order``, a total order up to identical rows.

    One range shuffle, no window over the rows: every task sorts a range of the order and its rows are
    stored (``store`` writes and reads back) with the task's number and their place in it.  The
    rows counted per task, one row a shuffle partition, give each range's first position.
    The written table also fixes the sampled range bounds, so a lost executor cannot move a row.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = store(ranged.withColumn("_at", F.monotonically_increasing_id()))  # task number above bit 33
    stored = stored.withColumn("_range", F.shiftright("_at", 33))
    counts = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(firsts, "_range").select(*df.columns, (F.col("_before") + place + 1).alias(name))
