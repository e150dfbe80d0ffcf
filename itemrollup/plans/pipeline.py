"""The two entry points: ``rebuild`` (the per-item rollup) and ``report``.

Stages follow the original statement order wherever a later statement reads
what an earlier one wrote.  Every stage is a lazy DataFrame; the ``Stager``
cuts the lineage at 28 points by writing the frame to the shared staging
folder (``spark.checkpoint.dir``) and reading it back.  That bounds plan size
(one plan of all 60 statements is too large for the optimizer), lets each cut
be reused by all later readers without recomputation, and lets a failed
executor be recovered from the last cut instead of from the base tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import fused_join
from ..session import drop_run_dir, new_run_dir
from ..sources import Sources
from . import activity, candidates, lines, pending, publish, purchasing, sales, summarise
from .contracts import PUBLISHED
from .params import RollupParams

SIDE_BY_SIDE = 3  # cuts written at a time


@dataclass
class Stager:
    """Lineage cuts: ``cut(df, name)`` writes parquet under a fresh run folder and reads it back.

    ``enabled=False`` keeps everything lazy: one plan per stage frame, fine for
    ``explain`` of a single stage, far too large to optimise for the whole run.
    """

    spark: SparkSession
    enabled: bool = True
    root: str | None = None
    seen: dict[str, int] = field(default_factory=dict)  # observed metrics by name

    def cut(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        """Write and read back; ``metrics`` are aggregates observed while the rows are written."""
        if not self.enabled:
            return df
        if self.root is None:
            self.root = new_run_dir(self.spark, "rebuild")
        path = f"{self.root}/{name}"
        df, told = observed(df, **metrics)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.seen.update(told())
        return self.spark.read.parquet(path)

    def cuts(self, frames: Mapping[str, DataFrame]) -> list[DataFrame]:
        """``cut`` of frames of which none reads another, written side by side: the last tasks of one leave
        cores idle that the next takes.  The session's scheduler shares them out; no task gets more memory or less."""
        if self.enabled and self.root is None:
            self.root = new_run_dir(self.spark, "rebuild")

        def inheriting() -> Callable[..., DataFrame]:
            """``cut`` under the caller's job properties and tags, in a copy of its own."""
            wrap = inheritable_thread_target(self.spark)
            return wrap(self.cut) if callable(wrap) else self.cut  # no wrapper where threads are not pinned

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            jobs = [pool.submit(inheriting(), df, name) for name, df in frames.items()]
            return [job.result() for job in jobs]

    def close(self) -> None:
        """Delete this run's own folder.  Call it when the result is stored elsewhere: frames
        that read the cuts end with it."""
        if self.root is not None:
            drop_run_dir(self.spark, self.root)
            self.root = None


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with aggregates that are computed while it is written, and what tells them afterwards."""
    if not metrics:
        return df, dict
    watch = Observation()
    return df.observe(watch, *[c.alias(n) for n, c in metrics.items()]), lambda: dict(watch.get)


def rows_seen() -> Column:
    return F.count(F.lit(1))


def empty_prior(spark: SparkSession) -> DataFrame:
    """The previous snapshot of a first run: no rows, published schema."""
    return spark.createDataFrame([], PUBLISHED).limit(0)  # the optimizer sees that it is empty


def rebuild_stages(
    src: Sources, prior: DataFrame, p: RollupParams, stager: Stager, sold: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Run all stages; returns every named intermediate (``published`` is the result).

    ``sold`` are the sales window's sums per sold item where they are kept (``daily.totals_of_days``).
    """
    t: dict[str, DataFrame] = {}
    for t in stage_groups(src, prior, p, stager, sold):
        pass
    return t


def stage_groups(
    src: Sources, prior: DataFrame, p: RollupParams, stager: Stager, sold: DataFrame | None = None,
    before: dict[str, DataFrame] | None = None,
) -> Iterator[dict[str, DataFrame]]:
    """The stages step by step: yields the growing dict of intermediates ahead of the cuts, so a
    caller that needs an early one stops there and pays for no later cut.

    ``OF_SOURCES`` do not read the previous snapshot.  ``before`` are the intermediates
    of another finished run over the same sources and parameters: these then are read, not computed again.
    """
    if before is not None:
        t = {name: before[name] for name in OF_SOURCES}
        yield t
    else:
        for t in sales_groups(src, p, stager, sold):
            yield t
    yield from published_groups(t, src, prior, p, stager)


def sales_groups(src: Sources, p: RollupParams, stager: Stager, sold: DataFrame | None = None) -> Iterator[dict[str, DataFrame]]:
    """Stage groups 0-3 (P02-P26), which read the sources alone; yields like ``stage_groups``."""
    t: dict[str, DataFrame] = {}

    # 0. fact lines joined to their headers once
    ol, sl = t["order_lines"], t["shipment_lines"] = stager.cuts({
        "order_lines": lines.order_lines(src),
        "shipment_lines": lines.flag_transfers(src, lines.shipment_lines(src).drop("po_number")),
    })
    notes = t["order_notes"] = stager.cut(lines.order_notes(ol), "order_notes")
    yield t

    # 1. activity summaries (and the picks of the notes)
    a, receipts, picks, ship_hist = t["received_a"], t["receipt_totals"], t["note_picks"], t["ship_hist"] = stager.cuts({
        "received_a": activity.received_sources(src).select(*activity.RECEIVED_COLUMNS),
        "receipt_totals": activity.receipt_totals(src),
        "note_picks": lines.note_picks(notes),
        "ship_hist": activity.shipment_history(src, p, sl),
    })
    wh_receipts, b = t["warehouse_receipts"], t["received_b"] = stager.cuts({
        "warehouse_receipts": activity.warehouse_receipts(src, ship_hist, receipts),
        "received_b": activity.received_union_distinct(src, a, receipts).select(*activity.RECEIVED_COLUMNS),
    })
    c = t["received_c"] = activity.distribution_received(src, p, a.unionByName(b)).select(*activity.RECEIVED_COLUMNS)
    rcvd = t["received"] = stager.cut(a.unionByName(b).unionByName(c), "received")
    t["last_proc"] = activity.last_processed(rcvd)
    rcvd_items = t["received_items"] = activity.received_per_item(rcvd)

    yield t

    # 2. candidate items, quantities and status
    cands = candidates.candidates(src, p, ship_hist, wh_receipts, rcvd_items, notes)
    t["cand_ship"] = candidates.work_rows(cands.where(F.col("_kind") == candidates.SHIPPED))
    t["cand_rcvd"] = candidates.work_rows(cands.where(F.col("_kind") == candidates.RECEIVED))
    t["transfers"] = activity.transfer_totals(src, p, sl)
    sources = candidates.activity_sources(src, t["transfers"], ship_hist, rcvd_items)
    joined = fused_join(candidates.work_rows(cands), sources, "item_code")  # P10-P18 read one join
    plain = lambda df: df.drop(*sources)
    joined = candidates.drop_base_inventory(joined)
    t["w10"] = plain(joined)
    joined = candidates.set_transfers(joined)
    t["w12"] = plain(joined)
    joined = candidates.set_drop_ship_received(joined)
    t["w13"] = plain(joined)
    joined = candidates.set_received_status(joined)
    t["w16"] = plain(joined)
    yield t
    work = t["w18"] = stager.cut(plain(candidates.set_on_hand(joined)), "work_candidates")
    yield t

    # 3. sales
    upc = t["upc_items"] = stager.cut(sales.alias_items(src), "alias_items")
    yield t
    t["sales_data"] = sales.sales_rekeyed_totals(src, p, upc, items=work, per_item=sold)
    online = t["online"] = stager.cut(sales.online_sales(src, upc, p.start_date, p.end_date), "online_sales")
    cross = t["cross_store"] = sales.cross_store_sales(src, p, items=work)
    sources = sales.sales_sources(t["sales_data"], online, cross)
    joined = sales.set_sales(fused_join(work, sources, "item_code"))  # P23 and P26 read one join
    t["w23"] = joined.drop(*sources)
    yield t
    work = t["w26"] = stager.cut(sales.set_channel_sales(joined).drop(*sources), "work_sales")
    yield t

    # what groups 4-7 take from the facts alone, or from the facts and the work rows
    facts = {
        "wholesale_totals": summarise.wholesale_totals(src),
        "first_buyers": purchasing.first_buyers(ol),
        "return_totals": summarise.return_totals(src),
        "listed_items": sl.select("item_code").unionByName(work.select("item_code")).distinct(),
    }
    t.update(zip(facts, stager.cuts(facts), strict=True))


# what does not read the previous snapshot: groups 0-3 and the sums of facts that groups 4-7 read
OF_SOURCES = (
    "order_lines", "shipment_lines", "order_notes", "note_picks", "ship_hist", "warehouse_receipts", "received_a", "received_b",
    "received_c", "received", "last_proc", "received_items", "cand_ship", "cand_rcvd", "transfers", "w10", "w12", "w13", "w16", "w18",
    "upc_items", "sales_data", "online", "cross_store", "w23", "w26", "wholesale_totals", "receipt_totals",
    "listed_items", "first_buyers", "return_totals",
)


def published_groups(
    t: dict[str, DataFrame], src: Sources, prior: DataFrame, p: RollupParams, stager: Stager
) -> Iterator[dict[str, DataFrame]]:
    """Stage groups 4-7 (P27-P60) over the intermediates ``t`` of groups 0-3; yields like ``stage_groups``."""
    ol, picks, work = t["order_lines"], t["note_picks"], t["w26"]
    upc, online = t["upc_items"], t["online"]

    # 4. reorders (through the previous snapshot) and open orders
    items = t["reorder_items"] = stager.cut(pending.reorder_items(src, prior, ol), "reorder_items")
    yield t
    rcvd_pos = t["reorder_received"] = stager.cut(pending.reorder_received(src, items, p.po_width), "reorder_received")
    yield t
    again = stager.cut(pending.item_rows(src, items, listed=True), "reorder_item_rows")
    tbri = t["pend_tbri"] = pending.pending_reorders(p, again, rcvd_pos, ol)
    yield t
    known = t["listed_items"].unionByName(tbri.select("item_code"))
    new = stager.cut(pending.item_rows(src, known, listed=False), "new_item_rows")
    t["pend_pend"] = pending.pending_orders(p, new, ol)
    yield t
    pend_rows = t["pending"] = stager.cut(tbri.unionByName(t["pend_pend"]), "pending")
    work = t["w34"] = pending.append_pending(work, pend_rows)
    yield t

    # 5. last PO, notes, publisher, buyer, section, clean-up
    pos = t["pos"] = stager.cut(purchasing.po_candidates(src, work, pend_rows, ol), "po_candidates")
    yield t
    work = t["w38"] = purchasing.apply_po_notes(work, pos)
    work = t["w40"] = purchasing.fill_notes_from_last_po(work, picks)
    sources = purchasing.item_sources(src, pos, t["first_buyers"])
    joined = purchasing.set_last_po(fused_join(work, sources, "item_code"))  # P41-P48 read one join by item
    plain = lambda df: df.drop(*sources)
    t["w42"] = plain(joined)
    joined = purchasing.apply_publisher(joined, src)
    t["w43"] = plain(joined)
    joined = purchasing.fill_buyer_from_last_po(purchasing.set_buyer(joined), src)
    t["w47"] = plain(joined)
    joined = purchasing.set_section(joined)
    t["w48"] = plain(joined)
    t["w49"] = purchasing.drop_supplies(t["w48"])
    yield t
    final = purchasing.null_fills(purchasing.drop_supplies(joined))
    final, told = observed(final, master_rows=F.max("master.rows"), section_rows=F.max("sections.rows"))
    work = t["w50"] = stager.cut(plain(final), "work_final")
    if stager.enabled:
        stager.seen.update(told())
    yield t

    # 6. alias re-key, rollup, returns, wholesale, status
    work = t["w51"] = summarise.rekey_aliases(work, upc, src)
    yield t
    rollup = t["rollup0"] = stager.cut(summarise.item_rollup(work, upc), "rollup")
    returns = t["vendor_returns"] = summarise.vendor_returns(src, rollup, t["return_totals"])
    yield t
    rollup = t["rollup1"] = purchasing.drop_supplies(rollup, with_ecom=False)
    wholesale = t["wholesale"] = stager.cut(summarise.wholesale_of_items(t["wholesale_totals"], rollup), "wholesale")
    yield t
    rollup = t["rollup2"] = stager.cut(summarise.status_reset(rollup, src, wholesale), "rollup_status", rollup_rows=rows_seen())
    yield t

    # 7. publish
    t["published"] = publish.published_rollup(rollup, returns, wholesale, online, src, picks)
    yield t


def rebuild(
    src: Sources,
    prior: DataFrame | None,
    params: RollupParams,
    spark: SparkSession | None = None,
    stage: bool = True,
    sold: DataFrame | None = None,
) -> DataFrame:
    """The per-item rollup (published columns + ``pct_sold``).

    ``prior`` is the previously published snapshot (``None`` for a first run), ``sold``
    as in ``rebuild_stages``.
    """
    spark = spark or src.product.sparkSession
    prior = prior if prior is not None else empty_prior(spark)
    return rebuild_stages(src, prior, params, Stager(spark, stage), sold)["published"]


def report(rollup: DataFrame, src: Sources, params: RollupParams, ordered: bool = True) -> DataFrame:
    """The formatted report over a published rollup."""
    return publish.report(rollup, src.buyer, src.available, params.report_cutoff, ordered=ordered)


__all__ = ["rebuild", "rebuild_stages", "stage_groups", "sales_groups", "published_groups", "report", "Stager", "empty_prior", "observed", "rows_seen"]
