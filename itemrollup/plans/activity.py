"""Stage group 1 -- shipment, receipt and received-date summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import item_key, to_minute, ts_lit
from ..operators import current_and_archive, not_in
from ..sources import Sources
from . import lines as fact_lines
from .lines import TRANSFER_KEYS
from .params import RollupParams


def shipment_lines(src: Sources, p: RollupParams, lines: DataFrame | None = None) -> DataFrame:
    """Shipment lines in the purchase window (inclusive of midnight after ``as_of``) with header fields."""
    lines = lines if lines is not None else fact_lines.shipment_lines(src)
    return lines.where(F.col("date_received").between(ts_lit(p.start_date), ts_lit(p.ship_end)))


def _transfers(src: Sources, lines: DataFrame, wanted: bool) -> DataFrame:
    """The lines that are inventory transfers (``wanted``) or the others; read off where they are flagged."""
    if "is_transfer" in lines.columns:
        return lines.where(F.col("is_transfer") == wanted)
    return lines.join(src.transfer.select(*TRANSFER_KEYS), TRANSFER_KEYS, "left_semi" if wanted else "left_anti")


def shipment_history(src: Sources, p: RollupParams, lines: DataFrame | None = None) -> DataFrame:
    """warehouse/consignment -> store shipments that are not inventory transfers.

    Output: (item_code, drop_ship, qty_shipped); a NULL drop-shipment flag counts as a drop ship.
    """
    lines = shipment_lines(src, p, lines)
    frm = src.location.where(F.col("location_type").isin("R", "C")).select(F.col("location_no").alias("_from_loc"))
    to = src.location.where(F.col("location_type") == "S").select(F.col("location_no").alias("_to_loc"))
    lines = lines.join(frm, lines["from_location_no"] == frm["_from_loc"]).join(to, lines["to_location_no"] == to["_to_loc"])
    not_transfers = _transfers(src, lines, False)
    drop_ship = F.when(F.col("drop_shipment") == 0, F.lit(0)).otherwise(F.lit(1))
    return not_transfers.groupBy("item_code", drop_ship.alias("drop_ship")).agg(
        F.sum(F.coalesce(F.col("qty"), F.lit(0))).alias("qty_shipped")
    )


def transfer_totals(src: Sources, p: RollupParams, lines: DataFrame | None = None) -> DataFrame:
    """P11+P12 in one pass: non-drop-ship shipment lines that *are* inventory transfers.

    ``qty_trans`` excludes the returns location, ``qty_damaged`` is the damage
    location only (so damage counts in both).  A total is NULL when the item has
    no line of that kind.
    """
    from .params import DAMAGE_LOCATION, RETURNS_LOCATION

    lines = shipment_lines(src, p, lines).where(F.col("drop_shipment") == 0)
    lines = _transfers(src, lines, True)
    qty = F.coalesce(F.col("qty"), F.lit(0))
    return lines.groupBy("item_code").agg(
        F.sum(F.when(F.col("to_location_no") != RETURNS_LOCATION, qty)).alias("qty_trans"),
        F.sum(F.when(F.col("to_location_no") == DAMAGE_LOCATION, qty)).alias("qty_damaged"),
    )


def receipt_totals(src: Sources) -> DataFrame:
    """What P03 and P05 need of the warehouse receipts, a row per (item, current or archive), in one scan of each table.

    ``qty_rcvd`` leaves out company 'SUP' (NULL without a line of another company); the dates and ``total_qty`` do not.
    """
    def per_item(receipts: DataFrame, current: bool) -> DataFrame:
        direct = F.when(F.col("company") != "SUP", F.coalesce(F.col("total_qty"), F.lit(0)))
        return receipts.groupBy(item_key("item").alias("item_code")).agg(
            F.lit(current).alias("is_current"),
            F.sum(direct).alias("qty_rcvd"),
            F.min("receipt_date").alias("first_received"),
            F.max("receipt_date").alias("last_received"),
            F.sum("total_qty").alias("total_qty"),
        )

    return per_item(src.receipt_current, True).unionByName(per_item(src.receipt_archive, False))


def warehouse_receipts(src: Sources, ship_hist: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Received quantity of items never shipped to stores (company 'SUP' excluded).

    ``totals`` is ``receipt_totals`` where it is stored.
    """
    rc = (totals if totals is not None else receipt_totals(src)).where(F.col("qty_rcvd").isNotNull())
    per_item = rc.groupBy("item_code").agg(F.sum("qty_rcvd").alias("qty_rcvd"))
    return not_in(per_item, "item_code", ship_hist, "item_code")


def _store_received(header: DataFrame, line: DataFrame) -> DataFrame:
    h = header.where(F.col("shipment_type").isin("W", "R")).select("batch_id", "shipment_type")
    return line.select("batch_id", "item_code", "process_date", "qty").join(h, "batch_id")


def received_sources(src: Sources) -> DataFrame:
    """Store receiving (archive + current): first/last date and quantity per (item, source).

    Warehouse shipments ('W') are 'SR', drop ships ('R') are 'DS'.
    """
    lines = current_and_archive(
        _store_received(src.sr_header, src.sr_line), _store_received(src.sr_header_historical, src.sr_line_historical)
    )
    parent = F.when(F.col("shipment_type") == "W", F.lit("SR")).otherwise(F.lit("DS"))
    return lines.groupBy("item_code", parent.alias("parent")).agg(
        F.min("process_date").alias("first_received"),
        F.max("process_date").alias("last_received"),
        F.coalesce(F.sum("qty"), F.lit(0)).alias("rcvd_qty"),
    )


def _receipt_branch(totals: DataFrame, current: bool, exclude: DataFrame) -> DataFrame:
    per_item = totals.where(F.col("is_current") == current).select(
        "item_code", "first_received", "last_received", F.lit(" ").alias("parent"), F.coalesce("total_qty", F.lit(0)).alias("rcvd_qty"))
    return not_in(per_item, "item_code", exclude, "item_code")


def received_union_distinct(src: Sources, received_a: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Warehouse receipts of items no store received, parent ' '.

    Each table is aggregated first and the two aggregates are combined with a
    *distinct* union, so identical (item, first, last, qty) rows collapse.  ``totals`` is
    ``receipt_totals`` where it is stored.
    """
    totals = totals if totals is not None else receipt_totals(src)
    both = _receipt_branch(totals, True, received_a).unionByName(_receipt_branch(totals, False, received_a)).distinct()
    return both.groupBy("item_code", "parent").agg(
        F.min("first_received").alias("first_received"),
        F.max("last_received").alias("last_received"),
        F.sum("rcvd_qty").alias("rcvd_qty"),
    )


def distribution_received(src: Sources, p: RollupParams, received_ab: DataFrame) -> DataFrame:
    """Distribution-centre receipts posted after the start date, parent 'DR'."""
    h = src.receive_header.where(F.col("distribution_posted_date") > ts_lit(p.start_date))
    rd = src.receive_line.select("receiver", "item_code", "qty_counted").join(
        h.select("receiver", "distribution_posted_date"), "receiver"
    )
    per_item = rd.groupBy("item_code").agg(
        F.min("distribution_posted_date").alias("first_received"),
        F.max("distribution_posted_date").alias("last_received"),
        F.lit("DR").alias("parent"),
        F.coalesce(F.sum("qty_counted"), F.lit(0)).alias("rcvd_qty"),
    )
    return not_in(per_item, "item_code", received_ab, "item_code")


RECEIVED_COLUMNS = ["item_code", "first_received", "last_received", "parent", "rcvd_qty"]


def received_per_item(rcvd: DataFrame) -> DataFrame:
    """P07 and the P13/P14 inputs in one aggregation per item.

    First/last received rounded to the minute (rounding is monotone, so rounding
    the overall min/max equals taking min/max of the per-source rounded values),
    whether a store source ('DS', 'SR', 'DR') received the item, and the total
    received quantity.
    """
    return rcvd.groupBy("item_code").agg(
        to_minute(F.min("first_received")).alias("first_rcvd"),
        to_minute(F.max("last_received")).alias("last_rcvd"),
        F.max(F.col("parent").isin("DS", "SR", "DR")).alias("store_received"),
        F.sum("rcvd_qty").alias("rcvd_qty"),
    )


def last_processed(rcvd: DataFrame) -> DataFrame:
    """Per (item, parent) first/last received, rounded to the minute."""
    return rcvd.groupBy("item_code", "parent").agg(
        to_minute(F.min("first_received")).alias("first_rcvd"),
        to_minute(F.max("last_received")).alias("last_rcvd"),
    )
