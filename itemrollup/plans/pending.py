"""Stage group 4 -- reorders found through the previous snapshot, and open orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank, item_key, money, number_or_zero, numeric_or_left, to_minute, ts_lit
from ..operators import current_and_archive
from ..sources import Sources
from .candidates import item_isbn, item_master, item_title
from .contracts import WORK, conform
from .lines import order_lines
from .params import REORDER_CLASS, REORDER_LOCATION, RollupParams

PENDING_COLUMNS = [f.name for f in WORK.fields]


def reorder_items(src: Sources, prior: DataFrame, ol: DataFrame | None = None) -> DataFrame:
    """Items of the previous snapshot reordered for the reorder location (class 'TTB')."""
    ol = ol if ol is not None else order_lines(src)
    od = ol.where(
        (F.col("location_no") == REORDER_LOCATION)
        & is_blank("skeleton_created_from")
        & (F.col("created_from_requisition") == 0)
        & F.col("cancel_date").isNull()
    ).select("item_code").distinct()
    od = od.join(prior.select("item_code").distinct(), "item_code", "left_semi")
    pm = src.product.where(F.col("user_class") == REORDER_CLASS).select("item_code")
    return od.join(pm, "item_code", "left_semi")


def _store_receipt_pos(header: DataFrame, line: DataFrame, items: DataFrame, oh: DataFrame, width: int) -> DataFrame:
    h = header.where(F.col("shipment_type").isin("W", "R")).select(
        "batch_id", F.right(F.col("shipment_no"), F.lit(width)).alias("po_number")
    )
    j = line.select("batch_id", "item_code").distinct().join(items, "item_code", "left_semi").join(h, "batch_id")
    return j.join(oh, "po_number", "left_semi").select("item_code", "po_number")


def _warehouse_receipt_pos(receipts: DataFrame, items: DataFrame, width: int) -> DataFrame:
    r = receipts.where(F.col("purchase_order_id").isNotNull()).select(
        item_key("item").alias("item_code"), numeric_or_left("purchase_order_id", width).alias("po_number")
    ).distinct()
    return r.join(items, "item_code", "left_semi")


def reorder_received(src: Sources, items: DataFrame, po_width: int = 6) -> DataFrame:
    """(item, PO) pairs already received for the reorder items."""
    oh = src.order_header.select("po_number")
    store = current_and_archive(
        _store_receipt_pos(src.sr_header, src.sr_line, items, oh, po_width),
        _store_receipt_pos(src.sr_header_historical, src.sr_line_historical, items, oh, po_width),
    )
    warehouse = current_and_archive(
        _warehouse_receipt_pos(src.receipt_current, items, po_width), _warehouse_receipt_pos(src.receipt_archive, items, po_width)
    )
    return store.unionByName(warehouse).distinct()


def _pending_rows(j: DataFrame, parent: str) -> DataFrame:
    return conform(
        j.select(
            to_minute("po_date").alias("first_received"),
            to_minute("po_date").alias("last_received"),
            F.col("po_number").alias("last_po"),
            "vendor_id",
            F.col("purchase_vendor_id").alias("reorder_vendor_id"),
            "item_code",
            F.lit(parent).alias("parent"),
            item_isbn(j).alias("isbn"),
            "product_type",
            F.col("buyer_id").alias("buyer"),
            "section_code",
            item_title(j).alias("title"),
            "cost",
            "price",
            number_or_zero("mfg_price").alias("msrp"),
            F.col("order_qty").alias("qty_shipped"),
            money(F.col("cost") * F.coalesce(F.col("order_qty"), F.lit(0))).alias("amt_invoiced"),
            F.col("line_scheme_id").alias("scheme_id"),
            "reorderable",
            F.substring("spec_instructions", 1, 250).alias("fob_po"),
            F.substring("special_instructions", 1, 250).alias("fob_item"),
        ),
        WORK,
    )


def item_rows(src: Sources, items: DataFrame, listed: bool) -> DataFrame:
    """The item master rows of the given items (``listed``) or of all others.

    To be stored before open order lines are joined to it: AQE splits a hot item of the lines only
    in a join whose other side is a stored table, and only where no second join by item follows.
    """
    return item_master(src).drop("scheme_id").join(items.select("item_code").distinct(), "item_code", "left_semi" if listed else "left_anti")


def pending_reorders(p: RollupParams, items: DataFrame, rcvd_pos: DataFrame, ol: DataFrame) -> DataFrame:
    """Open reorder lines of the last year not yet received ('TBRI').

    ``items`` is the stored ``item_rows`` of the reorder items, ``rcvd_pos`` the stored
    ``reorder_received``.
    """
    lines = ol.where(
        (F.col("location_no") == REORDER_LOCATION)
        & (F.col("created_from_requisition") == 0)
        & (F.coalesce(F.col("po_date"), ts_lit(p.as_of)) > ts_lit(p.one_year_ago))
        & F.col("cancel_date").isNull()
    )
    j = lines.join(items, "item_code").join(rcvd_pos.select("item_code", "po_number"), ["item_code", "po_number"], "left_anti")
    return _pending_rows(j, "TBRI")


def pending_orders(p: RollupParams, items: DataFrame, ol: DataFrame) -> DataFrame:
    """Open orders of the last 12 months for items never shipped and not yet listed ('PEND').

    Every qualifying order line gives a row; ``items`` is the stored ``item_rows`` of the items that
    are neither shipped nor listed (work rows and 'TBRI' rows).
    """
    lines = ol.where(
        (F.col("distribution_type") != "A")
        & ~F.coalesce(F.col("po_type"), F.lit("")).isin("S", "C")
        & (F.col("po_date") > ts_lit(p.one_year_ago))
        & F.col("cancel_date").isNull()
    )
    return _pending_rows(lines.join(items, "item_code"), "PEND")


def append_pending(work: DataFrame, pending: DataFrame) -> DataFrame:
    """Pending rows join the work rows without their order notes."""
    return work.unionByName(pending.withColumn("fob_po", F.lit(None).cast("string")).withColumn(
        "fob_item", F.lit(None).cast("string")
    ))
