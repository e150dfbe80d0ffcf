"""Stage group 6 -- alias re-keying, the per-item rollup, returns, wholesale and status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import MONEY, item_key, trimmed_item_key
from ..operators import FusedSource, current_and_archive, first_per_key, fused_join, group_text, keyed_update, not_in
from ..sources import Sources
from .contracts import GROUP_COLUMNS, MAX_COLUMNS, MIN_COLUMNS, ROLLUP, SUM_COLUMNS, conform
from .params import (
    RETURNS_LOCATION,
    WHOLESALE_EXCLUDED_CUSTOMERS,
    WHOLESALE_EXCLUDED_PREFIXES,
)

INHERITED = ["parent", "scheme_id", "last_received", "first_received", "buyer", "last_po", "isbn", "reorderable"]


def alias_parent_attributes(work: DataFrame, upc: DataFrame, src: Sources) -> DataFrame:
    """Per alias item: its report item and the attributes it inherits from it.

    Work attributes come from one parent work row (non-'TBRI' first, then a
    total order over the attributes); vendor ids come from the item master.
    """
    u = first_per_key(upc.select("item_code", "report_item_code"), ["item_code"], [F.col("report_item_code")])
    rows = first_per_key(
        work.select(F.col("item_code").alias("_p_item"), *[F.col(c).alias(f"_p_{c}") for c in INHERITED]),
        ["_p_item"],
        [F.col("_p_parent") == "TBRI"],
    )
    vendors = first_per_key(
        src.product.select(
            F.col("item_code").alias("_v_item"), F.col("vendor_id").alias("_v_vendor"),
            F.col("purchase_vendor_id").alias("_v_reorder_vendor"),
        ),
        ["_v_item"],
    )
    m = u.join(rows, u["report_item_code"] == rows["_p_item"], "left")
    m = m.join(vendors, m["report_item_code"] == vendors["_v_item"], "left")
    return m.drop("_p_item", "_v_item")


def rekey_aliases(work: DataFrame, upc: DataFrame, src: Sources) -> DataFrame:
    """Alias rows become rows of their report item; shipped and invoiced are zeroed."""
    m = alias_parent_attributes(work, upc, src)
    assign = {f"{c}": F.col(f"_p_{c}") for c in INHERITED}
    assign.update({
        "item_code": F.col("report_item_code"),
        "vendor_id": F.col("_v_vendor"),
        "reorder_vendor_id": F.col("_v_reorder_vendor"),
        "qty_shipped": F.lit(0),
        "amt_invoiced": F.lit(0),
    })
    return keyed_update(work, m, ["item_code"], assign)


def item_rollup(work: DataFrame, upc: DataFrame) -> DataFrame:
    """One row per item and attribute set; 'TBRI' rows pass through un-aggregated."""
    grouped = not_in(work.where(F.col("parent") != "TBRI"), "item_code", upc, "item_code")
    types = dict((f.name, f.dataType) for f in ROLLUP.fields)
    aggs = (
        [F.sum(F.coalesce(F.col(c), F.lit(0))).cast(types[c]).alias(c) for c in SUM_COLUMNS]
        + [F.max(c).alias(c) for c in MAX_COLUMNS]
        + [F.min(c).alias(c) for c in MIN_COLUMNS]
    )
    texts = [c for c in GROUP_COLUMNS if c != "item_code" and isinstance(types[c], StringType)]
    rolled = group_text(grouped, texts, aggs, by=[c for c in GROUP_COLUMNS if c not in texts])
    rolled = conform(rolled, ROLLUP)
    reorders = conform(work.where(F.col("parent") == "TBRI"), ROLLUP)
    return rolled.unionByName(reorders)


def return_totals(src: Sources) -> DataFrame:
    """Quantity returned to vendor per item."""
    lines = src.transfer.where(F.col("to_location_no") == RETURNS_LOCATION)
    return lines.groupBy("item_code").agg(F.sum("transfer_qty").alias("_qty"))


def vendor_returns(src: Sources, rollup: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Returns to vendor per item, counted once per rollup row of the item.

    Equal to joining every transfer line to every rollup row of its item and
    summing, but computed as (line total) x (row count) so a hot item never
    materialises the product of its lines and rows.  ``totals`` is ``return_totals`` where it is stored.
    """
    rows = rollup.groupBy("item_code").agg(F.count(F.lit(1)).alias("_rows"))
    lines = totals if totals is not None else return_totals(src)
    return lines.join(rows, "item_code").select("item_code", (F.col("_qty") * F.col("_rows")).alias("total_returns"))


def _wholesale_lines(header: DataFrame, line: DataFrame) -> DataFrame:
    cust = F.col("customer_number")
    h = header.where(
        (F.col("sop_type") == 3)
        & ~cust.isin(*WHOLESALE_EXCLUDED_CUSTOMERS)
        & (F.col("doc_id") == "STD")
        & (F.col("batch_source") != "Sales Void")
    )
    for prefix in WHOLESALE_EXCLUDED_PREFIXES:
        h = h.where(~cust.like(f"{prefix}%"))
    return line.select("sop_number", "item_number", "qty_to_invoice", "extended_price").join(
        h.select("sop_number"), "sop_number"
    )


def wholesale_totals(src: Sources, rollup: DataFrame | None = None) -> DataFrame:
    """Invoiced wholesale quantity and amount per *raw* item number (open + history)."""
    lines = current_and_archive(
        _wholesale_lines(src.sop_header_open, src.sop_line_open),
        _wholesale_lines(src.sop_header_history, src.sop_line_history),
    )
    per_number = lines.groupBy("item_number").agg(  # spelling by spelling first, combined map-side
        F.sum(F.coalesce(F.col("qty_to_invoice"), F.lit(0))).alias("quantity"), F.sum(F.coalesce(F.col("extended_price"), F.lit(0))).alias("extended_price"))
    totals = group_text(per_number, ["item_number"], [
        F.sum("quantity").cast("bigint").alias("quantity"), F.sum("extended_price").cast(MONEY).alias("extended_price")])
    return totals if rollup is None else wholesale_of_items(totals, rollup)


def wholesale_of_items(totals: DataFrame, rollup: DataFrame) -> DataFrame:
    """The wholesale totals of the rollup's items."""
    # the item depends on the grouping key alone: one row per raw number meets the rollup
    items = rollup.select(F.col("item_code").alias("_padded")).distinct()
    totals = totals.withColumn("_padded", trimmed_item_key("item_number")).join(items, "_padded", "left_semi")
    return totals.drop("_padded")


def status_reset(rollup: DataFrame, src: Sources, wholesale: DataFrame) -> DataFrame:
    """P57: 'RCVD' -> '' for items logged out of stock and not available, or sold wholesale."""
    oos = src.oos_item.select(item_key("item").alias("item_code"))
    oos = not_in(oos, "item_code", src.available, "item_code")
    sold = wholesale.where(F.coalesce(F.col("quantity"), F.lit(0)) > 0).select(
        trimmed_item_key("item_number").alias("item_code")
    )
    r = fused_join(rollup, {
        "_oos": FusedSource(oos, "item_code", lambda c: {}),
        "_sold": FusedSource(sold, "item_code", lambda c: {}),
    }, "item_code")
    reset = (F.col("parent") == "RCVD") & F.coalesce(F.col("_oos.hit"), F.col("_sold.hit"), F.lit(False))
    return r.withColumn("parent", F.when(reset, F.lit("")).otherwise(F.col("parent"))).drop("_oos", "_sold")


__all__ = ["rekey_aliases", "item_rollup", "vendor_returns", "wholesale_totals", "status_reset"]
