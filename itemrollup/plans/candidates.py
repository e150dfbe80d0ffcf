"""Stage group 2 -- candidate items and their quantities/status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import equals_blank, money, number_or_zero, same_text, ts_lit
from ..operators import FusedSource, delete_where, not_in
from ..sources import Sources
from .contracts import WORK, conform
from .params import BASE_INVENTORY_SCHEME, SUPPLIES_VENDOR, RollupParams


def item_master(src: Sources) -> DataFrame:
    """Item master joined to its distribution record."""
    pmd = src.product_dist.select("item_code", "upc", "scheme_id")
    return src.product.join(pmd, "item_code")


def item_isbn(pm: DataFrame) -> Column:
    """ISBN, falling back to the first 13 characters of the UPC when blank (NULL stays NULL)."""
    return F.when(F.trim(pm["isbn"]) == "", F.substring(pm["upc"], 1, 13)).otherwise(pm["isbn"])


def item_title(pm: DataFrame) -> Column:
    return F.when(equals_blank(pm["title"]), pm["description"]).otherwise(pm["title"])


SHIPPED, RECEIVED = "S", "R"


def _candidates(pm: DataFrame, qty: DataFrame, rcvd_items: DataFrame, notes: DataFrame, p: RollupParams) -> DataFrame:
    """Candidate rows for every (item master row, quantity row) pair of the window.

    ``rcvd_items`` has one row an item (``activity.received_per_item``), ``notes`` the distinct order
    notes (``lines.order_notes``).  ``qty`` holds (``_qty_item``, ``qty``, ``_kind``); the kind decides the status:
    'SHIP' for shipped items, ' ' / 'RCVD' (reorderable or not) for received ones.
    """
    j = pm.join(qty, pm["item_code"] == qty["_qty_item"])
    dates = rcvd_items.select(F.col("item_code").alias("_rcv_item"), F.col("first_rcvd").alias("first_received"), F.col("last_rcvd").alias("last_received"))
    j = j.join(dates, j["item_code"] == dates["_rcv_item"], "left")
    notes = notes.select(F.col("item_code").alias("_note_item"), F.col("po_number").alias("_note_po"), "fob_po", "fob_item")
    j = j.join(
        notes, (j["item_code"] == notes["_note_item"]) & (j["last_purchase_order"] == notes["_note_po"]), "left"
    )
    window = lambda c: c.between(ts_lit(p.start_date), ts_lit(p.end_date))
    j = j.where(window(F.col("create_date")) | same_text("reorderable", "Y") | window(F.col("last_received")))
    parent = F.when(F.col("_kind") == SHIPPED, F.lit("SHIP")).otherwise(
        F.when(same_text("reorderable", "Y"), F.lit(" ")).otherwise(F.lit("RCVD"))
    )
    out = j.select(
        F.col("vendor_id"),
        F.col("purchase_vendor_id").alias("reorder_vendor_id"),
        F.col("item_code"),
        parent.alias("parent"),
        item_isbn(j).alias("isbn"),
        "product_type",
        "section_code",
        item_title(j).alias("title"),
        "cost",
        "price",
        number_or_zero("mfg_price").alias("msrp"),
        F.col("qty").alias("qty_shipped"),
        money(F.col("cost") * F.coalesce(F.col("qty"), F.lit(0))).alias("amt_invoiced"),
        "scheme_id",
        "reorderable",
        "last_received",
        "first_received",
        "fob_po",
        "fob_item",
        "_kind",
    )
    return out


def _shipped_qty(src: Sources, ship_hist: DataFrame) -> DataFrame:
    """Shipped quantity per item, minus items replaced through receiving re-coding (both NOT INs)."""
    ship = ship_hist.groupBy(F.col("item_code").alias("_qty_item")).agg(F.sum("qty_shipped").alias("qty"))
    # x NOT IN (A) AND x NOT IN (B) is exactly x NOT IN (A UNION ALL B) in three-valued logic
    recoded = src.recv_items_created.select(F.col("new_item_code").alias("_code")).unionByName(
        src.recv_items_created.select(F.col("item_code").alias("_code"))
    )
    ship = not_in(ship, "_qty_item", recoded, "_code")
    return ship.withColumn("_kind", F.lit(SHIPPED))


def _received_qty(wh_receipts: DataFrame) -> DataFrame:
    return wh_receipts.select(
        F.col("item_code").alias("_qty_item"), F.col("qty_rcvd").alias("qty"), F.lit(RECEIVED).alias("_kind")
    )


def candidates(
    src: Sources, p: RollupParams, ship_hist: DataFrame, wh_receipts: DataFrame, rcvd_items: DataFrame, notes: DataFrame,
) -> DataFrame:
    """P08 + P09 in one pass over the item master, received dates and order notes.

    The two statements differ only in their quantity source and status, so
    their quantity rows are unioned (tagged ``_kind``) and joined once.  The
    re-coding exclusions of P08 test the item master key, which equals the
    shipped item key, so they filter the shipped quantities instead.
    """
    qty = _shipped_qty(src, ship_hist).unionByName(_received_qty(wh_receipts))
    return _candidates(item_master(src), qty, rcvd_items, notes, p)


def work_rows(cands: DataFrame) -> DataFrame:
    return conform(cands, WORK)


def activity_sources(src: Sources, transfers: DataFrame, ship_hist: DataFrame, rcvd_items: DataFrame) -> dict[str, FusedSource]:
    """The item-keyed sources of P10-P17: base inventory, transfers, drop ships, receipts and stock.

    ``rcvd_items`` is ``activity.received_per_item`` and ``transfers`` has one row an item; the shares of
    a warehouse's stock are summed where they meet.
    """
    one = lambda *names: lambda c: {n: F.max(c(n)) for n in names}  # noqa: E731  (one row a key)
    stock = src.product_inventory.select("item_code", F.coalesce(F.col("quantity_on_hand"), F.lit(0)).alias("quantity"))
    return {
        "base": FusedSource(src.base_inventory.select("item_code"), "item_code", lambda c: {}),
        "moved": FusedSource(transfers.select("item_code", "qty_trans", "qty_damaged"), "item_code", one("qty_trans", "qty_damaged")),
        "dropped": FusedSource(ship_hist.where(F.col("drop_ship") == 1).select("item_code"), "item_code", lambda c: {}),
        "rcvd": FusedSource(rcvd_items, "item_code", one("rcvd_qty", "store_received", "first_rcvd", "last_rcvd")),
        "stock": FusedSource(stock, "item_code", lambda c: {"on_hand": F.sum(c("quantity"))}),
    }


def _hit(source: str) -> Column:
    return F.coalesce(F.col(f"{source}.hit"), F.lit(False))


def drop_base_inventory(joined: DataFrame) -> DataFrame:
    """P10: remove base-inventory items and supplies."""
    return delete_where(joined, _hit("base") | same_text("scheme_id", BASE_INVENTORY_SCHEME)
                        | same_text("vendor_id", SUPPLIES_VENDOR) | same_text("reorder_vendor_id", SUPPLIES_VENDOR))


def set_transfers(joined: DataFrame) -> DataFrame:
    """Transfer and damage quantities; a kind without a line keeps the value."""
    return joined.withColumns({c: F.coalesce(F.col(f"moved.{c}"), F.col(c)) for c in ("qty_trans", "qty_damaged")})


def set_drop_ship_received(joined: DataFrame) -> DataFrame:
    """Items with any drop-ship shipment take their store-received quantity as shipped."""
    takes = _hit("dropped") & _hit("rcvd") & F.coalesce(F.trim(F.col("parent")).isin("DS", "SHIP"), F.lit(False))
    return joined.withColumn("qty_shipped", F.when(takes, F.col("rcvd.rcvd_qty")).otherwise(F.col("qty_shipped")).cast("bigint"))


def set_received_status(joined: DataFrame) -> DataFrame:
    """Received status and dates, then the never-received statuses."""
    w = joined.withColumns({
        "parent": F.when(F.col("rcvd.store_received"), F.lit(" ")).otherwise(F.col("parent")),
        "last_received": F.when(_hit("rcvd"), F.col("rcvd.last_rcvd")).otherwise(F.col("last_received")),
        "first_received": F.when(_hit("rcvd"), F.col("rcvd.first_rcvd")).otherwise(F.col("first_received")),
    })
    never = F.col("last_received").isNull()
    blank = never & (same_text("reorderable", "N") | (F.col("qty_shipped") == 0))
    w = w.withColumn("parent", F.when(F.coalesce(blank, F.lit(False)), F.lit(" ")).otherwise(F.col("parent")))
    srpr = never & same_text("reorderable", "Y") & (F.col("qty_shipped") > 0)
    return w.withColumn("parent", F.when(F.coalesce(srpr, F.lit(False)), F.lit("SRPR")).otherwise(F.col("parent")))


def set_on_hand(joined: DataFrame) -> DataFrame:
    """On-hand update, then NULL -> 0 for transfers and on hand."""
    stock = F.when(_hit("stock"), F.col("stock.on_hand")).otherwise(F.col("on_hand")).cast("bigint")
    return joined.withColumns({
        "qty_trans": F.coalesce(F.col("qty_trans"), F.lit(0).cast("bigint")),
        "on_hand": F.coalesce(stock, F.lit(0).cast("bigint")),
    })


__all__ = [
    "item_master", "candidates", "work_rows", "activity_sources", "drop_base_inventory",
    "set_transfers", "set_drop_ship_received", "set_received_status", "set_on_hand",
]
