"""Stage group 3 -- store, online and cross-store sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import MONEY, item_key, money, ts_lit
from ..operators import FusedSource, conditional_totals, not_in, rekey
from ..sources import Sources
from .params import RollupParams

SALES_MEASURES = [
    "extended_amt", "register_price", "qty_sold", "qty_returned", "coupons",
    "coupon_amt", "marked_down", "qty_disc", "disc_amt",
]
_MONEY_MEASURES = {"extended_amt", "register_price", "coupon_amt", "disc_amt"}


def alias_items(src: Sources) -> DataFrame:
    """Items that appear as a 'UPC...' alias of another item -> (item_code, report_item_code)."""
    aliased = src.product.where(F.col("item_alias").like("UPC%")).select(
        item_key(F.replace(F.col("item_alias"), F.lit("UPC"), F.lit(""))).alias("item_code")
    )
    pm = src.product.select("item_code").join(src.product_dist.select("item_code", "report_item_code"), "item_code")
    return pm.join(aliased, "item_code", "left_semi")


def completed_sales(src: Sources) -> DataFrame:
    """Completed store sale lines of any date."""
    return src.sales_item.where((F.col("xaction_type") == "S") & (F.col("status") == "A"))


def store_sales_lines(src: Sources, p: RollupParams) -> DataFrame:
    """Completed store sale lines in the sales window (closed at both ends)."""
    return completed_sales(src).where(
        (F.col("business_date") >= ts_lit(p.start_date)) & (F.col("business_date") <= ts_lit(p.end_date)))


def sales_measures(df: DataFrame) -> dict:
    sold = F.col("is_return") == "N"
    return {
        "extended_amt": (sold, F.col("extended_amt")),
        "register_price": (sold, F.col("register_price")),
        "qty_sold": (sold, F.col("quantity")),
        "qty_returned": (F.col("is_return") == "Y", F.col("quantity")),
        "coupons": (F.col("odpc_flag") == "C", F.col("quantity")),
        "coupon_amt": (F.col("odpc_flag") == "C", F.col("discount_amt")),
        "marked_down": (F.col("unit_price") > F.col("register_price"), F.lit(1)),
        "qty_disc": ((F.col("discount_pct") > 0) & sold, F.lit(1)),
        "disc_amt": ((F.col("discount_amt") > 0) & sold, F.col("discount_amt")),
    }


def _cast_measures(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(
        *keys,
        *[(money(c) if c in _MONEY_MEASURES else F.col(c).cast("bigint")).alias(c) for c in SALES_MEASURES],
    )


def sales_totals(src: Sources, p: RollupParams) -> DataFrame:
    """Store-sales totals per sold item code (nine measures in one pass)."""
    lines = store_sales_lines(src, p)
    return _cast_measures(conditional_totals(lines, ["item_code"], sales_measures(lines)), ["item_code"])


def sales_rekeyed_totals(
    src: Sources, p: RollupParams, upc: DataFrame, items: DataFrame | None = None, per_item: DataFrame | None = None
) -> DataFrame:
    """P20-P22 in one scan of the sales lines.

    Alias-item lines are credited to their report item; other lines count for
    their own item.  Like ``NOT IN``, a NULL alias code makes every direct line
    drop out.  ``items`` (the work items) restricts the totals after the
    aggregation, which equals restricting the direct lines first because the
    totals are only ever matched to work items.  ``per_item`` are the window's sums per sold
    item where they are known (``daily.totals_of_days``); the sale lines then are not read.
    """
    lines = store_sales_lines(src, p)
    # Pre-aggregate per sold item (partial aggregation map-side): the re-key and the
    # exclusions depend only on the item, so they apply to one row per item.
    if per_item is None:
        per_item = conditional_totals(lines, ["item_code"], sales_measures(lines))
    keyed = rekey(per_item, upc, "item_code", "item_code", "report_item_code", "_sale_key")
    upc_stats = upc.select(
        F.struct(F.count(F.lit(1)).alias("n"), F.count("item_code").alias("nn")).alias("s")
    ).scalar()
    direct_ok = (upc_stats.getField("n") == 0) | (
        (upc_stats.getField("n") == upc_stats.getField("nn")) & F.col("item_code").isNotNull()
    )
    keyed = keyed.where(F.col("_rekeyed") | direct_ok)
    totals = _cast_measures(
        keyed.groupBy(F.col("_sale_key").alias("item_code")).agg(*[F.sum(c).alias(c) for c in SALES_MEASURES]),
        ["item_code"],
    )
    if items is not None:
        totals = totals.join(items.select("item_code").distinct(), "item_code", "left_semi")
    return totals


def sales_sources(totals: DataFrame, online: DataFrame, cross: DataFrame) -> dict[str, FusedSource]:
    """The item-keyed sources of P23-P26; each has one row an item."""
    one = lambda *names: lambda c: {n: F.max(c(n)) for n in names}
    return {
        "store": FusedSource(totals, "item_code", one(*SALES_MEASURES)),
        "web": FusedSource(online.select("item_code", "online_qty_sold", "extended_amt"), "item_code", one("online_qty_sold", "extended_amt")),
        "rung": FusedSource(cross.select("item_code", "qty_sold", "extended_amt"), "item_code", one("qty_sold", "extended_amt")),
    }


def set_sales(joined: DataFrame) -> DataFrame:
    """Nine sales columns from the per-item totals."""
    named = {"qty_marked_down" if c == "marked_down" else c: c for c in SALES_MEASURES}
    return joined.withColumns({
        out: F.when(F.col("store.hit"), F.col(f"store.{c}")).otherwise(F.col(out)).cast(joined.schema[out].dataType) for out, c in named.items()})


def online_sales(src: Sources, upc: DataFrame, start, end) -> DataFrame:
    """Online marketplace sales per item: average and total price, quantity, last sale."""
    o = src.online_sale.where(
        (F.col("date_sold") >= ts_lit(start)) & (F.col("date_sold") <= ts_lit(end))
    )
    per_item = o.groupBy("item_code").agg(
        F.avg("selling_price").cast(MONEY).alias("selling_price"),
        F.sum("selling_price").cast(MONEY).alias("extended_amt"),
        F.sum("quantity").cast("bigint").alias("online_qty_sold"),
        F.max("date_sold").alias("date_sold"),
    )
    # the exclusion depends only on the grouping key, so it applies after the aggregation
    return not_in(per_item, "item_code", upc, "item_code")


def cross_store_sales(src: Sources, p: RollupParams, items: DataFrame | None = None) -> DataFrame:
    """P25: sales rung under the generic cross-store code, re-attributed to the ordered SKU.

    The sales window is half-open here ([start, end)).
    """
    heads = src.sales_header.where((F.col("status") == "A") & (F.col("xaction_type") == "S")).select(
        "location_id", "business_date", "sales_xaction_id"
    )
    rung = src.sales_item.where(
        (F.col("item_code") == p.generic_item_code)
        & (F.col("business_date") >= ts_lit(p.start_date))
        & (F.col("business_date") < ts_lit(p.end_date))
    ).select("location_id", "business_date", "sales_xaction_id", "line_number", "is_return", "quantity")
    lines = rung.join(heads, ["location_id", "business_date", "sales_xaction_id"])
    named = src.cross_order.select(
        F.col("location_id").alias("_ord_loc"),
        F.concat(F.col("till_number"), item_key("transaction_number", 9)).alias("_ord_xaction"),
        F.col("detail_number").alias("_ord_line"),
        item_key("sku").alias("_ord_item"),
        F.col("price").alias("_ord_price"),
    )
    j = lines.join(
        named,
        (lines["location_id"] == named["_ord_loc"])
        & (lines["sales_xaction_id"] == named["_ord_xaction"])
        & (lines["line_number"] == named["_ord_line"]),
    )
    pm = src.product.select(F.col("item_code"))
    j = j.join(pm, j["_ord_item"] == pm["item_code"])
    if items is not None:
        j = j.join(items.select("item_code").distinct(), "item_code", "left_semi")
    sold = F.col("is_return") == "N"
    return j.groupBy("item_code").agg(
        F.sum(F.when(sold, F.col("_ord_price")).otherwise(F.lit(0))).cast(MONEY).alias("extended_amt"),
        F.sum(F.when(sold, F.col("quantity")).otherwise(F.lit(0))).cast("bigint").alias("qty_sold"),
    )


def set_channel_sales(joined: DataFrame) -> DataFrame:
    """Add online and cross-store sales; a NULL store total stays NULL."""
    sold = F.coalesce(F.col("web.hit"), F.col("rung.hit"), F.lit(False))
    qty = F.coalesce("web.online_qty_sold", F.lit(0)) + F.coalesce("rung.qty_sold", F.lit(0))
    amount = F.coalesce("web.extended_amt", F.lit(0)) + F.coalesce("rung.extended_amt", F.lit(0))
    more = {"qty_sold": qty, "register_price": amount, "extended_amt": amount}
    return joined.withColumns({
        c: F.when(sold, F.col(c) + x).otherwise(F.col(c)).cast(joined.schema[c].dataType) for c, x in more.items()})


__all__ = [
    "alias_items", "sales_totals", "sales_rekeyed_totals", "sales_sources", "set_sales", "online_sales",
    "cross_store_sales", "set_channel_sales",
]
