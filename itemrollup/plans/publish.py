"""Stage group 7 -- the published rollup (P58-P60) and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    MONEY,
    RATIO,
    assortment,
    discount_pct,
    initials,
    is_blank,
    is_present,
    left,
    pct_sold,
    text_key,
    title_item,
    trimmed_item_key,
    ts_lit,
    ymd,
)
from ..operators import FusedSource, first_per_key, fused_join, global_position, keyed_update
from ..sources import Sources
from .contracts import PUBLISHED, REPORT, conform
from .params import AVAILABLE_COMPANY


def published_rollup(
    rollup: DataFrame, returns: DataFrame, wholesale: DataFrame, online: DataFrame, src: Sources, picks: DataFrame
) -> DataFrame:
    """Add returns, wholesale and online columns, fill blank notes, compute sell-through.

    ``picks`` is ``lines.note_picks``.
    """
    j = fused_join(rollup, {
        "rtv": FusedSource(returns.select("item_code", "total_returns"), "item_code", lambda c: {"qty": F.max(c("total_returns"))}),
        "web": FusedSource(online.select("item_code", "online_qty_sold", "selling_price"), "item_code",
                           lambda c: {"qty": F.max(c("online_qty_sold")), "price": F.max(c("selling_price"))}),
    }, "item_code")
    # several raw item numbers may stand for one item: each gives a row
    t = wholesale.select(trimmed_item_key("item_number").alias("_t_item"), "quantity", "extended_price")
    j = j.join(t, j["item_code"] == t["_t_item"], "left")
    pub = j.select(
        *rollup.columns,
        F.coalesce("rtv.qty", F.lit(0)).alias("qty_rtv"),
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("txb_qty"),
        F.coalesce("extended_price", F.lit(0)).cast(MONEY).alias("txb_amt"),
        F.coalesce("web.qty", F.lit(0)).alias("online_qty_sold"),
        F.col("web.price").alias("selling_price"),
    )
    pub = conform(pub, PUBLISHED)
    line_notes = picks.where(F.col("by_line").isNotNull()).select(
        F.col("item_code").alias("_n_item"), F.col("po_number").alias("_n_po"), F.col("by_line.i").alias("_n_note"))
    pub = keyed_update(
        pub, line_notes, {"item_code": "_n_item", "last_po": "_n_po"}, {"fob_item": F.col("_n_note")},
        where=is_blank("fob_item"),
    )
    wanted_po = pub.where(F.col("last_po").isNotNull()).select(F.col("last_po").alias("po_number")).distinct()
    hdr_notes = first_per_key(
        src.order_header.join(wanted_po, "po_number", "left_semi").where(is_present("spec_instructions")).select(
            F.col("po_number").alias("_h_po"), left("spec_instructions", 250).alias("_h_note")
        ),
        ["_h_po"], [F.col("_h_note")], descending=True,
    )
    pub = keyed_update(pub, hdr_notes, {"last_po": "_h_po"}, {"fob_po": F.col("_h_note")}, where=is_blank("fob_po"))
    return pub.withColumn("pct_sold", pct_sold("qty_sold", "qty_shipped"))


def report_buyer(u: DataFrame) -> F.Column:
    """'Assort' for assortments, else initials of the buyer (or of the matched buyer id when blank)."""
    inner = F.when(assortment(u["item_code"]), F.lit("Assort")).otherwise(
        F.when(is_blank(u["buyer"]), initials(F.col("_b_buyer_id"))).otherwise(initials(u["buyer"]))
    )
    return F.when(inner == "..", F.lit("")).otherwise(inner)


def report_filter(u: DataFrame, cutoff) -> F.Column:
    """Recent, slow-selling or deeply discounted items; assortments need more than 19 shipped."""
    dpct = discount_pct(u["register_price"], u["qty_sold"], u["price"])
    recent = (
        (u["first_received"] > ts_lit(cutoff))
        | (u["last_received"] > ts_lit(cutoff))
        | (u["pct_sold"] < 50)
        | ((dpct - 100) >= 25)
    )
    return (assortment(u["item_code"]) & (u["qty_shipped"] > 19) & recent) | (title_item(u["item_code"]) & recent)


def report_rows(rollup: DataFrame, buyers: DataFrame, available: DataFrame, cutoff) -> DataFrame:
    """The filtered, formatted rows of the report with the values it is ordered by (``_sort_last``, ``_sort_pct``)."""
    u = rollup
    b = buyers.select(F.col("name").alias("_b_name"), F.col("buyer_id").alias("_b_buyer_id"))
    w = available.where(F.col("company") == AVAILABLE_COMPANY).select(
        F.col("item_code").alias("_w_item"), F.col("available_qty").alias("_w_qty")
    )
    j = u.join(b, text_key(u["buyer"]) == text_key(b["_b_name"]), "left").join(w, u["item_code"] == w["_w_item"], "left")
    j = j.where(report_filter(j, cutoff))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return j.select(
        "isbn", "vendor_id", "reorder_vendor_id",
        F.col("pct_sold").cast(RATIO).alias("pct_sold"),
        "reorderable",
        discount_pct("register_price", "qty_sold", "price").alias("discount_pct"),
        ymd("first_received").alias("first_received"),
        ymd("last_received").alias("last_received"),
        "parent",
        report_buyer(j).alias("buyer"),
        "section_code", "title", "cost", "price", "msrp",
        zero("qty_shipped"), zero("qty_trans"), zero("qty_damaged"), zero("qty_sold"),
        zero("qty_marked_down"), zero("qty_returned"), zero("qty_rtv"),
        "register_price",
        (F.col("qty_sold") * F.col("price")).cast(MONEY).alias("extended_amt"),
        "on_hand", "amt_invoiced", "last_po", "product_type", "scheme_id",
        F.right(F.col("item_code"), F.lit(8)).alias("item_code"),
        F.coalesce(F.col("_w_qty").cast("string"), F.lit("")).alias("ttb_inv"),
        F.coalesce("fob_po", F.lit("")).alias("fob_po"),
        F.coalesce("fob_item", F.lit("")).alias("fob_item"),
        F.coalesce("publisher", F.lit("")).alias("publisher"),
        F.coalesce("author", F.lit("")).alias("author"),
        zero("coupons"), zero("coupon_amt"), zero("qty_disc"), zero("disc_amt"), zero("txb_qty"), zero("txb_amt"),
        "online_qty_sold", "selling_price",
        F.col("last_received").alias("_sort_last"), F.col("pct_sold").alias("_sort_pct"),
    )


def report_order() -> list[F.Column]:
    """Last received, then sell-through, highest first."""
    return [F.col("_sort_last").desc_nulls_last(), F.col("_sort_pct").desc_nulls_last()]


def report(rollup: DataFrame, buyers: DataFrame, available: DataFrame, cutoff, ordered: bool = True) -> DataFrame:
    """The filtered, formatted report (43 columns) ordered by last received, then sell-through."""
    out = report_rows(rollup, buyers, available, cutoff)
    return conform(out.orderBy(*report_order()) if ordered else out, REPORT)


def positioned_report(rollup: DataFrame, buyers: DataFrame, available: DataFrame, cutoff, store) -> DataFrame:
    """The report's rows with their ``position``: T1 as a column, for readers of a stored report.

    Rows that the report's order leaves tied follow the order of their columns, NULLs first.
    ``store`` writes a frame to the shared folder and reads it back (``Stager.cut``).
    """
    rows = report_rows(rollup, buyers, available, cutoff)
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REPORT], "_sort_last", "_sort_pct")
    ties = [F.col(f.name).asc_nulls_first() for f in REPORT]
    return global_position(rows, report_order() + ties, store).drop("_sort_last", "_sort_pct")
