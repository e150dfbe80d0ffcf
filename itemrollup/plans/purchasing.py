"""Stage group 5 -- last PO, order notes, publisher, buyer, section and clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import assortment, is_blank, left, same_text, text_key
from ..operators import FusedSource, delete_where, first_per_key, keyed_update, not_in
from ..sources import Sources
from .lines import buyer_names, order_lines
from .params import ECOM_SCHEME, SUPPLIES_VENDOR


def po_candidates(src: Sources, work: DataFrame, pending: DataFrame, ol: DataFrame | None = None) -> DataFrame:
    """Candidate last POs per (item, header note, line note).

    (a) the highest shipped PO per item with blank notes, (b) the highest
    ordered PO per (item, notes) other than the item's (a) PO; pending POs are
    excluded from both (globally, not per item).  Lines are reduced to distinct
    (item, PO, notes) before any join, and only one row per (item, notes) meets
    the work items: a hot item is combined map-side.
    """
    sd = not_in(src.shipment_line.select("item_code", "po_number").distinct(), "po_number", pending, "last_po")
    shipped = sd.groupBy("item_code").agg(
        F.max("po_number").alias("po_number"),
        F.lit("").alias("fob_po"),
        F.lit("").alias("fob_item"),
    )
    ol = ol if ol is not None else order_lines(src)
    od = ol.where(
        is_blank("skeleton_created_from") & (F.col("created_from_requisition") == 0) & F.col("cancel_date").isNull()
    ).select(
        "po_number", "item_code", left("spec_instructions", 250).alias("fob_po"), left("special_instructions", 250).alias("fob_item")
    ).distinct()
    od = not_in(od, "po_number", pending, "last_po")
    # NOT IN the item's (a) POs, of which there is one at most: without it every PO stays, a NULL on either side removes
    top = shipped.select(F.col("item_code").alias("_a_item"), F.col("po_number").alias("_a_po"), F.lit(True).alias("_a_hit"))
    od = od.join(top, od["item_code"] == top["_a_item"], "left")
    od = od.where(F.col("_a_hit").isNull() | (F.col("po_number") != F.col("_a_po"))).drop("_a_item", "_a_po", "_a_hit")
    both = shipped.unionByName(od)
    pos = both.groupBy("item_code", "fob_po", "fob_item").agg(F.max("po_number").alias("po_number"))
    return pos.join(work.select("item_code").distinct(), "item_code", "left_semi")


def best_po(pos: DataFrame) -> DataFrame:
    """One candidate per item: highest PO, ties by header then line note (descending, NULLs last)."""
    return first_per_key(
        pos.select("item_code", "po_number", "fob_po", "fob_item"),
        ["item_code"],
        [F.col("po_number"), F.col("fob_po"), F.col("fob_item")],
        descending=True,
    )


def apply_po_notes(work: DataFrame, best: DataFrame) -> DataFrame:
    """P38 as written: ``SET FOBPO = s.FOBPO, FOBItem = s.FOBItem`` where ``s`` is the work
    row itself (the PO candidates are ``sd``), so the statement assigns every matched
    row its own values and changes nothing.  Kept as an explicit no-op."""
    del best
    return work


def item_sources(src: Sources, pos: DataFrame, choices: DataFrame) -> dict[str, FusedSource]:
    """The item-keyed sources of P41-P48: candidate POs, item master, buyer choices, section master.

    The row that counts per item is a ``max`` or ``min`` over a struct.  ``best`` is the highest candidate
    PO, ties by header then line note; ``choices`` is ``first_buyers``.
    """
    product = src.product.select("item_code", "last_purchase_order")
    section = src.section.select("item_code", F.upper(F.coalesce(F.col("section_code"), F.lit("NONE"))).alias("section"))
    return {
        "best": FusedSource(pos, "item_code", lambda c: {"po": F.max(F.struct(c("po_number"), c("fob_po"), c("fob_item"))).getField("po_number")}),
        "master": FusedSource(product, "item_code", lambda c: {"last_po": F.max(c("last_purchase_order")), "rows": F.count(c("item_code"))}),
        "ordered": FusedSource(choices, "item_code", lambda c: {"buyer": chosen_buyer(F.min(c("choice")))}),
        "sections": FusedSource(section, "item_code", lambda c: {"section": F.max(c("section")), "rows": F.count(c("item_code"))}),
    }


def fill_notes_from_last_po(work: DataFrame, picks: DataFrame) -> DataFrame:
    """P39 then P40: when a note is blank, take both notes from the row's last PO line.

    P39 needs a line note, P40 a header note; the second reads the first's result.  ``picks`` is
    ``lines.note_picks``: several order lines of one (PO, item) resolve to the highest notes.
    """
    picks = picks.select(F.col("item_code").alias("_n_item"), F.col("po_number").alias("_n_po"), F.col("by_line").alias("_by_line"), F.col("by_header").alias("_by_header"))
    j = work.join(picks, (work["item_code"] == picks["_n_item"]) & (work["last_po"] == picks["_n_po"]), "left")
    for pick, blank in (("_by_line", "fob_item"), ("_by_header", "fob_po")):
        hit = F.col(pick).isNotNull() & is_blank(blank)
        j = j.withColumns({
            "fob_item": F.when(hit, F.col(f"{pick}.i")).otherwise(F.col("fob_item")),
            "fob_po": F.when(hit, F.col(f"{pick}.h")).otherwise(F.col("fob_po")),
        })
    return j.select(*work.columns)


def set_last_po(joined: DataFrame) -> DataFrame:
    """Last PO from the candidates (not for 'TBRI' rows), then the item master's
    last purchase order for assortments and rows still without one."""
    named = F.coalesce(F.col("best.hit"), F.lit(False)) & F.coalesce(F.col("parent") != "TBRI", F.lit(False))
    w = joined.withColumn("last_po", F.when(named, F.col("best.po")).otherwise(F.col("last_po")))
    again = F.coalesce(F.col("master.hit"), F.lit(False)) & (F.coalesce(assortment("item_code"), F.lit(False)) | F.col("last_po").isNull())
    return w.withColumn("last_po", F.when(again, F.col("master.last_po")).otherwise(F.col("last_po")))


def apply_publisher(work: DataFrame, src: Sources) -> DataFrame:
    """Publisher and author by ISBN (first 250 characters)."""
    i = first_per_key(
        src.isbn.select(
            text_key("isbn").alias("_i_isbn"),
            left("publisher_name", 250).alias("_i_pub"),
            left("author", 250).alias("_i_author"),
        ),
        ["_i_isbn"],
        [F.col("_i_pub"), F.col("_i_author")],
        descending=True,
    )
    keyed = work.withColumn("_isbn_key", text_key("isbn"))
    keyed = keyed_update(keyed, i, {"_isbn_key": "_i_isbn"}, {"publisher": F.col("_i_pub"), "author": F.col("_i_author")})
    return keyed.drop("_isbn_key")


def buyer_choice() -> Column:
    """What orders an item's lines when its buyer is chosen: the earliest PO date (NULL last), then the
    lowest PO, then the smallest buyer name.  Only the least counts, so it is a partial aggregate."""
    return F.struct(F.col("po_date").isNull().alias("no_date"), "po_date", "po_number", F.col("buyer_name").isNull().alias("no_name"), "buyer_name")


def chosen_buyer(choice: Column) -> Column:
    """' ' (filled later from the last PO) where the chosen PO has no date or no matching buyer."""
    return F.when(choice.getField("no_date") | choice.getField("no_name"), F.lit(" ")).otherwise(choice.getField("buyer_name"))


def first_buyers(ol: DataFrame) -> DataFrame:
    """Per item the least ``buyer_choice`` of its order lines."""
    return ol.groupBy("item_code").agg(F.min(buyer_choice()).alias("choice"))


def original_buyer(work: DataFrame, ol: DataFrame) -> DataFrame:
    """P44-P46 alone: (item_code, po_date, po_number, buyer) of the work items.

    The buyer of an item's earliest PO; of the PO's headers with that date, the smallest name.
    """
    best = first_buyers(ol).select("item_code", "choice.po_date", "choice.po_number", chosen_buyer(F.col("choice")).alias("buyer"))
    return best.join(work.select("item_code").distinct(), "item_code", "left_semi")


def set_buyer(joined: DataFrame) -> DataFrame:
    """The original buyer."""
    return joined.withColumn("buyer", F.when(F.col("ordered.hit"), F.col("ordered.buyer")).otherwise(F.col("buyer")))


def fill_buyer_from_last_po(work: DataFrame, src: Sources) -> DataFrame:
    """The last PO's buyer where the buyer is still blank."""
    po_buyer = src.order_header.select("po_number", text_key("buyer_id").alias("_buyer")).join(buyer_names(src), "_buyer")
    po_buyer = po_buyer.groupBy(F.col("po_number").alias("_pb_po")).agg(F.min("buyer_name").alias("_pb_name"))
    return keyed_update(work, po_buyer, {"last_po": "_pb_po"}, {"buyer": F.col("_pb_name")}, where=is_blank("buyer"))


def set_section(joined: DataFrame) -> DataFrame:
    """Section code from the section master (upper case, 'NONE' when NULL)."""
    return joined.withColumn("section_code", F.when(F.col("sections.hit"), F.col("sections.section")).otherwise(F.col("section_code")))


def drop_supplies(work: DataFrame, with_ecom: bool = True) -> DataFrame:
    """Remove supplies vendors (and the e-commerce scheme)."""
    pred = same_text("vendor_id", SUPPLIES_VENDOR) | same_text("reorder_vendor_id", SUPPLIES_VENDOR)
    if with_ecom:
        pred = pred | same_text("scheme_id", ECOM_SCHEME)
    return delete_where(work, pred)


def null_fills(work: DataFrame) -> DataFrame:
    """P50: NULL -> default, and no invoiced amount without a PO."""
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(work.schema[c].dataType)) for c in [
        "qty_returned", "qty_sold", "register_price", "extended_amt", "qty_trans", "on_hand",
        "qty_disc", "disc_amt", "coupons", "coupon_amt", "qty_damaged", "qty_marked_down",
    ]}
    zero["parent"] = F.coalesce(F.col("parent"), F.lit(""))
    zero["buyer"] = F.coalesce(F.col("buyer"), F.lit(""))
    zero["amt_invoiced"] = F.when(is_blank("last_po"), F.lit(0).cast(work.schema["amt_invoiced"].dataType)).otherwise(
        F.col("amt_invoiced")
    )
    return work.withColumns(zero)
