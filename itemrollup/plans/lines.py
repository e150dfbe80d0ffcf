"""Fact lines joined to their headers once.

Every statement that reads order lines joins them to the order header on
the PO number (8 places), and shipment lines are joined to shipment headers
in 3 places.  The pipeline materialises each join once (a lineage cut) so a
large fact is shuffled once instead of once per statement; later stages scan
only the columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_present, left, text_key
from ..operators import existence_flag, group_text
from ..sources import Sources


def buyer_names(src: Sources) -> DataFrame:
    """The smallest name of every buyer id (``_buyer``, under the comparison rule)."""
    return src.buyer.groupBy(text_key("buyer_id").alias("_buyer")).agg(F.min("name").alias("buyer_name"))


def order_lines(src: Sources) -> DataFrame:
    """Order lines with header attributes and the header's buyer name (inner join: a line without
    header is never used).  Headers, not lines, meet the buyers."""
    od = src.order_line.select(
        "po_number", "item_code", "order_qty", F.col("scheme_id").alias("line_scheme_id"),
        "special_instructions", "distribution_type",
    )
    oh = src.order_header.select(
        "po_number", "po_date", "buyer_id", "location_no", "created_from_requisition",
        "skeleton_created_from", "cancel_date", "po_type", "spec_instructions", text_key("buyer_id").alias("_buyer"),
    ).join(buyer_names(src), "_buyer", "left").drop("_buyer")
    return od.join(oh, "po_number")


def shipment_lines(src: Sources) -> DataFrame:
    """Shipment lines with header locations and drop-ship flag."""
    sh = src.shipment_header.select("transfer_id", "from_location_no", "to_location_no", "drop_shipment")
    return src.shipment_line.select("transfer_id", "item_code", "qty", "date_received", "po_number").join(sh, "transfer_id")


TRANSFER_KEYS = ["from_location_no", "to_location_no", "transfer_id", "item_code"]


def flag_transfers(src: Sources, lines: DataFrame) -> DataFrame:
    """Shipment lines with ``is_transfer``: whether the line is an inventory transfer.  P02 reads those that
    are not and P11/P12 those that are, so the transfers are met once."""
    return existence_flag(lines, src.transfer, TRANSFER_KEYS, "is_transfer")


def order_notes(ol: DataFrame) -> DataFrame:
    """Distinct (item, PO, header note, line note) of the order lines with a note, at most 250 characters each.

    The one place where order lines are read for notes.  Notes that differ in case or trailing blanks
    are one note.  The lines are de-duplicated map-side, so a
    hot item or PO sends its distinct notes on, not its lines.
    """
    noted = ol.where(is_present("spec_instructions") | is_present("special_instructions")).select(
        "item_code", "po_number", left("spec_instructions", 250).alias("fob_po"), left("special_instructions", 250).alias("fob_item"))
    return group_text(noted, ["fob_po", "fob_item"], by=["item_code", "po_number"])


def note_picks(notes: DataFrame) -> DataFrame:
    """Per (item, PO): the highest (line note, header note) pair with a line note (``by_line``) and the
    highest with a header note (``by_header``); the pair's own notes are ``i`` and ``h``."""
    pair = F.struct(F.col("fob_item").alias("i"), F.col("fob_po").alias("h"))
    return notes.groupBy("item_code", "po_number").agg(
        F.max(F.when(is_present("fob_item"), pair)).alias("by_line"), F.max(F.when(is_present("fob_po"), pair)).alias("by_header"))
