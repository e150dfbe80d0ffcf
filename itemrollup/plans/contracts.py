"""Column contracts of the work frame, the published rollup and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ..functions import MONEY, RATIO

S, M, Q, T = StringType(), MONEY, LongType(), TimestampNTZType()


def _schema(cols: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


# Per-item work rows (one or more rows per item).
WORK = _schema([
    ("vendor_id", S), ("reorder_vendor_id", S), ("item_code", S), ("parent", S), ("isbn", S),
    ("product_type", S), ("buyer", S), ("section_code", S), ("title", S),
    ("cost", M), ("price", M), ("msrp", M),
    ("qty_shipped", Q), ("qty_trans", Q), ("qty_damaged", Q), ("qty_sold", Q), ("qty_returned", Q),
    ("qty_marked_down", Q), ("register_price", M), ("extended_amt", M), ("on_hand", Q), ("amt_invoiced", M),
    ("reorderable", S), ("last_po", S), ("last_received", T), ("first_received", T), ("scheme_id", S),
    ("fob_item", S), ("fob_po", S), ("publisher", S), ("author", S),
    ("coupons", Q), ("coupon_amt", M), ("qty_disc", Q), ("disc_amt", M),
])

GROUP_COLUMNS = [
    "vendor_id", "reorder_vendor_id", "item_code", "parent", "isbn", "product_type", "buyer",
    "section_code", "title", "cost", "price", "msrp", "reorderable",
]
SUM_COLUMNS = [
    "qty_shipped", "qty_trans", "qty_damaged", "qty_sold", "qty_marked_down", "qty_returned",
    "register_price", "extended_amt", "on_hand", "amt_invoiced", "coupons", "coupon_amt", "qty_disc", "disc_amt",
]
MAX_COLUMNS = ["last_po", "last_received", "scheme_id", "fob_po", "fob_item", "publisher", "author"]
MIN_COLUMNS = ["first_received"]

ROLLUP = _schema([(f.name, f.dataType) for f in WORK.fields])

# Published rollup: 40 written columns plus the computed sell-through.
PUBLISHED = _schema([
    ("vendor_id", S), ("reorder_vendor_id", S), ("item_code", S), ("parent", S), ("isbn", S),
    ("product_type", S), ("buyer", S), ("section_code", S), ("title", S),
    ("cost", M), ("price", M), ("msrp", M),
    ("qty_shipped", Q), ("qty_trans", Q), ("qty_damaged", Q), ("qty_sold", Q), ("qty_marked_down", Q),
    ("qty_returned", Q), ("qty_rtv", Q), ("register_price", M), ("extended_amt", M), ("on_hand", Q),
    ("amt_invoiced", M), ("reorderable", S), ("last_po", S), ("last_received", T), ("first_received", T),
    ("scheme_id", S), ("fob_po", S), ("fob_item", S), ("publisher", S), ("author", S),
    ("coupons", Q), ("coupon_amt", M), ("qty_disc", Q), ("disc_amt", M),
    ("txb_qty", Q), ("txb_amt", M), ("online_qty_sold", Q), ("selling_price", M),
    ("pct_sold", DoubleType()),
])

REPORT = _schema([
    ("isbn", S), ("vendor_id", S), ("reorder_vendor_id", S), ("pct_sold", RATIO), ("reorderable", S),
    ("discount_pct", RATIO), ("first_received", S), ("last_received", S), ("parent", S), ("buyer", S),
    ("section_code", S), ("title", S), ("cost", M), ("price", M), ("msrp", M),
    ("qty_shipped", Q), ("qty_trans", Q), ("qty_damaged", Q), ("qty_sold", Q), ("qty_marked_down", Q),
    ("qty_returned", Q), ("qty_rtv", Q), ("register_price", M), ("extended_amt", M), ("on_hand", Q),
    ("amt_invoiced", M), ("last_po", S), ("product_type", S), ("scheme_id", S), ("item_code", S),
    ("ttb_inv", S), ("fob_po", S), ("fob_item", S), ("publisher", S), ("author", S),
    ("coupons", Q), ("coupon_amt", M), ("qty_disc", Q), ("disc_amt", M), ("txb_qty", Q), ("txb_amt", M),
    ("online_qty_sold", Q), ("selling_price", M),
])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to ``schema``'s columns in order; missing columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


class ContractError(ValueError):
    """A key that has to be unique is not."""


# Observed while a cut is written (``Stager.cut``), so they cost no job of their own:
#   rollup, published   rows: the joins of the publish group are on unique keys, so they keep the rows
#   work_final          most rows of a work item in the item master and in the section master
OBSERVED = {
    "rollup_rows": "rows of the rollup",
    "published_rows": "rows of the published rollup",
    "master_rows": "most item master rows of an item",
    "section_rows": "most section master rows of an item",
}


def check_unique_keys(seen: dict[str, int]) -> None:
    """Raise where observed metrics show a duplicated key in the item or section master, or one in the
    wholesale, returns or online totals (it makes the published rollup longer than the rollup)."""
    wrong = [f"{OBSERVED[m]}: {seen[m]}" for m in ("master_rows", "section_rows") if (seen.get(m) or 0) > 1]
    before, after = seen.get("rollup_rows"), seen.get("published_rows")
    if before is not None and after is not None and before != after:
        wrong.append(f"{before} rollup rows became {after} published rows (several wholesale numbers of an item?)")
    if wrong:
        raise ContractError("; ".join(wrong))
