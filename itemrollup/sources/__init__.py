"""Inputs of the rollup: 32 base relations plus the previously published snapshot.

``Sources`` is a plain bundle of DataFrames.  ``load_tables`` reads a folder
of per-relation tables (parquet by default; any Spark format works),
``load_catalog`` the tables of a catalog database, ``load_relations`` whatever a
reader function returns (JDBC, say); all three normalise codes.
``synthetic_sources`` derives the relations from the TPC-H-like test tables.
Nothing is read until an action runs: Spark prunes columns and pushes the
stage filters into each scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .synthetic import RAW_TABLES, SPARK_VIEWS, VIEWS

RELATIONS = tuple(VIEWS)


@dataclass(frozen=True)
class Sources:
    product: DataFrame
    product_dist: DataFrame
    order_header: DataFrame
    order_line: DataFrame
    buyer: DataFrame
    location: DataFrame
    shipment_header: DataFrame
    shipment_line: DataFrame
    transfer: DataFrame
    receipt_current: DataFrame
    receipt_archive: DataFrame
    sr_header: DataFrame
    sr_header_historical: DataFrame
    sr_line: DataFrame
    sr_line_historical: DataFrame
    receive_header: DataFrame
    receive_line: DataFrame
    sales_item: DataFrame
    online_sale: DataFrame
    cross_order: DataFrame
    sales_header: DataFrame
    product_inventory: DataFrame
    isbn: DataFrame
    section: DataFrame
    base_inventory: DataFrame
    recv_items_created: DataFrame
    oos_item: DataFrame
    available: DataFrame
    sop_header_open: DataFrame
    sop_header_history: DataFrame
    sop_line_open: DataFrame
    sop_line_history: DataFrame


assert tuple(f.name for f in fields(Sources)) == RELATIONS


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in RAW_TABLES}


def synthetic_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The 32 relations derived (lazily) from the synthetic tables in ``sf_dir``."""
    raw = raw_tables(spark, sf_dir)
    return Sources(**{name: spark.sql(SPARK_VIEWS.get(name, sql), **raw) for name, sql in VIEWS.items()})


def stage_sources(src: Sources, root: str, files_per_table: int | None = None) -> Sources:
    """Write every relation once under ``root`` and return readers of the written tables.

    Used when the inputs are themselves derived (the synthetic views): each
    later read is then a plain parallel parquet scan with pushdown instead of
    a re-derivation.  ``files_per_table`` spreads small single-file inputs
    over several files so local scans run in parallel.
    """
    spark = src.product.sparkSession
    out = {}
    for name in RELATIONS:
        df = getattr(src, name)
        if files_per_table:
            df = df.repartition(files_per_table)
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return Sources(**out)


# Join keys and type codes: the original compares them without regard to case or trailing blanks.
# None but item_code and the PO number is published; every other text loses its trailing blanks alone, keeps its
# case and is compared under ``functions.TEXT_COLLATION`` where it is joined, grouped or tested.
CODE_COLUMNS = frozenset((
    "item_code", "report_item_code", "new_item_code", "item", "item_alias", "sku", "upc",
    "po_number", "purchase_order_id", "last_purchase_order", "shipment_no", "sop_number", "sales_xaction_id",
    "till_number", "transaction_number", "customer_number",
    "location_no", "from_location_no", "to_location_no", "company", "user_class", "shipment_type",
    "distribution_type", "po_type", "xaction_type", "status", "is_return", "odpc_flag", "location_type",
))


def normalised(df: DataFrame) -> DataFrame:
    """Key and type codes in upper case without trailing blanks: equal keys of the original (padded
    ``char`` columns, case-insensitive collation) become equal strings, once, at ingest, and the
    fact joins stay binary.  Other text loses its trailing blanks (the padding of ``char`` columns) and keeps its case."""

    def clean(name: str, kind: str):
        if not kind.startswith(("string", "char", "varchar")):
            return F.col(name)
        text = F.rtrim(F.col(name))
        return (F.upper(text) if name in CODE_COLUMNS else text).alias(name)

    return df.select(*[clean(name, kind) for name, kind in df.dtypes])


def load_relations(read: Callable[[str], DataFrame], normalise: bool = True) -> Sources:
    """The relations that ``read(name)`` returns, e.g. ``lambda n: spark.read.jdbc(url, n)``."""
    return Sources(**{name: normalised(read(name)) if normalise else read(name) for name in RELATIONS})


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet", normalise: bool = True) -> Sources:
    """Read ``root/<relation>`` for every relation (production layout)."""
    reader = spark.read.format(fmt)
    return load_relations(lambda name: reader.load(f"{root.rstrip('/')}/{name}"), normalise)


def load_catalog(spark: SparkSession, database: str, normalise: bool = True) -> Sources:
    """Read the table ``database.<relation>`` of the session catalog for every relation."""
    return load_relations(lambda name: spark.table(f"{database}.{name}"), normalise)
