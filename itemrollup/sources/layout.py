"""Stored layout of the relations for repeated runs: facts by period, documents by bucket.

``write_layout`` stores the 32 relations once as tables of a catalog database.  A later run reads them
with ``load_layout`` and saves two costs that grow with the facts:

* Dated facts (``DATED``) are partitioned by day (or month, ``unit``).  The run's window becomes a
  partition filter, so a rebuild lists and reads the periods of its window only.
* Lines and their headers (``BUCKETED``) are bucketed and sorted on the document number they are
  joined on, so the line side of that join needs no exchange and no sort.

Key codes are normalised before they are stored; a bucket is a hash of the code, so codes that are
equal only after normalising must meet in one bucket.  A bucketed join cannot be split at run time, so
lines of which one document holds far more than a bucket's share are stored plain, with their
headers: their join is shuffled, and adaptive execution may split it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import RELATIONS, Sources, load_relations, normalised

PERIOD = "_period"

# relation -> the column of its date window; no stage reads these rows outside the window
DATED = {"sales_item": "business_date", "online_sale": "date_sold"}

# (lines, headers, document number)
BUCKETED = (
    ("order_line", "order_header", "po_number"),
    ("shipment_line", "shipment_header", "transfer_id"),
    ("sr_line", "sr_header", "batch_id"),
    ("sr_line_historical", "sr_header_historical", "batch_id"),
    ("receive_line", "receive_header", "receiver"),
)

SKEW_FACTOR = 5  # as spark.sql.adaptive.skewJoin.skewedPartitionFactor


def spread_evenly(lines: DataFrame, key: str, buckets: int) -> bool:
    """Whether no document holds over ``SKEW_FACTOR`` times an even bucket's lines (NULL numbers,
    which no join matches, count as one).  Counted with map-side combining; one row comes back."""
    per_key = lines.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most, rows = per_key.agg(F.max("n"), F.sum("n")).first()
    return rows is None or most <= max(SKEW_FACTOR * rows / buckets, 1)


def write_layout(src: Sources, database: str, root: str, buckets: int, unit: str = "day") -> dict[str, str]:
    """Store every relation as the external table ``database.<relation>`` under ``root``.

    ``buckets`` should put about 256 MB of the largest line table in a bucket; ``unit`` is 'day', or
    'month' where a day's facts are few.  Returns the layout chosen for each relation: the unit,
    'bucket' or 'plain'.  An empty relation is stored like any other.
    """
    chosen = dict.fromkeys(RELATIONS, "plain") | dict.fromkeys(DATED, unit)
    keys = {}
    for lines, headers, key in BUCKETED:
        if spread_evenly(normalised(getattr(src, lines)).select(key), key, buckets):
            for name in (lines, headers):
                chosen[name], keys[name] = "bucket", key
    for name in RELATIONS:
        df = normalised(getattr(src, name))
        if name in DATED:
            # rebalanced, not repartitioned: a hot day is split over several tasks and files
            df = df.withColumn(PERIOD, F.to_date(F.date_trunc(unit, DATED[name]))).hint("rebalance", PERIOD)
            writer = df.write.partitionBy(PERIOD)
        elif chosen[name] == "bucket":
            writer = df.repartition(buckets, keys[name]).write.bucketBy(buckets, keys[name]).sortBy(keys[name])
        else:
            writer = df.write
        writer.mode("overwrite").format("parquet").option("path", f"{root.rstrip('/')}/{name}").saveAsTable(f"{database}.{name}")
    return chosen


def load_layout(spark: SparkSession, database: str, start: datetime, end: datetime, unit: str = "day") -> Sources:
    """The relations of a stored layout for a run whose sales window is ``start`` to ``end``.

    The partition filter is a day wider at both ends, as periods were cut in the writer's time zone; the
    stages apply their exact windows.  Rows without a date are in no window and are not read.
    """

    def read(name: str) -> DataFrame:
        df = spark.table(f"{database}.{name}")
        if name not in DATED:
            return df
        first, last = (start - timedelta(days=1)).date(), (end + timedelta(days=1)).date()
        if unit == "month":
            first = first.replace(day=1)
        return df.where(F.col(PERIOD).between(F.lit(first), F.lit(last))).drop(PERIOD)

    return load_relations(read, normalise=False)
