"""Store-sales totals kept per item and business date, so that a rebuild reads new days only.

The nine sales measures are sums, so they merge: ``add_days`` aggregates the sale lines of a range of days
and stores a row per (item, business date), partitioned by day (or month, ``unit``); ``totals_of_days`` adds up
the stored rows of a run's window.  A period is replaced whole when it is added again (late, corrected or
cancelled lines, or a job that was run twice), and no other period is touched.  Every added period holds a
marker row without a date, also where it has no line; ``missing_periods`` finds those never added.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ts_lit
from ..operators import conditional_totals
from ..sources import Sources
from .params import RollupParams
from .sales import SALES_MEASURES, completed_sales, sales_measures

PERIOD = "_period"


def whole_periods(first: date, last: date, unit: str) -> tuple[date, date]:
    """The first day of ``first``'s period and the first day after ``last``'s."""
    if unit == "day":
        return first, last + timedelta(days=1)
    return first.replace(day=1), (last.replace(day=1) + timedelta(days=31)).replace(day=1)


def _periods(spark: SparkSession, start: date, stop: date, unit: str) -> DataFrame:
    days = F.sequence(F.lit(start), F.lit(stop - timedelta(days=1)), F.expr(f"INTERVAL 1 {unit}"))
    return spark.range(1).select(F.explode(days).alias(PERIOD))


def daily_sales(src: Sources, start: date, stop: date, unit: str = "day") -> DataFrame:
    """A row per (item, business date) of the completed sale lines from ``start`` until before ``stop``.

    The exact business date stays a key, so a window may end inside a day.  Lines without a date are
    in no window.  Partial sums leave the map tasks: a hot item moves a row a date and task.
    """
    at = lambda d: ts_lit(datetime.combine(d, time()))
    lines = completed_sales(src).where((F.col("business_date") >= at(start)) & (F.col("business_date") < at(stop)))
    sums = conditional_totals(lines, ["item_code", "business_date"], sales_measures(lines))
    return sums.withColumn(PERIOD, F.to_date(F.date_trunc(unit, "business_date")))


def add_days(src: Sources, folder: str, first: date, last: date, unit: str = "day") -> None:
    """Store the days ``first`` to ``last`` (their whole periods) under ``folder``, in place of what is there."""
    start, stop = whole_periods(first, last, unit)
    marks = _periods(src.product.sparkSession, start, stop, unit)
    rows = daily_sales(src, start, stop, unit).unionByName(marks, allowMissingColumns=True).hint("rebalance", PERIOD)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(folder)


def missing_periods(spark: SparkSession, folder: str, p: RollupParams, unit: str = "day") -> DataFrame:
    """The periods of the run's sales window that were never added."""
    start, stop = whole_periods(p.start_date.date(), p.end_date.date(), unit)
    held = spark.read.parquet(folder).where(F.col("business_date").isNull()).select(PERIOD)
    return _periods(spark, start, stop, unit).join(held, PERIOD, "left_anti")


def totals_of_days(spark: SparkSession, folder: str, p: RollupParams, unit: str = "day") -> DataFrame:
    """Per sold item the sums of the run's sales window (closed at both ends), as over its lines.

    The window is a partition filter.  A window with a period that was never added is an error.
    """
    gap = missing_periods(spark, folder, p, unit).agg(F.count(F.lit(1)), F.min(PERIOD)).first()
    if gap[0]:
        raise ValueError(f"{gap[0]} periods of the sales window are not stored, the first is {gap[1]}")
    start, stop = whole_periods(p.start_date.date(), p.end_date.date(), unit)
    rows = spark.read.parquet(folder).where(
        (F.col(PERIOD) >= F.lit(start)) & (F.col(PERIOD) < F.lit(stop))
        & F.col("business_date").between(ts_lit(p.start_date), ts_lit(p.end_date)))
    return rows.groupBy("item_code").agg(*[F.sum(c).alias(c) for c in SALES_MEASURES])
