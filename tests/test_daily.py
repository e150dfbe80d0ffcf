"""Stored daily sales sums: equal to one pass over the lines, and only new days are read."""

import dataclasses
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from itemrollup.plans import SYNTHETIC
from itemrollup.plans.daily import add_days, missing_periods, totals_of_days
from itemrollup.plans.sales import _cast_measures, alias_items, sales_rekeyed_totals, sales_totals
from itemrollup.session import new_run_dir

FIRST = datetime(1998, 3, 1)
P = dataclasses.replace(SYNTHETIC, start_date=FIRST, as_of=FIRST + timedelta(days=40))


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def as_totals(days):
    return _cast_measures(days, ["item_code"])


def with_sales(src, df):
    return dataclasses.replace(src, sales_item=df)


def test_days_added_in_steps_equal_one_pass(spark, small_sources):
    folder = new_run_dir(spark, "daily-test")
    whole = sales_totals(small_sources, P)
    cut = P.start_date.date() + timedelta(days=20)
    add_days(small_sources, folder, P.start_date.date(), cut)
    with pytest.raises(ValueError, match="20 periods"):
        totals_of_days(spark, folder, P)
    # the second step sees nothing but new days
    new = small_sources.sales_item.where(F.to_date("business_date") > F.lit(cut))
    add_days(with_sales(small_sources, new), folder, cut + timedelta(days=1), P.end_date.date())
    assert missing_periods(spark, folder, P).count() == 0
    days = totals_of_days(spark, folder, P)
    assert whole.count() > 0 and same(as_totals(days), whole)
    assert "_period" in days._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    upc = alias_items(small_sources)
    none = with_sales(small_sources, small_sources.sales_item.limit(0))  # the lines are not read
    assert same(sales_rekeyed_totals(none, P, upc, per_item=days), sales_rekeyed_totals(small_sources, P, upc))


def test_a_day_added_again_is_replaced_also_by_nothing(spark, small_sources):
    folder = new_run_dir(spark, "daily-test")
    first, last = P.start_date.date(), P.end_date.date()
    add_days(small_sources, folder, first, last)
    add_days(small_sources, folder, first, last)  # a job that ran twice
    assert same(as_totals(totals_of_days(spark, folder, P)), sales_totals(small_sources, P))
    day = F.to_date("business_date") == F.lit(first + timedelta(days=3))
    fewer = with_sales(small_sources, small_sources.sales_item.where(~day))  # all lines of a day cancelled
    assert small_sources.sales_item.where(day).count() > 0
    add_days(fewer, folder, first + timedelta(days=3), first + timedelta(days=3))
    assert same(as_totals(totals_of_days(spark, folder, P)), sales_totals(fewer, P))


def test_window_ends_inside_a_day_and_undated_lines_are_in_none(spark, small_sources):
    folder = new_run_dir(spark, "daily-test")
    s = small_sources.sales_item
    edge = s.limit(200).withColumn("business_date", F.lit(P.end_date)).withColumn("quantity", F.lit(None).cast("int"))
    late = s.limit(300).withColumn("business_date", F.lit(P.end_date + timedelta(hours=1)))
    undated = s.limit(100).withColumn("business_date", F.lit(None).cast(s.schema["business_date"].dataType))
    src = with_sales(small_sources, s.select(*s.columns).unionByName(edge).unionByName(late).unionByName(undated))
    add_days(src, folder, P.start_date.date(), P.end_date.date(), "month")
    assert same(as_totals(totals_of_days(spark, folder, P, "month")), sales_totals(src, P))
    add_days(with_sales(src, s.limit(0)), folder, P.start_date.date(), P.end_date.date(), "month")
    assert totals_of_days(spark, folder, P, "month").count() == 0
