"""The stored layout: day partitions and document buckets give the same rollup from less work."""

import dataclasses
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from conftest import SF_SMALL


def frame(spark, like, data):
    """Rows of ``like``'s columns, every one of them nullable."""
    schema = StructType([StructField(f.name, f.dataType) for f in like.schema])
    return spark.createDataFrame([tuple(d.get(n) for n in like.columns) for d in data], schema)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layout(spark, small_sources):
    from itemrollup.session import new_run_dir
    from itemrollup.sources.layout import write_layout

    name = f"layout_{uuid.uuid4().hex[:8]}"
    root = new_run_dir(spark, "layout-test")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/db'")
    chosen = write_layout(small_sources, name, root, buckets=4, unit="month")
    yield name, chosen
    spark.sql(f"DROP DATABASE {name} CASCADE")


def loaded(spark, layout, p):
    from itemrollup.sources.layout import load_layout

    return load_layout(spark, layout[0], p.start_date, p.end_date, "month")


def test_layout_gives_the_same_rollup(spark, layout):
    from itemrollup.plans import SYNTHETIC, rebuild
    from itemrollup.queries import run

    a = run(spark, SF_SMALL)
    b = rebuild(loaded(spark, layout, SYNTHETIC), None, SYNTHETIC)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_window_becomes_a_partition_filter_and_reads_fewer_files(spark, small_sources, layout):
    from itemrollup.plans import SYNTHETIC
    from itemrollup.plans.sales import online_sales, alias_items, sales_totals

    p = dataclasses.replace(SYNTHETIC, start_date=SYNTHETIC.end_date.replace(year=1998))
    src = loaded(spark, layout, p)
    totals = sales_totals(src, p)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(totals))
    assert any("_period" in f for f in filters)
    files = spark.table(f"{layout[0]}.sales_item")
    read = files.where(F.col("_period") >= F.lit(p.start_date.date().replace(day=1))).select(F.input_file_name()).distinct().count()
    assert 0 < read < files.select(F.input_file_name()).distinct().count()
    want = sales_totals(small_sources, p)
    assert totals.count() > 0 and totals.exceptAll(want).count() == want.exceptAll(totals).count() == 0
    got = online_sales(src, alias_items(src), p.start_date, p.end_date)
    want = online_sales(small_sources, alias_items(small_sources), p.start_date, p.end_date)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_lines_meet_their_headers_without_an_exchange(spark, layout):
    from itemrollup.plans import SYNTHETIC
    from itemrollup.plans.activity import _store_received
    from itemrollup.plans.lines import order_lines, shipment_lines

    src = loaded(spark, layout, SYNTHETIC)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as with headers too large to broadcast
    try:
        for joined in (shipment_lines(src), _store_received(src.sr_header, src.sr_line)):
            text = plan(joined)
            assert "SortMergeJoin" in text and "Exchange" not in text
        # the headers meet the buyers first, so they alone are moved; the lines are read in place
        text = plan(order_lines(src))
        below = text[text.rindex("Exchange hashpartitioning(po_number"):] if "Exchange hashpartitioning(po_number" in text else ""
        assert "Bucketed: true" in text
        assert text.count("Exchange hashpartitioning(po_number") <= 1 and "special_instructions" not in below
    finally:
        spark.conf.set(key, old)


def test_a_hot_document_is_stored_plain(spark, small_sources, layout):
    from itemrollup.sources.layout import spread_evenly

    assert {layout[1][n] for n in ("order_line", "order_header", "shipment_line", "receive_line")} == {"bucket"}
    assert layout[1]["sales_item"] == "month" and layout[1]["product"] == "plain"
    lines = small_sources.order_line.select("po_number")
    hot = lines.unionByName(lines.select(F.lit("HOT").alias("po_number")))
    assert spread_evenly(lines, "po_number", 64) and not spread_evenly(hot, "po_number", 64)
    assert spread_evenly(lines.limit(0), "po_number", 64)


def test_padded_keys_meet_in_one_bucket_and_undated_rows_are_in_no_window(spark, small_sources):
    from itemrollup.plans import SYNTHETIC
    from itemrollup.plans.lines import shipment_lines
    from itemrollup.plans.sales import store_sales_lines
    from itemrollup.session import new_run_dir
    from itemrollup.sources.layout import load_layout, write_layout

    some = {n: getattr(small_sources, n).limit(0) for n in small_sources.__dataclass_fields__}
    some["order_header"] = frame(spark, small_sources.order_header, [{"po_number": "ab1"}])
    some["order_line"] = frame(spark, small_sources.order_line, [{"po_number": "AB1  ", "item_code": "x"}, {"po_number": None}])
    day = SYNTHETIC.start_date
    some["sales_item"] = frame(spark, small_sources.sales_item, [
        {"item_code": "A", "xaction_type": "S", "status": "A", "business_date": d}
        for d in (None, day, SYNTHETIC.end_date, SYNTHETIC.end_date.replace(hour=1), day.replace(year=1990))])
    src = dataclasses.replace(small_sources, **some)
    name, root = f"layout_{uuid.uuid4().hex[:8]}", new_run_dir(spark, "layout-test")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/db'")
    try:
        write_layout(src, name, root, buckets=4, unit="month")
        got = load_layout(spark, name, SYNTHETIC.start_date, SYNTHETIC.end_date, "month")
        assert got.order_line.join(got.order_header, "po_number").count() == 1
        assert shipment_lines(got).count() == 0
        kept = sorted(r.business_date for r in store_sales_lines(got, SYNTHETIC).select("business_date").collect())
        assert kept == [day, SYNTHETIC.end_date]
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
