"""Runs behind the stage queries: each cut is paid for once, and only by the queries that need it."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from itemrollup import queries
from itemrollup.plans import pipeline


@pytest.fixture()
def cuts(monkeypatch):
    """Names of the cuts written while a test runs; runs of other tests are put aside."""
    names, cut = [], pipeline.Stager.cut
    monkeypatch.setattr(pipeline.Stager, "cut", lambda self, df, name, **m: (names.append(name), cut(self, df, name, **m))[1])
    monkeypatch.setattr(queries, "_RUNS", {})
    return names


def test_second_run_reads_the_first_ones_cuts_of_the_sources(spark, cuts):
    """Groups 0-3 do not read the previous snapshot: the second run adds the later groups only."""
    queries.run(spark, SF_SMALL)
    first = list(cuts)
    assert len(first) == len(set(first)) and {"order_lines", "work_sales", "published"} <= set(first)
    queries.run(spark, SF_SMALL, True, "reorder_items")
    assert cuts[len(first):] == ["reorder_items"]
    queries.run(spark, SF_SMALL, True)
    assert cuts[len(first):] == [name for name in first[first.index("reorder_items"):] if name != "wholesale_totals"]


def test_second_run_reads_no_fact_that_the_first_one_summed_up(spark, monkeypatch):
    """Buyers, vendor returns and listed items do not depend on the previous snapshot: the second run reads their sums."""
    read, cut = {}, pipeline.Stager.cut
    monkeypatch.setattr(pipeline.Stager, "cut", lambda self, df, name, **m: (read.update({name: " ".join(df.inputFiles())}), cut(self, df, name, **m))[1])
    monkeypatch.setattr(queries, "_RUNS", {})
    queries.run(spark, SF_SMALL)
    assert "/order_lines/" in read["first_buyers"] and "lineitem.parquet" in read["return_totals"]
    read.clear()
    queries.run(spark, SF_SMALL, True)
    assert "/first_buyers/" in read["work_final"] and "/order_lines/" not in read["work_final"]
    assert "/listed_items/" in read["new_item_rows"] and "/shipment_lines/" not in read["new_item_rows"]
    assert "/return_totals/" in read["published"] and "lineitem.parquet" not in read["published"]


def test_cuts_without_a_common_frame_are_written_side_by_side(spark, monkeypatch):
    """Two cuts that wait for each other end only if both run; job properties go with them, and an error comes back."""
    import threading

    meet, cut, seen = threading.Barrier(2, timeout=60), pipeline.Stager.cut, {}

    def waiting(self, df, name, **metrics):
        meet.wait()
        seen[name] = spark.sparkContext.getLocalProperty("run.of")
        return cut(self, df, name, **metrics)

    monkeypatch.setattr(pipeline.Stager, "cut", waiting)
    stager = pipeline.Stager(spark, True)
    spark.sparkContext.setLocalProperty("run.of", "test")
    try:
        one, two = stager.cuts({"one": spark.range(3), "two": spark.range(5)})
    finally:
        spark.sparkContext.setLocalProperty("run.of", None)
    assert (one.count(), two.count()) == (3, 5) and seen == {"one": "test", "two": "test"}
    assert all(f"{stager.root}/{name}/" in df.inputFiles()[0] for name, df in (("one", one), ("two", two)))
    monkeypatch.setattr(pipeline.Stager, "cut", lambda self, df, name, **m: 1 / 0 if name == "bad" else cut(self, df, name, **m))
    with pytest.raises(ZeroDivisionError):
        stager.cuts({"good": spark.range(3), "bad": spark.range(5)})
    stager.close()


def test_receipts_are_summed_once_for_both_statements(spark, small_sources):
    """P03 and P05 from one pass over each receipts table, with NULL companies, quantities, dates and items."""
    from dataclasses import replace
    from datetime import datetime

    from itemrollup.functions import item_key
    from itemrollup.plans import activity

    day = lambda n: datetime(2000, 1, n)
    rows = lambda *r: spark.createDataFrame(list(r), "item string, company string, total_qty int, receipt_date timestamp_ntz")
    now = rows(("1", "CDC", 5, day(3)), ("1", "SUP", 7, day(1)), ("2", "SUP", 1, day(2)), ("3", None, 4, None), ("4", "CDC", None, day(5)), (None, "CDC", 9, day(1)))
    then = rows(("1", "CDC", 2, day(2)), ("4", "CDC", None, day(5)), ("5", "CDC", 3, day(9)))
    src = replace(small_sources, receipt_current=now, receipt_archive=then)
    code = lambda n: n and n.rjust(20, "0")
    stored = activity.receipt_totals(src).localCheckpoint()
    none = spark.createDataFrame([], "item_code string")
    for totals in (None, stored):
        got = {r.item_code: r.qty_rcvd for r in activity.warehouse_receipts(src, none, totals).collect()}
        assert got == {code("1"): 7, code("4"): 0, code("5"): 3, None: 9}
        shipped = spark.createDataFrame([(code("1"),)], "item_code string")
        assert {r.item_code for r in activity.warehouse_receipts(src, shipped, totals).collect()} == {code("4"), code("5")}
        got = {r.item_code: (r.first_received, r.last_received, r.rcvd_qty) for r in activity.received_union_distinct(src, shipped, totals).collect()}
        assert got == {code("2"): (day(2), day(2), 1), code("3"): (None, None, 4), code("4"): (day(5), day(5), 0), code("5"): (day(9), day(9), 3)}
    lines = now.unionByName(then).where("company <> 'SUP'").groupBy(item_key("item").alias("item_code")).agg(F.sum(F.coalesce("total_qty", F.lit(0))).alias("q"))
    assert {r.item_code: r.q for r in lines.collect()} == {r.item_code: r.qty_rcvd for r in activity.warehouse_receipts(src, none).collect()}


def test_an_early_stage_pays_for_no_later_cut(spark, cuts):
    assert "item_code" in queries.run(spark, SF_SMALL, stage="w16").columns
    assert "received" in cuts and "work_candidates" not in cuts
    queries.run(spark, SF_SMALL, stage="w23")
    assert "work_candidates" in cuts and "work_sales" not in cuts
    assert len(cuts) == len(set(cuts))


def test_shipment_lines_meet_the_transfers_once(spark, cuts, monkeypatch):
    """P02 and P11/P12 read one flag of the stored shipment lines, with the totals of a join each."""
    from itemrollup.plans import activity
    from itemrollup.sources import synthetic_sources

    src = synthetic_sources(spark, SF_SMALL)
    lines = queries.run(spark, SF_SMALL, stage="shipment_lines")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    for summary in (activity.shipment_history, activity.transfer_totals):
        flagged = summary(src, queries.P, lines)
        assert same(flagged, summary(src, queries.P, lines.drop("is_transfer"))) and flagged.count() > 0
        assert "orders.parquet" not in flagged._jdf.queryExecution().executedPlan().toString()  # no transfer is read


def test_last_po_candidates_meet_the_shipped_po_once(spark, small_sources):
    """P35-P37 with NULLs: one join with the item's shipped PO, and the rows of three-valued NOT IN."""
    from dataclasses import replace

    from conftest import frame
    from itemrollup.plans import purchasing

    lines = [("P1", "A"), ("P1", "A"), ("P2", "A"), ("P3", "A"), ("P3", "B"), (None, "B"), ("P9", "C"), ("P2", "D"), ("P4", None)]
    ol = spark.createDataFrame([(po, item, None, 0, None, "h", "l") for po, item in lines], "po_number string, item_code string, "
                               "skeleton_created_from string, created_from_requisition int, cancel_date timestamp_ntz, spec_instructions string, special_instructions string")
    shipped = frame(spark, small_sources.shipment_line, [{"item_code": i, "po_number": po} for i, po in (("A", "P2"), ("A", "P1"), ("A", "P3"), ("D", None))])
    src, work = replace(small_sources, shipment_line=shipped), spark.createDataFrame([(c,) for c in "ABCD"], "item_code string")
    got = lambda pend: sorted((r.item_code, r.fob_po, r.po_number) for r in purchasing.po_candidates(
        src, work, spark.createDataFrame(pend, "last_po string"), ol).collect())
    assert got([("P3",)]) == [("A", "", "P2"), ("A", "h", "P1"), ("C", "h", "P9"), ("D", "h", "P2")]
    assert got([]) == [("A", "", "P3"), ("A", "h", "P2"), ("B", "h", "P3"), ("C", "h", "P9"), ("D", "", None)]
    assert got([("P3",), (None,)]) == []
    stored = lambda df, path: (df.write.mode("overwrite").parquet(path), spark.read.parquet(path))[1]
    root = queries.new_run_dir(spark, "pos-test")
    ol, pend = stored(ol, f"{root}/ol"), stored(spark.createDataFrame([("P3",)], "last_po string"), f"{root}/pend")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = purchasing.po_candidates(src, work, pend, ol)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(item_code") + plan.count("Exchange hashpartitioning(po_number") <= 13, plan
    assert "_nn_all" not in plan  # no per-item statistics of a correlated NOT IN


def test_sales_headers_are_exchanged_once(spark):
    """The distinct sales headers keep their exchange for the join on the same columns."""
    from itemrollup.plans import sales
    from itemrollup.sources import synthetic_sources
    from itemrollup.sources.synthetic import view_sql

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = synthetic_sources(spark, SF_SMALL)
        plan = sales.cross_store_sales(src, queries.P)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(location_id") == 4, plan
    want = spark.sql(view_sql("sales_header", lambda t: f"parquet.`{SF_SMALL}/{t}.parquet`"))
    assert src.sales_header.schema == want.schema
    assert src.sales_header.exceptAll(want).count() == 0 and want.exceptAll(src.sales_header).count() == 0
