"""Hot keys: one item holding a third of the sales lines is pre-aggregated, never shuffled raw."""

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import frame
from itemrollup.plans import sales
from itemrollup.plans.params import SYNTHETIC as P


def _skewed_sales(spark, src, n=3000):
    rows = []
    for i in range(n):
        item = "HOT" if i % 3 == 0 else f"I{i % 97}"
        rows.append({
            "item_code": item, "location_id": i % 10, "business_date": datetime(1999, 1, 1 + i % 28),
            "sales_xaction_id": str(i), "line_number": 1, "xaction_type": "S", "status": "A",
            "is_return": "Y" if i % 11 == 0 else "N", "odpc_flag": "C" if i % 7 == 0 else "",
            "quantity": 1 + i % 5, "extended_amt": Decimal(i % 50), "register_price": Decimal(i % 40),
            "unit_price": Decimal(i % 45), "discount_pct": Decimal("0.05") if i % 2 else Decimal(0),
            "discount_amt": Decimal(i % 3),
        })
    return frame(spark, src.sales_item, rows), rows


def test_hot_item_totals_equal_brute_force(spark, small_sources):
    df, rows = _skewed_sales(spark, small_sources)
    upc = spark.createDataFrame([("I1", "HOT"), ("I2", "I3")], "item_code string, report_item_code string")
    got = {r.item_code: (r.qty_sold, r.qty_returned, r.extended_amt, r.marked_down)
           for r in sales.sales_rekeyed_totals(replace(small_sources, sales_item=df), P, upc).collect()}
    want: dict = {}
    remap = {"I1": "HOT", "I2": "I3"}
    for r in rows:
        k = remap.get(r["item_code"], r["item_code"])
        sold, ret, amt, md = want.get(k, (0, 0, Decimal(0), 0))
        n = r["is_return"] == "N"
        want[k] = (sold + (r["quantity"] if n else 0), ret + (r["quantity"] if not n else 0),
                   amt + (r["extended_amt"] if n else 0), md + (1 if r["unit_price"] > r["register_price"] else 0))
    assert got == want
    assert got["HOT"][0] > 0


def _ancestors_have_partial_aggregate(plan: str, leaf_marker: str) -> bool:
    """Walk up the plan tree from every leaf matching ``leaf_marker`` to the first Exchange."""
    lines = plan.splitlines()
    depth = [len(l) - len(l.lstrip(" :+-")) for l in lines]
    ok = True
    for i, line in enumerate(lines):
        if leaf_marker not in line:
            continue
        d, seen_agg = depth[i], False
        for j in range(i - 1, -1, -1):
            if depth[j] < d:
                d = depth[j]
                if "HashAggregate" in lines[j] or "SortAggregate" in lines[j]:
                    seen_agg = True
                if "Exchange" in lines[j] and "Broadcast" not in lines[j]:
                    ok = ok and seen_agg
                    break
    return ok


def test_sales_fact_is_aggregated_before_its_exchange(spark, small_sources):
    import tempfile

    df, _ = _skewed_sales(spark, small_sources, n=300)
    path = tempfile.mkdtemp(prefix="itemrollup-skew-") + "/sales"
    df.write.parquet(path)
    src = replace(small_sources, sales_item=spark.read.parquet(path))
    out = sales.sales_rekeyed_totals(src, P, sales.alias_items(small_sources))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert _ancestors_have_partial_aggregate(plan, "itemrollup-skew-"), plan


def test_first_per_key_is_a_partial_aggregate(spark):
    from itemrollup.operators import first_per_key

    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.col("id").alias("v"))
    plan = first_per_key(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert _ancestors_have_partial_aggregate(plan, "Range")
    # the check does detect a raw shuffle
    raw = df.repartition(4, "k")._jdf.queryExecution().executedPlan().toString()
    assert not _ancestors_have_partial_aggregate(raw, "Range")


def _order_lines(spark, n=1200):
    """Order lines as after the header join: every third line is of item HOT, POs repeat."""
    rows = [(f"PO{i % 40}", "HOT" if i % 3 == 0 else f"I{i % 17}", datetime(1998, 1, 1 + i % 40 % 28), f"b{i % 40 % 4}",
             "00944" if i % 2 else "00001", 0, None, None, f"h{i % 2}" if i % 5 else None, f"l{i % 3}")
            for i in range(n)]
    return spark.createDataFrame(rows, "po_number string, item_code string, po_date timestamp, buyer_id string, location_no string, "
                                 "created_from_requisition int, skeleton_created_from string, cancel_date timestamp, "
                                 "spec_instructions string, special_instructions string"), rows


def _stored(spark, df, name):
    import tempfile

    path = tempfile.mkdtemp(prefix=f"itemrollup-{name}-") + "/t"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_item_in_last_pos_buyers_and_reorders(spark, small_sources):
    """Equal to brute force, and no raw order, shipment or wholesale line reaches an exchange."""
    from itemrollup.plans import pending, purchasing, summarise

    df, raw = _order_lines(spark)
    df = df.withColumn("buyer_name", F.when(F.col("buyer_id") != "b3", F.concat(F.lit("name "), F.substring("buyer_id", 2, 1))))
    ol = _stored(spark, df, "hot-orders")
    work = spark.createDataFrame([("HOT",), ("I3",), ("I5",), ("NONE",)], "item_code string")
    none = spark.createDataFrame([], "last_po string")
    shipped = frame(spark, small_sources.shipment_line, [
        {"transfer_id": i, "item_code": "HOT" if i % 3 == 0 else "I3", "qty": 1, "po_number": f"PO{i % 30}"} for i in range(600)])
    src = replace(small_sources, shipment_line=_stored(spark, shipped, "hot-shipments"))

    top = {}
    for i in range(600):
        item = "HOT" if i % 3 == 0 else "I3"
        top[item] = max(top.get(item, ""), f"PO{i % 30}")
    want = {}
    for po, item, *_, head, line in raw:
        if item in ("HOT", "I3", "I5") and po != top.get(item):
            want[item, head, line] = max(want.get((item, head, line), ""), po)
    for item, po in top.items():
        want[item, "", ""] = max(want.get((item, "", ""), ""), po)
    pos = purchasing.po_candidates(src, work, none, ol)
    assert {(r.item_code, r.fob_po, r.fob_item): r.po_number for r in pos.collect()} == want
    assert _ancestors_have_partial_aggregate(_plan(pos), "itemrollup-hot-orders-")
    assert _ancestors_have_partial_aggregate(_plan(pos), "itemrollup-hot-shipments-")

    first = {}
    for po, item, day, buyer, *_ in raw:
        if item in ("HOT", "I3", "I5"):
            name = f"name {buyer[1]}" if buyer != "b3" else " "
            first[item] = min(first.get(item, (day, po, name)), (day, po, name))
    ob = purchasing.original_buyer(work, ol)
    assert {r.item_code: (r.po_date, r.po_number, r.buyer) for r in ob.collect()} == first
    assert _ancestors_have_partial_aggregate(_plan(ob), "itemrollup-hot-orders-")

    product = spark.createDataFrame([(c, "TTB") for c in ("HOT", "I1", "I3")], "item_code string, user_class string")
    again = pending.reorder_items(replace(src, product=product), work, ol)
    assert sorted(r.item_code for r in again.collect()) == sorted({r[1] for r in raw if r[4] == "00944"} & {"HOT", "I3"})
    assert _ancestors_have_partial_aggregate(_plan(again), "itemrollup-hot-orders-")

    sop = frame(spark, small_sources.sop_line_open, [
        {"sop_number": str(i % 9), "item_number": "HOT" if i % 3 == 0 else f" I{i % 7} ", "qty_to_invoice": 1, "extended_price": Decimal(2)}
        for i in range(900)])
    head = frame(spark, small_sources.sop_header_open, [
        {"sop_number": str(i), "sop_type": 3, "customer_number": "C1", "doc_id": "STD", "batch_source": "Sales"} for i in range(9)])
    src = replace(src, sop_line_open=_stored(spark, sop, "hot-wholesale"), sop_header_open=head,
                  sop_line_history=sop.limit(0), sop_header_history=head.limit(0))
    rollup = spark.createDataFrame([("HOT".rjust(20, "0"),), ("I1".rjust(20, "0"),)], "item_code string")
    got = {r.item_number: (r.quantity, r.extended_price) for r in summarise.wholesale_totals(src, rollup).collect()}
    n1 = sum(i % 3 != 0 and i % 7 == 1 for i in range(900))
    assert got == {"HOT": (300, Decimal(600)), " I1 ": (n1, Decimal(2 * n1))}
    assert _ancestors_have_partial_aggregate(_plan(summarise.wholesale_totals(src, rollup)), "itemrollup-hot-wholesale-")


SPLIT = {  # thresholds small enough for the test's rows
    "spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_split(spark, run):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _open_lines(spark, n=9000):
    """Open order lines with a third on item HOT, over several map tasks."""
    rows = [(f"PO{i}", "HOT" if i % 3 == 0 else f"I{i % 300}", datetime(2001, 1, 1 + i % 28), f"b{i % 7}", "00944", 0, None, None,
             "M", "B", None, f"note {i}", "x", i % 9) for i in range(n)]
    df = spark.createDataFrame(rows, "po_number string, item_code string, po_date timestamp_ntz, buyer_id string, location_no string, "
                                     "created_from_requisition int, skeleton_created_from string, cancel_date timestamp_ntz, distribution_type string, "
                                     "po_type string, spec_instructions string, special_instructions string, line_scheme_id string, order_qty int")
    return _stored(spark, df.repartition(8), "open-lines"), rows


def test_hot_item_of_open_orders_is_split(spark, small_sources):
    """A third of the open lines on one item; equal to brute force, and the join is split."""
    from itemrollup.plans import pending

    ol, rows = _open_lines(spark)
    loose = lambda like, data: spark.createDataFrame(
        [tuple(d.get(n) for n in like.columns) for d in data], ", ".join(f"{n} {t}" for n, t in like.dtypes))
    codes = ["HOT", *(f"I{i}" for i in range(0, 300, 2))]
    master = loose(small_sources.product, [{"item_code": c, "title": c} for c in codes])
    src = replace(small_sources, product=master, product_dist=loose(small_sources.product_dist, [{"item_code": c} for c in codes]))
    known = spark.createDataFrame([("I2",), ("I4",), ("I4",)], "item_code string")

    def run():
        new = _stored(spark, pending.item_rows(src, known, listed=False), "new-items")
        out = pending.pending_orders(P, new, ol)
        got = sorted((r.item_code, r.last_po) for r in out.collect())
        return got, _plan(out)

    got, plan = _with_split(spark, run)
    assert got == sorted((r[1], r[0]) for r in rows if r[1] in codes and r[1] not in ("I2", "I4"))
    assert "skew=true" in plan, plan

    def again():
        items = _stored(spark, pending.item_rows(src, spark.createDataFrame([("HOT",), ("I4",)], "item_code string"), listed=True), "again")
        received = _stored(spark, spark.createDataFrame([("HOT", f"PO{i}") for i in range(0, 9000, 6)], "item_code string, po_number string"), "received")
        out = pending.pending_reorders(P, items, received, ol)
        return sorted((r.item_code, r.last_po) for r in out.collect()), _plan(out)

    got, plan = _with_split(spark, again)
    assert got == sorted((r[1], r[0]) for i, r in enumerate(rows) if r[1] == "I4" or r[1] == "HOT" and i % 6)
    assert "skew=true" in plan, plan


def test_notes_of_a_hot_item_leave_the_lines_once(spark):
    """A third of the lines on one item: notes are combined before the exchange, and equal brute force."""
    from itemrollup.plans import lines

    df, raw = _order_lines(spark)
    notes = lines.order_notes(_stored(spark, df, "hot-notes"))
    want = {(r[1], r[0], r[8], r[9]) for r in raw if r[8] or r[9]}
    assert {(r.item_code, r.po_number, r.fob_po, r.fob_item) for r in notes.collect()} == want
    assert _ancestors_have_partial_aggregate(_plan(notes), "itemrollup-hot-notes-")
    picks = {(r.item_code, r.po_number): (r.by_line, r.by_header) for r in lines.note_picks(notes).collect()}
    for (item, po), (line, head) in picks.items():
        own = [(i, h) for a, b, h, i in want if (a, b) == (item, po)]
        order = lambda t: (t[0] or "", t[1] or "")
        assert tuple(line) == max((t for t in own if t[0]), key=order)
        assert (tuple(head) if head else None) == max((t for t in own if t[1]), key=order, default=None)
