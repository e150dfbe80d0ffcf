"""Golden micro-fixtures for the semantics that must survive, stage by stage."""

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import frame
from itemrollup.operators import fused_join
from itemrollup.plans import activity, purchasing, sales, summarise
from itemrollup.plans.contracts import WORK, conform
from itemrollup.plans.params import SYNTHETIC as P
from itemrollup.plans.publish import published_rollup, report

D = datetime(1999, 6, 1)


def test_union_distinct_collapses_identical_receipt_aggregates(spark, small_sources):
    src = small_sources
    rec = [{"item": "5", "company": "CDC", "total_qty": 5, "receipt_date": D, "purchase_order_id": None}]
    s = replace(src, receipt_current=frame(spark, src.receipt_current, rec), receipt_archive=frame(spark, src.receipt_archive, rec))
    empty_a = spark.createDataFrame([], "item_code string, first_received timestamp_ntz, last_received timestamp_ntz, parent string, rcvd_qty bigint")
    out = activity.received_union_distinct(s, empty_a).collect()
    assert [(r.item_code, r.rcvd_qty, r.parent) for r in out] == [("00000000000000000005", 5, " ")]


def _ship(spark, src, to_loc, drop, date=D, qty=4, transfer=True):
    sh = frame(spark, src.shipment_header, [{"transfer_id": 1, "from_location_no": "00000", "to_location_no": to_loc, "drop_shipment": drop}])
    sd = frame(spark, src.shipment_line, [{"transfer_id": 1, "item_code": "I1", "qty": qty, "date_received": date, "po_number": "000001"}])
    tr = frame(spark, src.transfer, [{"from_location_no": "00000", "to_location_no": to_loc, "transfer_id": 1, "item_code": "I1", "transfer_qty": qty}] if transfer else [])
    loc = frame(spark, src.location, [{"location_no": "00000", "location_type": "R"}, {"location_no": to_loc, "location_type": "S"}])
    return replace(src, shipment_header=sh, shipment_line=sd, transfer=tr, location=loc)


def test_damage_counts_in_transfers_and_damage(spark, small_sources):
    s = _ship(spark, small_sources, "00900", 0)
    r = activity.transfer_totals(s, P).first()
    assert (r.qty_trans, r.qty_damaged) == (4, 4)


def test_returns_location_not_a_transfer(spark, small_sources):
    s = _ship(spark, small_sources, "00300", 0)
    r = activity.transfer_totals(s, P).first()
    assert (r.qty_trans, r.qty_damaged) == (None, None)


def test_null_drop_ship_flag_counts_as_drop_ship_but_not_as_transfer(spark, small_sources):
    s = _ship(spark, small_sources, "00007", None, transfer=False)
    assert [(r.drop_ship, r.qty_shipped) for r in activity.shipment_history(s, P).collect()] == [(1, 4)]
    s = _ship(spark, small_sources, "00007", None, transfer=True)
    assert activity.transfer_totals(s, P).count() == 0


def test_shipment_window_includes_midnight_after_as_of(spark, small_sources):
    s = _ship(spark, small_sources, "00007", 0, date=P.ship_end, transfer=False)
    assert activity.shipment_history(s, P).count() == 1
    s = _ship(spark, small_sources, "00007", 0, date=datetime(2001, 8, 2, 0, 0, 1), transfer=False)
    assert activity.shipment_history(s, P).count() == 0


def _work(spark, data):
    return conform(spark.createDataFrame([tuple(d.get(f.name) for f in WORK.fields) for d in data], WORK), WORK)


def test_channel_sales_leave_null_store_totals_null_until_filled(spark):
    work = _work(spark, [{"item_code": "A", "qty_sold": None}, {"item_code": "B", "qty_sold": 2, "register_price": Decimal(1), "extended_amt": Decimal(1)}])
    online = spark.createDataFrame([("A", 3, Decimal("10")), ("B", 3, Decimal("10"))], "item_code string, online_qty_sold bigint, extended_amt decimal(19,4)")
    cross = spark.createDataFrame([], "item_code string, qty_sold bigint, extended_amt decimal(19,4)")
    totals = spark.createDataFrame([], "item_code string, " + ", ".join(f"{c} bigint" for c in sales.SALES_MEASURES))
    out = sales.set_channel_sales(fused_join(work, sales.sales_sources(totals, online, cross), "item_code"))
    got = {r.item_code: (r.qty_sold, r.register_price) for r in out.collect()}
    assert got == {"A": (None, None), "B": (5, Decimal("11.0000"))}
    filled = {r.item_code: r.qty_sold for r in purchasing.null_fills(out).collect()}
    assert filled == {"A": 0, "B": 5}


def test_online_amount_is_sum_of_prices_not_price_times_quantity(spark, small_sources):
    src = small_sources
    o = frame(spark, src.online_sale, [
        {"item_code": "X", "selling_price": Decimal(10), "quantity": 4, "date_sold": D},
        {"item_code": "X", "selling_price": Decimal(10), "quantity": 4, "date_sold": D},
    ])
    upc = spark.createDataFrame([], "item_code string, report_item_code string")
    r = sales.online_sales(replace(src, online_sale=o), upc, P.start_date, P.end_date).first()
    assert (r.extended_amt, r.online_qty_sold, r.selling_price) == (Decimal("20.0000"), 8, Decimal("10.0000"))


def test_return_line_counts_returned_and_coupon(spark, small_sources):
    src = small_sources
    line = {"item_code": "I", "location_id": 1, "business_date": D, "sales_xaction_id": "1", "line_number": 1,
            "xaction_type": "S", "status": "A", "is_return": "Y", "odpc_flag": "C", "quantity": 2,
            "extended_amt": Decimal(5), "register_price": Decimal(5), "unit_price": Decimal(5),
            "discount_pct": Decimal(0), "discount_amt": Decimal(1)}
    r = sales.sales_totals(replace(src, sales_item=frame(spark, src.sales_item, [line])), P).first()
    assert (r.qty_sold, r.qty_returned, r.coupons, r.coupon_amt) == (0, 2, 2, Decimal("1.0000"))


def test_vendor_returns_multiply_by_rollup_rows(spark, small_sources):
    src = small_sources
    tr = frame(spark, src.transfer, [{"from_location_no": "1", "to_location_no": "00300", "transfer_id": 1, "item_code": "I", "transfer_qty": 5}])
    rollup = spark.createDataFrame([("I", "a"), ("I", "b")], "item_code string, title string")
    r = summarise.vendor_returns(replace(src, transfer=tr), rollup).first()
    assert r.total_returns == 10


def test_wholesale_spellings_duplicate_published_rows(spark, small_sources):
    src = small_sources
    rollup = conform(_work(spark, [{"item_code": "00000000000000000123", "parent": "RCVD", "qty_sold": 1, "qty_shipped": 2}]), WORK)
    hdr = frame(spark, src.sop_header_open, [{"sop_number": "1", "sop_type": 3, "customer_number": "C1", "doc_id": "STD", "batch_source": "Sales"}])
    lines = frame(spark, src.sop_line_open, [
        {"sop_number": "1", "item_number": " 123 ", "qty_to_invoice": 1, "extended_price": Decimal(1)},
        {"sop_number": "1", "item_number": "00000000000000000123", "qty_to_invoice": 2, "extended_price": Decimal(2)},
    ])
    s = replace(src, sop_header_open=hdr, sop_line_open=lines, sop_header_history=frame(spark, src.sop_header_history, []),
                sop_line_history=frame(spark, src.sop_line_history, []))
    txb = summarise.wholesale_totals(s, rollup)
    assert txb.count() == 2
    reset = summarise.status_reset(rollup, s, txb)
    assert reset.first().parent == ""
    online = spark.createDataFrame([], "item_code string, online_qty_sold bigint, selling_price decimal(19,4)")
    returns = spark.createDataFrame([], "item_code string, total_returns bigint")
    picks = spark.createDataFrame([], "item_code string, po_number string, by_line struct<i: string, h: string>, by_header struct<i: string, h: string>")
    pub = published_rollup(reset, returns, txb, online, s, picks)
    assert sorted(r.txb_qty for r in pub.collect()) == [1, 2]


def test_report_orders_by_last_received_desc_nulls_last(spark, small_sources):
    base = {"vendor_id": "V", "reorder_vendor_id": "V", "parent": "", "buyer": "John Smith", "qty_sold": 1,
            "qty_shipped": 100, "price": Decimal(1), "register_price": Decimal(1)}
    pub = _work(spark, [
        dict(base, item_code="00000000000000000001", last_received=None),
        dict(base, item_code="00000000000000000002", last_received=datetime(2011, 1, 1)),
        dict(base, item_code="00000000000000000003", last_received=datetime(2012, 1, 1)),
    ]).withColumn("pct_sold", F.lit(1.0)).withColumn("qty_rtv", F.lit(0)).withColumn("txb_qty", F.lit(0)) \
      .withColumn("txb_amt", F.lit(0)).withColumn("online_qty_sold", F.lit(0)).withColumn("selling_price", F.lit(None).cast("decimal(19,4)"))
    out = report(pub, small_sources.buyer, small_sources.available, datetime(2010, 1, 1)).collect()
    assert [r.item_code for r in out] == ["00000003", "00000002", "00000001"]
    assert out[0].buyer == "J.S."


def test_drop_ship_fix_keeps_invoiced_amount(spark, small_sources):
    from itemrollup.plans import candidates

    work = _work(spark, [{"item_code": "I", "parent": "SHIP", "cost": Decimal(2), "qty_shipped": 10, "amt_invoiced": Decimal(20)}])
    ship_hist = spark.createDataFrame([("I", 1, 10)], "item_code string, drop_ship int, qty_shipped bigint")
    rcvd = spark.createDataFrame([("I", D, D, True, 7)],
                                 "item_code string, first_rcvd timestamp_ntz, last_rcvd timestamp_ntz, store_received boolean, rcvd_qty bigint")
    moved = spark.createDataFrame([], "item_code string, qty_trans bigint, qty_damaged bigint")
    joined = fused_join(work, candidates.activity_sources(small_sources, moved, ship_hist, rcvd), "item_code")
    r = candidates.set_drop_ship_received(joined).first()
    assert (r.qty_shipped, r.amt_invoiced) == (7, Decimal("20.0000"))


def test_alias_row_without_parent_row_disappears(spark, small_sources):
    work = _work(spark, [{"item_code": "ALIAS", "parent": " ", "vendor_id": "V", "reorder_vendor_id": "V", "qty_sold": 4}])
    upc = spark.createDataFrame([("ALIAS", "PARENT")], "item_code string, report_item_code string")
    rekeyed = summarise.rekey_aliases(work, upc, small_sources)
    r = rekeyed.first()
    assert (r.item_code, r.parent, r.qty_shipped, r.qty_sold) == ("PARENT", None, 0, 4)
    assert summarise.item_rollup(rekeyed, upc).count() == 0


def _published(spark, rows):
    base = {"vendor_id": "V", "reorder_vendor_id": "V", "parent": "", "qty_sold": 1, "qty_shipped": 100,
            "price": Decimal(1), "register_price": Decimal(1), "first_received": datetime(2011, 1, 1)}
    return _work(spark, [dict(base, **r) for r in rows]).withColumn("pct_sold", F.lit(1.0)) \
        .withColumn("qty_rtv", F.lit(0)).withColumn("txb_qty", F.lit(0)).withColumn("txb_amt", F.lit(0)) \
        .withColumn("online_qty_sold", F.lit(0)).withColumn("selling_price", F.lit(None).cast("decimal(19,4)"))


def test_report_blank_buyer_without_blank_name_row_is_null(spark, small_sources):
    pub = _published(spark, [{"item_code": "00000000000000000011", "buyer": ""}])
    out = report(pub, small_sources.buyer, small_sources.available, datetime(2010, 1, 1)).collect()
    assert [r.buyer for r in out] == [None]


def test_report_assortment_minimum_shipped_and_available_text(spark, small_sources):
    pub = _published(spark, [
        {"item_code": "00000000000020000007", "qty_shipped": 19, "buyer": "A B"},
        {"item_code": "00000000000020000057", "qty_shipped": 20, "buyer": "A B"},
        {"item_code": "00000000000000000055", "buyer": "A B"},
    ])
    available = spark.createDataFrame([("00000000000000000055", "TTB", 12), ("00000000000020000057", "CDC", 9)],
                                      "item_code string, company string, available_qty int")
    out = {r.item_code: (r.buyer, r.ttb_inv, r.selling_price, r.online_qty_sold)
           for r in report(pub, small_sources.buyer, available, datetime(2010, 1, 1)).collect()}
    assert out == {"20000057": ("Assort", "", None, 0), "00000055": ("A.B.", "12", None, 0)}
