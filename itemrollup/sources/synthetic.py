"""The 32 source relations derived from the synthetic TPC-H-like tables.

Each definition is one SELECT that runs unchanged in Spark SQL and DuckDB
(the DuckDB oracle uses the same text as CTEs).  Placeholders in braces are
the raw tables; Spark binds them to DataFrames through ``spark.sql(..., **dfs)``.
"""

from __future__ import annotations

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Item key of a part: assortment codes (suffix > '19999999') for every part with key % 50 = 7.
_PK = "right(repeat('0',20) || cast(l_partkey + case when l_partkey % 50 = 7 then 20000000 else 0 end as string), 20)"
_PK_RAW = "cast(l_partkey + case when l_partkey % 50 = 7 then 20000000 else 0 end as string)"
_P = "right(repeat('0',20) || cast(p_partkey + case when p_partkey % 50 = 7 then 20000000 else 0 end as string), 20)"
_P_NEXT = "right(repeat('0',20) || cast((p_partkey + 1) + case when (p_partkey + 1) % 50 = 7 then 20000000 else 0 end as string), 20)"
_P_RAW = "cast(p_partkey + case when p_partkey % 50 = 7 then 20000000 else 0 end as string)"
_LOC_CUST = "'000' || right('00' || cast(o_custkey % 25 as string), 2)"
_TO_LOC = "case o_orderkey % 25 when 3 then '00300' when 4 then '00900' else '000' || right('00' || cast(o_orderkey % 25 as string), 2) end"
# Document numbers hold the whole order key (PO_WIDTH digits): no two orders share one at any scale.
PO_WIDTH = 18
_PO_L = f"right(repeat('0',{PO_WIDTH}) || cast(l_orderkey as string), {PO_WIDTH})"
_PO_O = f"right(repeat('0',{PO_WIDTH}) || cast(o_orderkey as string), {PO_WIDTH})"

# Lines rung under the generic cross-store code (fixed value, as in plans/params.py): the third line
# of an order at some stores; its order names the real SKU.
GENERIC_ITEM = "00000000000010222778"
_RUNG = f"case when l_linenumber = 3 and l_suppkey % 10 in (2, 5, 8) then '{GENERIC_ITEM}' else {_PK} end"

_RECEIPT = (
    f"select {_PK_RAW} item, case when l_suppkey % 9 = 0 then 'SUP' else 'CDC' end company, cast(l_quantity as int) total_qty, l_shipdate receipt_date, "
    f"case when l_linenumber = 1 then null when l_linenumber = 2 then {_PO_L} || '-A' else {_PO_L} end purchase_order_id "
    "from {lineitem} where l_linestatus = 'O' and l_partkey % 10 <> 9 and l_shipdate %s timestamp '1999-01-01 00:00:00'"
)
_SR_HEADER = (
    "select o_orderkey batch_id, case o_custkey % 3 when 0 then 'W' when 1 then 'R' else 'X' end shipment_type, "
    f"'SN' || {_PO_O} shipment_no from {{orders}} where o_orderdate %s timestamp '1999-01-01 00:00:00'"
)
_SR_LINE = (
    f"select l_orderkey batch_id, {_PK} item_code, l_shipdate process_date, cast(l_quantity as int) qty "
    "from {lineitem} join {orders} on o_orderkey = l_orderkey where l_returnflag = 'N' and l_partkey % 10 < 7 and o_orderdate %s timestamp '1999-01-01 00:00:00'"
)
_SOP_HEADER = (
    f"select {_PO_O} sop_number, case when o_custkey % 6 = 0 then 2 else 3 end sop_type, "
    "case o_custkey % 8 when 0 then 'SAMPLE' when 1 then 'MRDC1' when 2 then 'TTB9' else 'C' || cast(o_custkey as string) end customer_number, "
    "'STD' doc_id, case when o_custkey % 12 = 5 then 'Sales Void' else 'Sales' end batch_source from {orders} where o_orderstatus %s 'O'"
)
_SOP_LINE = (
    f"select {_PO_L} sop_number, case when l_linenumber % 2 = 0 then ' ' || {_PK_RAW} || ' ' else {_PK} end item_number, "
    "cast(l_quantity as int) qty_to_invoice, cast(l_extendedprice as decimal(19,4)) extended_price "
    "from {lineitem} join {orders} on o_orderkey = l_orderkey where o_orderstatus %s 'O'"
)

VIEWS: dict[str, str] = {
    "product": (
        f"select {_P} item_code, case when p_size = 1 then 'WHPBSUPPLY' else p_brand end vendor_id, p_brand purchase_vendor_id, "
        "case when p_partkey % 3 = 0 then '' else '978' || right(repeat('0',10) || cast(p_partkey as string), 10) end isbn, p_type product_type, p_brand section_code, "
        "case when p_partkey % 11 = 0 then '' else p_name end title, p_name || ' desc' description, cast(cast(p_retailprice as decimal(19,4)) * 0.6 as decimal(19,4)) cost, "
        "cast(p_retailprice as decimal(19,4)) price, case when p_partkey % 13 = 0 then null else cast(p_retailprice as decimal(19,4)) end mfg_price, "
        "case when p_size % 2 = 0 then 'Y' else 'N' end reorderable, right(repeat('0',18) || cast(p_partkey as string), 18) last_purchase_order, "
        "case when p_size < 25 then timestamp '1996-01-01 00:00:00' else timestamp '2005-01-01 00:00:00' end create_date, "
        "case when p_partkey % 40 = 1 then 'UPC' || cast(p_partkey - 1 as string) else '' end item_alias, case when p_type = 'PROMO' then 'TTB' else 'GEN' end user_class from {part}"
    ),
    "product_dist": (
        f"select {_P} item_code, right(repeat('0',14) || cast(p_partkey as string), 14) upc, "
        "case p_size when 2 then 'BASE INVENTORY' when 3 then 'ECOM' else p_type end scheme_id, "
        f"case when p_partkey % 40 = 0 then {_P_NEXT} else {_P} end report_item_code from {{part}}"
    ),
    "order_header": (
        f"select {_PO_O} po_number, o_orderdate po_date, cast(o_custkey % 30 as string) buyer_id, case when o_orderpriority = '1-URGENT' then '00944' else '00001' end location_no, "
        "case when o_custkey % 10 = 0 then 1 else 0 end created_from_requisition, case when o_custkey % 7 = 0 then 'SK' end skeleton_created_from, "
        "case when o_orderstatus = 'P' and o_custkey % 3 = 0 then o_orderdate end cancel_date, "
        "case o_orderpriority when '5-LOW' then 'S' when '4-NOT SPECIFIED' then null else 'R' end po_type, "
        "case when o_custkey % 4 = 0 then 'note ' || o_orderpriority end spec_instructions from {orders}"
    ),
    "order_line": (
        f"select {_PO_L} po_number, {_PK} item_code, cast(l_quantity as int) order_qty, l_linestatus scheme_id, "
        "case when l_linenumber = 1 then 'line ' || l_returnflag end special_instructions, "
        "case when l_tax >= 0.07 then 'A' else 'B' end distribution_type from {lineitem}"
    ),
    "buyer": "select cast(n_nationkey as string) buyer_id, case when n_nationkey % 5 = 0 then n_name else replace(n_name, '_', ' ') end name from {nation}",
    "location": (
        "select '000' || right('00' || cast(n_nationkey % 25 as string), 2) location_no, "
        "case n_regionkey when 0 then 'R' when 1 then 'C' else 'S' end location_type from {nation}"
    ),
    "shipment_header": (
        f"select o_orderkey transfer_id, {_LOC_CUST} from_location_no, {_TO_LOC} to_location_no, "
        "case when o_orderpriority = '5-LOW' then 1 when o_orderkey % 17 = 0 then null else 0 end drop_shipment from {orders}"
    ),
    "shipment_line": (
        f"select l_orderkey transfer_id, {_PK} item_code, cast(l_quantity as int) qty, l_shipdate date_received, {_PO_L} po_number "
        "from {lineitem} where l_linestatus = 'F' and l_partkey % 10 < 8"
    ),
    "transfer": (
        f"select {_LOC_CUST} from_location_no, {_TO_LOC} to_location_no, o_orderkey transfer_id, {_PK} item_code, cast(l_quantity as int) transfer_qty "
        "from {lineitem} join {orders} on o_orderkey = l_orderkey where l_returnflag = 'A' and l_linestatus = 'F'"
    ),
    "receipt_current": _RECEIPT.replace("%s", ">="),
    "receipt_archive": _RECEIPT.replace("%s", "<"),
    "sr_header": _SR_HEADER.replace("%s", ">="),
    "sr_header_historical": _SR_HEADER.replace("%s", "<"),
    "sr_line": _SR_LINE.replace("%s", ">="),
    "sr_line_historical": _SR_LINE.replace("%s", "<"),
    "receive_header": "select o_orderkey receiver, o_orderdate distribution_posted_date from {orders}",
    "receive_line": f"select l_orderkey receiver, {_PK} item_code, cast(l_quantity as int) qty_counted from {{lineitem}} where l_linenumber = 1",
    "sales_item": (
        f"select {_RUNG} item_code, l_suppkey % 10 location_id, l_shipdate business_date, right(repeat('0',12) || cast(l_orderkey as string), 12) sales_xaction_id, l_linenumber line_number, "
        "case when l_tax = 0 then 'V' else 'S' end xaction_type, case when l_suppkey % 20 = 0 then 'D' else 'A' end status, "
        "case when l_returnflag = 'R' then 'Y' else 'N' end is_return, case when l_linenumber = 2 then 'C' else '' end odpc_flag, "
        "cast(l_quantity as int) quantity, cast(l_extendedprice as decimal(19,4)) extended_amt, "
        "cast(cast(l_extendedprice as decimal(19,4)) * (1 - cast(l_discount as decimal(19,4))) as decimal(19,4)) register_price, "
        "cast(l_extendedprice as decimal(19,4)) unit_price, cast(l_discount as decimal(19,4)) discount_pct, "
        "cast(cast(l_extendedprice as decimal(19,4)) * cast(l_discount as decimal(19,4)) as decimal(19,4)) discount_amt from {lineitem}"
    ),
    "online_sale": (
        "select right(repeat('0',20) || cast(user_id + case when user_id % 50 = 7 then 20000000 else 0 end as string), 20) item_code, "
        "cast(value as decimal(19,4)) selling_price, 1 quantity, ts - interval '25' year date_sold from {events} where event_type = 'purchase'"
    ),
    "cross_order": (
        "select distinct l_suppkey % 10 location_id, substring(right(repeat('0',12) || cast(l_orderkey as string), 12), 1, 3) till_number, "
        f"cast(l_orderkey as string) transaction_number, l_linenumber detail_number, {_PK_RAW} sku, cast(l_extendedprice as decimal(19,4)) price "
        "from {lineitem} where l_linenumber = 3"
    ),
    "sales_header": (
        "select distinct l_suppkey % 10 location_id, l_shipdate business_date, right(repeat('0',12) || cast(l_orderkey as string), 12) sales_xaction_id, "
        "'A' status, 'S' xaction_type from {lineitem}"
    ),
    "product_inventory": f"select {_PK} item_code, cast(l_quantity as int) quantity_on_hand from {{lineitem}} where l_linenumber = 4",
    "isbn": "select '978' || right(repeat('0',10) || cast(p_partkey as string), 10) isbn, p_brand publisher_name, p_name author from {part} where p_partkey % 2 = 0",
    "section": f"select {_P} item_code, case when p_size = 5 then null else lower(p_type) end section_code from {{part}} where p_partkey % 4 = 0",
    "base_inventory": f"select {_P} item_code from {{part}} where p_size = 4",
    "recv_items_created": f"select {_P} item_code, {_P_NEXT} new_item_code from {{part}} where p_size = 6",
    "oos_item": f"select {_P_RAW} item from {{part}} where p_size between 10 and 20",
    "available": (
        f"select {_P} item_code, case when p_size % 2 = 0 then 'TTB' else 'CDC' end company, p_size * 3 available_qty "
        "from {part} where p_size > 15"
    ),
    "sop_header_open": _SOP_HEADER.replace("%s", "="),
    "sop_header_history": _SOP_HEADER.replace("%s", "<>"),
    "sop_line_open": _SOP_LINE.replace("%s", "="),
    "sop_line_history": _SOP_LINE.replace("%s", "<>"),
}

assert len(VIEWS) == 32, len(VIEWS)

# The same rows for Spark: constants stay out of the DISTINCT, so a join on its columns needs no second exchange.
SPARK_VIEWS: dict[str, str] = {
    "sales_header": (
        "select *, 'A' status, 'S' xaction_type from (select distinct l_suppkey % 10 location_id, l_shipdate business_date, "
        "right(repeat('0',12) || cast(l_orderkey as string), 12) sales_xaction_id from {lineitem})"
    ),
}


def view_sql(name: str, table_ref=lambda t: t) -> str:
    """The view text with raw-table placeholders replaced by ``table_ref(name)``."""
    return VIEWS[name].format(**{t: table_ref(t) for t in RAW_TABLES})
