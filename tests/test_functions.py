"""Golden cases for the column helpers (values derived by hand from the original statements)."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from itemrollup.functions import (
    assortment,
    discount_pct,
    initials,
    is_blank,
    item_key,
    number_or_zero,
    numeric_or_left,
    pct_sold,
    title_item,
    to_minute,
)


def one(spark, expr, schema, *values):
    df = spark.createDataFrame([values], schema)
    return df.select(expr.alias("x")).first()["x"]


def test_item_key_pads_short_and_keeps_right_of_long(spark):
    df = spark.createDataFrame([("123",), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ",), (None,)], "c string")
    got = [r.x for r in df.select(item_key("c").alias("x")).collect()]
    assert got == ["00000000000000000123", "GHIJKLMNOPQRSTUVWXYZ", None]


def test_transaction_key(spark):
    df = spark.createDataFrame([("001", "42")], "till string, n string")
    got = df.select(F.concat("till", item_key("n", 9)).alias("x")).first().x
    assert got == "001000000042"


def test_minute_rounding(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1, 10, 0, 29, 997000),), (datetime(2020, 1, 1, 10, 0, 30),)], "t timestamp_ntz"
    )
    got = [r.x for r in df.select(to_minute("t").alias("x")).collect()]
    assert [g.minute for g in got] == [0, 1]


def test_is_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), (" a",)], "c string")
    assert [r.x for r in df.select(is_blank("c").alias("x")).collect()] == [True, True, True, False]


def test_pct_sold(spark):
    df = spark.createDataFrame([(3, 0), (1, 4), (None, 4), (None, None), (2, None)], "sold bigint, shipped bigint")
    got = [r.x for r in df.select(pct_sold("sold", "shipped").alias("x")).collect()]
    assert got == [3.0, 25.0, None, 0.0, 2.0]


def test_discount_pct(spark):
    df = spark.createDataFrame(
        [(Decimal("10"), 3, Decimal("1.25")), (Decimal("10"), 0, Decimal("1.25")), (Decimal("1"), None, Decimal("1"))],
        "reg decimal(19,4), qty bigint, price decimal(19,4)",
    )
    got = [r.x for r in df.select(discount_pct("reg", "qty", "price").alias("x")).collect()]
    assert got == [Decimal("2.67"), Decimal("0.00"), None]


def test_initials(spark):
    df = spark.createDataFrame([("John Smith",), ("Cher",), (" Ann Lee",), ("",), (None,)], "n string")
    got = [r.x for r in df.select(initials("n").alias("x")).collect()]
    assert got == ["J.S.", "C.C.", "A.A.", "..", None]


def test_assortment_boundary(spark):
    df = spark.createDataFrame([("00000000000020000007",), ("00000000000019999999",), ("00000000000000000055",)], "c string")
    got = [(r.a, r.t) for r in df.select(assortment("c").alias("a"), title_item("c").alias("t")).collect()]
    assert got == [(True, False), (False, False), (False, True)]


def test_number_or_zero_and_po_text(spark):
    df = spark.createDataFrame([(Decimal("5.5"), "000123"), (None, "000123-A"), (None, None)], "m decimal(19,4), po string")
    got = [(r.m, r.p) for r in df.select(number_or_zero("m").alias("m"), numeric_or_left("po", 6).alias("p")).collect()]
    assert got == [(Decimal("5.5000"), "000123"), (Decimal("0.0000"), "000123"), (Decimal("0.0000"), None)]


def test_minute_rounding_stays_zone_less(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1, 10, 0, 45),)], "t timestamp_ntz")
    assert df.select(to_minute("t").alias("x")).schema["x"].dataType.simpleString() == "timestamp_ntz"
