"""Truth tables and contracts of the DataFrame operators."""

from pyspark.sql import functions as F

from itemrollup.operators import (
    conditional_totals,
    delete_where,
    existence_flag,
    first_per_key,
    keyed_update,
    not_in,
)


def ints(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def keys(df, c="k"):
    return sorted(r[c] for r in df.collect() if r[c] is not None) + [None] * sum(1 for r in df.collect() if r[c] is None)


def test_not_in_plain(spark):
    left = ints(spark, [1, 2, 3, None], "k")
    assert keys(not_in(left, "k", ints(spark, [1, 1], "r"), "r")) == [2, 3]


def test_not_in_null_on_right_removes_everything(spark):
    left = ints(spark, [1, 2], "k")
    assert not_in(left, "k", ints(spark, [1, None], "r"), "r").count() == 0
    assert not_in(left, "k", ints(spark, [None, None], "r"), "r").count() == 0


def test_not_in_empty_right_keeps_null_left(spark):
    left = ints(spark, [1, None], "k")
    empty = ints(spark, [], "r")
    assert keys(not_in(left, "k", empty, "r")) == [1, None]


def test_not_in_correlated(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", None), ("d", 5)], "item string, po int")
    right = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "ri string, rpo int")
    got = sorted((r.item, r.po) for r in not_in(left, "po", right, "rpo", by={"item": "ri"}).collect())
    # a: 1 excluded; b: NULL in its set removes all; c: NULL left key with a non-empty set removed; d: empty set keeps
    assert got == [("a", 2), ("d", 5)]


def test_not_in_does_not_plan_a_nested_loop_join(spark):
    left = ints(spark, [1, 2], "k")
    plan = not_in(left, "k", ints(spark, [1], "r"), "r")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_keyed_update_keeps_duplicates_and_null_overwrites(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 3, "n")], "k string, v int, s string")
    source = spark.createDataFrame([("a", None), ("b", 20)], "k string, nv int")
    out = keyed_update(target, source, ["k"], {"v": F.col("nv")})
    got = sorted((r.k or "", r.v, r.s) for r in out.collect())
    assert got == [("", 3, "n"), ("a", None, "x"), ("a", None, "y"), ("b", 20, "z")]
    assert out.schema["v"].dataType.simpleString() == "int"


def test_keyed_update_guard_and_pre_update_reads(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, x int, y int")
    source = spark.createDataFrame([("a", 100), ("b", 200)], "k string, n int")
    out = keyed_update(target, source, ["k"], {"x": F.col("y"), "y": F.col("x") + F.col("n")}, where=F.col("k") == "a")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 10, 101), ("b", 2, 20)]


def test_first_per_key_total_order_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "2", "p"), ("a", "9", "q"), ("a", None, "r"), ("b", None, "s")], "k string, po string, note string"
    )
    hi = {r.k: (r.po, r.note) for r in first_per_key(df, ["k"], [F.col("po")], descending=True).collect()}
    assert hi == {"a": ("9", "q"), "b": (None, "s")}
    lo = {r.k: r.po for r in first_per_key(df, ["k"], [F.col("po").isNull(), F.col("po")]).collect()}
    assert lo == {"a": "2", "b": None}


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([("BASE INVENTORY",), (None,), ("X",)], "scheme string")
    out = delete_where(df, F.col("scheme") == "BASE INVENTORY")
    assert sorted((r.scheme or "") for r in out.collect()) == ["", "X"]


def test_existence_flag_preserves_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    ks = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    out = existence_flag(df, ks, ["k"], "f")
    assert sorted((r.k, r.f) for r in out.collect()) == [("a", True), ("a", True), ("b", False)]


def test_conditional_totals(spark):
    df = spark.createDataFrame([("a", "N", 2), ("a", "Y", 3), ("a", "N", None)], "k string, ret string, q int")
    out = conditional_totals(df, ["k"], {"sold": (F.col("ret") == "N", F.col("q")), "lines": (F.col("ret") == "N", F.lit(1))})
    r = out.first()
    assert (r.sold, r.lines) == (2, 2)


def test_rekey_maps_to_parent_even_when_parent_is_null(spark):
    from itemrollup.operators import rekey

    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    mapping = spark.createDataFrame([("a", "P"), ("b", None)], "f string, t string")
    out = {r.v: (r.nk, r._rekeyed) for r in rekey(df, mapping, "k", "f", "t", "nk").collect()}
    assert out == {1: ("P", True), 2: (None, True), 3: ("c", False)}


def test_current_and_archive_requires_same_columns(spark):
    import pytest

    from itemrollup.operators import current_and_archive

    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, k int")
    assert sorted(tuple(r) for r in current_and_archive(a, b).collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        current_and_archive(a, spark.createDataFrame([(1,)], "k int"))


def test_not_in_two_lists_equals_not_in_their_union(spark):
    left = ints(spark, [1, 2, 3, None], "k")
    cases = [([1], [2]), ([1, None], [2]), ([], [2]), ([], []), ([None], [])]
    for a, b in cases:
        ra, rb = ints(spark, a, "r"), ints(spark, b, "r")
        two = not_in(not_in(left, "k", ra, "r"), "k", rb, "r")
        one = not_in(left, "k", ra.unionByName(rb), "r")
        assert keys(two) == keys(one), (a, b)


def test_global_position_equals_a_sort_without_a_window_over_the_rows(spark):
    """NULLs, ties, identical rows and an empty frame; one range shuffle moves the rows."""
    from itemrollup.operators import global_position
    from itemrollup.session import new_run_dir

    def store(df):
        path = new_run_dir(spark, "position-test")
        df.write.parquet(path)
        return spark.read.parquet(path)

    data = [(None if i % 11 == 0 else (i * 37) % 101, "x" if i % 3 else None) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, t string").repartition(5)
    order = [F.col("k").desc_nulls_last(), F.col("t").asc_nulls_first()]
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep several ranges
    try:
        out = global_position(df, order, store)
        got = [tuple(r) for r in out.orderBy("position").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    want = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert got == [(k, t, i) for i, (k, t) in enumerate(want, 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window.splitlines()[1] or "Aggregate" in window.splitlines()[2]  # only the counts
    assert global_position(df.limit(0), order, store).count() == 0
