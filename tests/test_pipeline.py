"""End-to-end: every registered query against the DuckDB oracle, snapshots, feedback loop, plans."""

import importlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

import oracle_compare


def test_all_registered_queries_match_oracle(spark):
    res = oracle_compare.compare(spark, SF_SMALL)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad
    entry = importlib.import_module("__spark_entry__")
    assert set(oracle_compare.registered()) <= set(entry.queries()) and set(oracle_compare.registered()) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0 and "pct_sold" in df.columns and len(df.columns) == 43


def test_snapshot_cycle_detects_reorders(spark, small_sources):
    from itemrollup.plans.params import SYNTHETIC
    import glob

    from itemrollup.session import staging_root
    from itemrollup.sources.snapshot import read_snapshot, versions
    from itemrollup.streaming import run_cycle

    before = set(glob.glob(staging_root(spark).removeprefix("file:") + "/itemrollup/rebuild-*"))
    root = tempfile.mkdtemp(prefix="itemrollup-snap-") + "/rollup"
    v1 = run_cycle(small_sources, SYNTHETIC, root, version=1)
    first = read_snapshot(spark, root)
    assert first.where(F.col("parent") == "TBRI").count() == 0
    v2 = run_cycle(small_sources, SYNTHETIC, root, version=2)
    assert (v1, v2) == (1, 2)
    assert versions(spark, root).count() == 2
    second = read_snapshot(spark, root)
    assert second.where(F.col("parent") == "TBRI").count() > 0
    # the first version is unchanged by the second publish
    assert read_snapshot(spark, root, 1).count() == first.count()
    # both runs deleted their own staged intermediates
    staged = staging_root(spark).removeprefix("file:") + "/itemrollup"
    assert set(glob.glob(staged + "/rebuild-*")) <= before


def test_snapshot_versions_are_written_once_and_read_whole(spark):
    from itemrollup.sources.snapshot import publish_snapshot, read_snapshot, versions

    base = tempfile.mkdtemp(prefix="itemrollup-snap-")
    assert read_snapshot(spark, base + "/none") is None
    root = base + "/rollup"
    publish_snapshot(spark.range(5).toDF("x"), root, 1)
    with pytest.raises(ValueError):
        publish_snapshot(spark.range(5).toDF("x"), root, 1)
    assert read_snapshot(spark, root).count() == 5
    # rows without a pointer are not visible, whatever marker their folder has
    spark.range(9).toDF("x").write.parquet(root + "/snapshot_version=2-left")
    assert read_snapshot(spark, root).count() == 5 and versions(spark, root).count() == 1
    publish_snapshot(spark.range(7).toDF("x"), root, 2)
    assert read_snapshot(spark, root).count() == 7 and read_snapshot(spark, root, 1).count() == 5
    # a pointer that is being written (empty) is not a version yet
    open(root + "/_published/3", "w").close()
    assert read_snapshot(spark, root).count() == 7
    os.makedirs(base + "/junk/other")
    with pytest.raises(ValueError):
        read_snapshot(spark, base + "/junk")


def test_snapshots_need_no_commit_marker(spark):
    from itemrollup.sources.snapshot import publish_snapshot, read_snapshot

    root = tempfile.mkdtemp(prefix="itemrollup-snap-") + "/rollup"
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        publish_snapshot(spark.range(5).toDF("x"), root, 1)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not [f for _, _, names in os.walk(root) for f in names if f == "_SUCCESS"]
    assert read_snapshot(spark, root).count() == 5


def test_of_two_publishers_of_one_version_the_first_wins(spark):
    """The second one has listed the versions before the first created its pointer."""
    from itemrollup.sources.snapshot import publish_snapshot, read_snapshot

    root = tempfile.mkdtemp(prefix="itemrollup-snap-") + "/rollup"
    with pytest.raises(ValueError):
        publish_snapshot(spark.range(9).toDF("x"), root, 1, check=lambda: publish_snapshot(spark.range(5).toDF("x"), root, 1))
    assert read_snapshot(spark, root, 1).count() == 5
    assert len([n for n in os.listdir(root) if n.startswith("snapshot_version=1-")]) == 1  # the loser's rows are gone

    def fails():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        publish_snapshot(spark.range(9).toDF("x"), root, 2, check=fails)
    assert read_snapshot(spark, root).count() == 5 and not [n for n in os.listdir(root) if n.startswith("snapshot_version=2")]


def test_a_duplicated_key_stops_the_publish(spark, small_sources):
    """Observed while the run's tables are written: no job more than without the check."""
    from dataclasses import replace

    from itemrollup.plans import SYNTHETIC
    from itemrollup.plans.contracts import ContractError
    from itemrollup.sources.snapshot import read_snapshot
    from itemrollup.streaming import run_cycle

    root = tempfile.mkdtemp(prefix="itemrollup-snap-") + "/rollup"
    twice = replace(small_sources, section=small_sources.section.unionByName(small_sources.section))
    with pytest.raises(ContractError) as e:  # the synthetic wholesale lines spell numbers in two ways
        run_cycle(twice, SYNTHETIC, root, 1, unique_keys=True)
    assert "section master" in str(e.value) and "published rows" in str(e.value) and "item master rows" not in str(e.value)
    assert read_snapshot(spark, root) is None
    one = replace(small_sources, sop_line_open=small_sources.sop_line_open.withColumn("item_number", F.trim("item_number")),
                  sop_line_history=small_sources.sop_line_history.withColumn("item_number", F.trim("item_number")))
    one = replace(one, **{n: getattr(one, n).withColumn("item_number", F.expr("right(concat(repeat('0', 20), item_number), 20)")) for n in ("sop_line_open", "sop_line_history")})
    assert run_cycle(one, SYNTHETIC, root, 1, unique_keys=True) == 1


def test_a_failed_stage_does_not_end_later_queries(spark, monkeypatch):
    from itemrollup import queries
    from itemrollup.plans import pipeline

    key = (spark.sparkContext.applicationId, SF_SMALL, False)
    monkeypatch.setattr(queries, "_RUNS", {})
    real = pipeline.lines.order_lines
    monkeypatch.setattr(pipeline.lines, "order_lines", lambda src: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries.run(spark, SF_SMALL, stage="ship_hist")
    assert key not in queries._RUNS
    monkeypatch.setattr(pipeline.lines, "order_lines", real)
    assert queries.run(spark, SF_SMALL, stage="ship_hist").count() > 0


def test_document_numbers_hold_the_whole_order_key(spark):
    """Orders whose keys agree in the last six digits keep their own headers and lines."""
    from itemrollup.sources.synthetic import RAW_TABLES, VIEWS

    raw = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in RAW_TABLES}
    far = lambda df, key: df.unionByName(df.withColumn(key, F.col(key) + 7_000_000_000))
    raw |= {"orders": far(raw["orders"], "o_orderkey"), "lineitem": far(raw["lineitem"], "l_orderkey")}
    view = lambda name: spark.sql(VIEWS[name], **raw)
    for header, line, key in (("order_header", "order_line", "po_number"), ("sop_header_open", "sop_line_open", "sop_number")):
        h, n = view(header).select(key), view(line).select(key)
        assert h.distinct().count() == h.count()
        assert n.join(h, key).count() == n.count()
    assert view("sr_header").select("shipment_no").distinct().count() == view("sr_header").count()


def test_rebuild_is_deterministic_under_reshuffled_inputs(spark, small_sources):
    from dataclasses import replace

    from itemrollup.plans import SYNTHETIC, rebuild

    a = rebuild(small_sources, None, SYNTHETIC, stage=True)
    shuffled = replace(small_sources, order_line=small_sources.order_line.repartition(7),
                       sales_item=small_sources.sales_item.repartition(5))
    b = rebuild(shuffled, None, SYNTHETIC, stage=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_cartesian_or_nested_loop_in_rebuild(spark, small_sources):
    """Every stage plan (each starts at the previous lineage cut) is free of slow-path nodes."""
    from itemrollup.plans import SYNTHETIC, Stager, empty_prior, rebuild_stages

    t = rebuild_stages(small_sources, empty_prior(spark), SYNTHETIC, Stager(spark, True))
    for name, df in t.items():
        plan = _plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_store_sales_read_the_sales_fact_once(spark, small_sources):
    from itemrollup.plans import SYNTHETIC, sales

    df = sales.sales_rekeyed_totals(small_sources, SYNTHETIC, sales.alias_items(small_sources))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the sales fact is derived from lineitem: exactly one lineitem relation feeds the totals
    assert plan.count("l_extendedprice") >= 1
    phys = _plan(df)
    assert phys.count("lineitem.parquet") == 1, phys


@pytest.mark.parametrize("name", ["not_in_null_semantics", "buyer_initials"])
def test_simple_queries_have_pushed_filters_and_pruned_columns(spark, name):
    entry = importlib.import_module("__spark_entry__")
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "ReadSchema" in plan
    if name == "not_in_null_semantics":
        assert "GreaterThanOrEqual(l_shipdate" in plan and "l_comment" not in plan


def test_load_tables_round_trip_gives_the_same_rollup(spark, small_sources):
    """Stored relations read back with ``load_tables`` produce the same rollup as the derived views."""
    from itemrollup.plans import SYNTHETIC, rebuild
    from itemrollup.session import new_run_dir
    from itemrollup.sources import load_tables, stage_sources

    root = new_run_dir(spark, "sources-test")
    stage_sources(small_sources, root, files_per_table=2)
    loaded = load_tables(spark, root)
    a = rebuild(small_sources, None, SYNTHETIC)
    b = rebuild(loaded, None, SYNTHETIC)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_cluster_conf_sizes_partitions():
    from itemrollup.session import cluster_conf

    small = cluster_conf(10 << 30)
    big = cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) <= 64 << 20


def test_report_is_ordered_by_last_received_then_pct_sold(spark):
    """T1 on real rows: last received descending (NULLs last), then sell-through descending."""
    import __spark_entry__ as entry_module
    from itemrollup.queries import run

    rep = entry_module.entry(spark).collect()
    keys = [(r.last_received, r.item_code) for r in rep]
    dates = [k[0] for k in keys]
    non_null = [d for d in dates if d is not None]
    assert non_null == sorted(non_null, reverse=True)
    assert all(d is None for d in dates[len(non_null):])
    # within one received date (the synthetic dates are midnights) sell-through is non-increasing
    for prev, cur in zip(rep, rep[1:]):
        if prev.last_received == cur.last_received and prev.pct_sold is not None and cur.pct_sold is not None:
            assert prev.pct_sold >= cur.pct_sold
    assert run(spark, SF_SMALL).count() >= len(rep)


def test_flagship_schema_is_the_report_contract(spark):
    from itemrollup.plans.contracts import REPORT

    entry = importlib.import_module("__spark_entry__")
    got = [(f.name, f.dataType.simpleString()) for f in entry.entry(spark).schema.fields]
    assert got == [(f.name, f.dataType.simpleString()) for f in REPORT.fields]


def test_only_run_folders_are_deleted(spark):
    from itemrollup.session import drop_run_dir

    kept = tempfile.mkdtemp(prefix="itemrollup-kept-")
    with pytest.raises(ValueError):
        drop_run_dir(spark, kept)
    assert os.path.isdir(kept)


def test_early_stages_run_no_later_group(spark):
    """A candidate stage is answered while the publish group has not been run."""
    from itemrollup import queries

    before, queries._RUNS = queries._RUNS, {}
    try:
        assert queries.QUERIES["warehouse_receipts"][0](spark, SF_SMALL).count() > 0
        (_, trace), = queries._RUNS.values()
        assert "received" in trace and "w18" not in trace and "published" not in trace
    finally:
        queries._RUNS = before


def test_padded_and_respelled_codes_give_the_same_rollup(spark, small_sources):
    """Trailing blanks in all text and lower-case codes: equal to the plain input after ingest."""
    from itemrollup.plans import SYNTHETIC, rebuild
    from itemrollup.session import new_run_dir
    from itemrollup.sources import CODE_COLUMNS, RELATIONS, load_catalog, load_relations, load_tables, stage_sources

    root = new_run_dir(spark, "sources-test")
    stage_sources(small_sources, root, files_per_table=1)

    def padded(name):
        df = spark.read.parquet(f"{root}/{name}")
        text = lambda c: F.concat(F.lower(c) if c in CODE_COLUMNS else F.col(c), F.lit("  ")).alias(c)
        return df.select(*[text(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])

    plain, other = rebuild(load_tables(spark, root), None, SYNTHETIC), rebuild(load_relations(padded), None, SYNTHETIC)
    assert plain.count() > 0
    assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0

    spark.sql("CREATE DATABASE IF NOT EXISTS rollup_sources")
    for name in RELATIONS[:32]:
        spark.sql(f"CREATE TABLE IF NOT EXISTS rollup_sources.{name} USING parquet LOCATION '{root}/{name}'")
    assert load_catalog(spark, "rollup_sources").product.exceptAll(load_tables(spark, root).product).count() == 0


def test_channel_rows_reach_the_published_rollup(spark):
    """Online and cross-store sales change rows, and an item without store sales stays without (Q14)."""
    from itemrollup.plans.params import GENERIC_CROSS_STORE_ITEM
    from itemrollup.queries import run
    from itemrollup.sources.synthetic import GENERIC_ITEM

    assert GENERIC_ITEM == GENERIC_CROSS_STORE_ITEM
    assert run(spark, SF_SMALL, stage="cross_store").count() > 50
    channels = run(spark, SF_SMALL, stage="cross_store").select("item_code").unionByName(run(spark, SF_SMALL, stage="online").select("item_code"))
    before, after = run(spark, SF_SMALL, stage="w23"), run(spark, SF_SMALL, stage="w26")
    unsold = before.where("qty_sold is null").join(channels, "item_code", "left_semi").select("item_code")
    assert after.join(unsold, "item_code", "left_semi").where("qty_sold is not null").count() == 0
    assert run(spark, SF_SMALL).where("online_qty_sold > 0").count() > 0
