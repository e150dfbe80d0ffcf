"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is executed completely (noop sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from itemrollup.plans import SYNTHETIC, Stager, empty_prior, rebuild_stages, report  # noqa: E402
from itemrollup.session import local_session, new_run_dir  # noqa: E402
from itemrollup.sources import stage_sources, synthetic_sources  # noqa: E402
from itemrollup.plans import sales, activity  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="itemrollup-bench")
    p = SYNTHETIC
    # Setup (not a query): derive the 32 input relations from the synthetic tables and
    # store them as tables, which is what the rollup reads in production.
    t0 = time.time()
    src = stage_sources(synthetic_sources(spark, sf_dir), new_run_dir(spark, "sources"), int(cpus))
    setup = round(time.time() - t0, 3)
    times: dict[str, float] = {}
    spread: dict[str, list[float]] = {}

    def timed(name, fn, runs=3):
        """Median of ``runs`` runs; the last run's result is returned."""
        took = []
        for _ in range(runs):
            t0 = time.time()
            out = fn()
            took.append(time.time() - t0)
        times[name] = round(statistics.median(took), 3)
        spread[name] = [round(min(took), 3), round(max(took), 3)]
        return out

    timed("sales_totals", lambda: run_noop(sales.sales_totals(src, p)))
    timed("shipment_totals", lambda: run_noop(activity.shipment_history(src, p)))

    stagers = []

    def full_run(prior):
        """A rebuild up to its published rows; the folders of the run before it are dropped."""
        while len(stagers) > (prior is not None):
            stagers.pop().close()
        stager = Stager(spark, True)
        stagers.append(stager)
        t = rebuild_stages(src, empty_prior(spark) if prior is None else prior, p, stager)
        return stager.cut(t["published"], "published")

    pub1 = timed("rebuild", lambda: full_run(None))
    timed("report", lambda: run_noop(report(pub1, src, p)))
    pub2 = timed("rebuild_second_run", lambda: full_run(pub1))
    timed("report_second_run", lambda: run_noop(report(pub2, src, p)))
    while stagers:
        stagers.pop().close()
    total = round(sum(times.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir, "cpus": int(cpus),
                      "setup_stage_sources_sec": setup, "total_with_setup_sec": round(total + setup, 3),
                      "spread": spread}))
    spark.stop()


if __name__ == "__main__":
    main()
