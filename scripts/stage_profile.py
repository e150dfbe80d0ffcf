"""Write docs/STAGES.md: Spark jobs, stages and seconds per lineage cut of one rebuild.

Usage: python scripts/stage_profile.py [sf_dir]
Inputs are first staged as tables (as in bench.py); the rebuild runs twice and the second
(warm) run is reported.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import itemrollup.plans.pipeline as pipeline  # noqa: E402
from itemrollup.plans import SYNTHETIC, Stager, empty_prior, rebuild_stages  # noqa: E402
from itemrollup.session import local_session, new_run_dir  # noqa: E402
from itemrollup.sources import stage_sources, synthetic_sources  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    sc = spark.sparkContext
    src = stage_sources(synthetic_sources(spark, sf), new_run_dir(spark, "sources"), 8)
    rows: list = []
    run_no = [0]
    original = pipeline.Stager.cut

    def cut(self, df, name, **metrics):
        group = f"run{run_no[0]}-cut-{name}"
        sc.setJobGroup(group, name)
        t0 = time.time()
        out = original(self, df, name, **metrics)
        jobs = sc.statusTracker().getJobIdsForGroup(group)
        stages = sum(len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs)
        rows.append((name, len(jobs), stages, time.time() - t0))
        return out

    pipeline.Stager.cut = cut
    for i in range(2):
        run_no[0] = i
        rows.clear()
        t0 = time.time()
        t = rebuild_stages(src, empty_prior(spark), SYNTHETIC, Stager(spark, True))
        Stager(spark, True).cut(t["published"], "published")
        total = time.time() - t0
    out = ["# Stage profile of one rebuild", "",
           f"`scripts/stage_profile.py` over staged inputs derived from `{sf}`, local[*], 16 shuffle partitions, "
           "AQE on; warm second run. Each row is one lineage cut (the work between the previous cut and this one).", "",
           "| cut | Spark jobs | Spark stages | sec |", "| --- | --- | --- | --- |"]
    for name, jobs, stages, sec in rows:
        out.append(f"| {name} | {jobs} | {stages} | {sec:.2f} |")
    out += [f"| **total** | {sum(r[1] for r in rows)} | {sum(r[2] for r in rows)} | {total:.1f} (incl. building) |", ""]
    os.makedirs("docs", exist_ok=True)
    with open("docs/STAGES.md", "w") as f:
        f.write("\n".join(out) + "\n")
    print("wrote docs/STAGES.md")


if __name__ == "__main__":
    main()
