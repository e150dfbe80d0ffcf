"""Cross-run state: the published snapshot feeds the next rebuild.

The original procedures have no stream, watermark or trigger; their only
state carried between runs is the previously published rollup, which the
next rebuild reads to detect reorders.  ``run_cycle`` is that loop: read the
latest snapshot as ``prior``, rebuild, publish a new version.  A scheduler
(or a ``foreachBatch`` of a trigger stream, when new source data arrives in
batches) calls it once per refresh.
"""

from __future__ import annotations

from ..plans.contracts import check_unique_keys
from ..plans.params import RollupParams
from ..plans.pipeline import Stager, empty_prior, observed, rebuild_stages, rows_seen
from ..sources import Sources
from ..sources.snapshot import publish_snapshot, read_snapshot


def run_cycle(src: Sources, params: RollupParams, snapshot_root: str, version: int | None = None, unique_keys: bool = False) -> int:
    """One refresh: previous snapshot -> rebuild -> new snapshot version (returned).

    With ``unique_keys`` a duplicated key in the item or section master or in the published totals
    stops the publish (``ContractError``); it is observed while the run's own tables are written, so
    no job is added.  Without it duplicates give what they gave in the original.
    The run's staged intermediates are deleted once the version is committed, or the run failed.
    """
    spark = src.product.sparkSession
    prior = read_snapshot(spark, snapshot_root)
    if prior is None:
        prior = empty_prior(spark)
    stager = Stager(spark, True)
    try:
        published = rebuild_stages(src, prior, params, stager)["published"]
        published, rows = observed(published, published_rows=rows_seen())
        check = (lambda: check_unique_keys(stager.seen | rows())) if unique_keys else None
        return publish_snapshot(published, snapshot_root, version, check)
    finally:
        stager.close()


__all__ = ["run_cycle"]
