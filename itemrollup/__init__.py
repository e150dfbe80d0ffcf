"""itemrollup -- a Spark-native per-item merchandise rollup and report."""

from .plans import SYNTHETIC, RollupParams, rebuild, report
from .sources import Sources, load_tables, synthetic_sources
from .sources.snapshot import publish_snapshot, read_snapshot

__all__ = ["RollupParams", "SYNTHETIC", "rebuild", "report", "Sources", "load_tables", "synthetic_sources", "publish_snapshot", "read_snapshot"]
