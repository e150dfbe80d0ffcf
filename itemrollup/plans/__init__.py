"""Stage plans of the rollup and the report."""

from .params import SYNTHETIC, RollupParams
from .pipeline import Stager, empty_prior, rebuild, rebuild_stages, report

__all__ = ["RollupParams", "SYNTHETIC", "Stager", "empty_prior", "rebuild", "rebuild_stages", "report"]
