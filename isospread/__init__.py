"""Analysis of large ensembles of gridded time series as Spark tables."""

from isospread.plans.options import RunOptions
from isospread.plans.run import analyse_members, discover_cases, run_ensemble
from isospread.registry import Ensemble, resolve_ensemble

__all__ = [
    "Ensemble",
    "RunOptions",
    "analyse_members",
    "discover_cases",
    "resolve_ensemble",
    "run_ensemble",
]
