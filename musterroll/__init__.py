"""Member rosters as Spark jobs: cohort, attribution, identifiers, routing, audit."""

from musterroll.config import RosterConfig
from musterroll.plans.roster import RosterRun, roster_stage, run
from musterroll.sources.catalog import RosterSources, load_sources

__all__ = [
    "RosterConfig",
    "RosterRun",
    "RosterSources",
    "load_sources",
    "roster_stage",
    "run",
]
