"""Fishery discard estimation on Spark: landings, observers, strata, bootstrap, allocation."""

from haulback.operators.allocate import assign_discards
from haulback.operators.bootstrap import bootstrap_multiplier
from haulback.operators.coverage import coverage_summary
from haulback.operators.ratio import landings_multiplier
from haulback.operators.sector import assign_sector
from haulback.operators.splits import (
    Split,
    no_panel,
    non_commercial,
    observed_quarters,
    species_sought,
)
from haulback.operators.zones import assign_zone
from haulback.plans.ready import ready_data
from haulback.session import tune
from haulback.sources.landings import LandingTables, pull_landings
from haulback.sources.observers import ObserverTables, pull_observer_trips
from haulback.sources.snapshots import write_snapshot

__all__ = [
    "LandingTables",
    "ObserverTables",
    "Split",
    "assign_discards",
    "assign_sector",
    "assign_zone",
    "bootstrap_multiplier",
    "coverage_summary",
    "landings_multiplier",
    "no_panel",
    "non_commercial",
    "observed_quarters",
    "pull_landings",
    "pull_observer_trips",
    "ready_data",
    "species_sought",
    "tune",
    "write_snapshot",
]
