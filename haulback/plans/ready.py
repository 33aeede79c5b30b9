"""From raw tables to trips ready for the estimate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, partial
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.operators.coverage import CoverageSummary, coverage_summary
from haulback.operators.lineage import cut_lineage
from haulback.operators.reconcile import TripReports, reconcile, reconciled_landings, trip_reports
from haulback.operators.sector import assign_sector
from haulback.operators.joins import Split
from haulback.operators.splits import (
    LandingSplits,
    label_landings,
    observed_quarters,
    removed_records,
    splits_of,
    trip_evidence,
)
from haulback.operators.trips import aggregate_trips, grouping_table
from haulback.operators.zones import CELL, locate, split_by_zone, with_fallback, zone_cells
from haulback.plans.accounting import Accounts, label_counts, reconciled_counts
from haulback.sources.landings import LandingTables, pull_landings
from haulback.sources.observers import (
    ObserverTables,
    panel_features,
    pull_observer_trips,
    sought_sets,
)
from haulback.sources.reports import write_reports


class ReadyData(NamedTuple):
    trips: DataFrame
    strata: DataFrame
    removed: DataFrame
    reports: TripReports
    coverage: CoverageSummary
    landings: DataFrame
    observers: DataFrame
    reconciled: DataFrame
    labelled: DataFrame
    zoned: Split
    splits: LandingSplits
    quarters: Split
    accounts: Accounts


class Matched:
    """The chain's first half: observer trips, landings as pulled, and both reconciled.

    Each table is written when it is first asked for, so a caller who needs one of them alone waits
    for no other.  ``keywords`` are those of ``reconcile``.
    """

    def __init__(
        self,
        landing_tables: LandingTables,
        observer_tables: ObserverTables,
        year: int | None = None,
        *,
        keep: Callable[[DataFrame], DataFrame] = cut_lineage,
        **keywords,
    ):
        self._landings, self._observers, self.year = landing_tables, observer_tables, year
        self.keep, self._keywords = keep, keywords
        self.accounts = Accounts()

    @cached_property
    def observers(self) -> DataFrame:
        return self.keep(pull_observer_trips(self._observers, self.year))

    @cached_property
    def wide(self) -> DataFrame:
        pulled = pull_landings(self._landings, self.year)
        return self.keep(self.accounts.watch(pulled, "pulled", {"rows": F.count(F.lit(1))}))

    @cached_property
    def labelled(self) -> DataFrame:
        met = reconcile(self.wide, self.observers, **self._keywords)
        return self.keep(self.accounts.watch(met, "reconciled", reconciled_counts()))

    @property
    def reports(self) -> TripReports:
        return trip_reports(self.labelled, self.observers)


def ready_data(
    landing_tables: LandingTables,
    observer_tables: ObserverTables,
    positions: DataFrame,
    zone_edges: DataFrame,
    year: int | None = None,
    *,
    tolerance: int = 2,
    cell: float = CELL,
    null_trip_as_blank: bool = False,
    replace_incorrect: bool = False,
    nearest_only: bool = False,
    exclusive: bool = False,
    by_record: bool = False,
    drop_fully_observed: bool = False,
    require_sector: bool = False,
    folder: str | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> ReadyData:
    """Reconcile, classify, locate, split and aggregate one year's landings.

    Where one result feeds several tables it is written once, to ``folder`` or else to the session's
    ``spark.checkpoint.dir``: the observer trips, the index of the zones, the landings as pulled, as
    reconciled, with the evidence on their trips and with the labels of all splits, and the directed
    trips and records.  ``accounts`` has the rows of every step, counted as they were written.  ``keep`` is
    another way to write a table and read it again; it must cut the lineage, as most of these are
    read several times over and the plan would double with each.
    """
    matched = Matched(
        landing_tables,
        observer_tables,
        year,
        keep=keep or partial(cut_lineage, folder=folder),
        tolerance=tolerance,
        null_trip_as_blank=null_trip_as_blank,
        replace_incorrect=replace_incorrect,
        nearest_only=nearest_only,
    )
    return ready_from(
        matched,
        observer_tables,
        positions,
        zone_edges,
        cell=cell,
        exclusive=exclusive,
        by_record=by_record,
        drop_fully_observed=drop_fully_observed,
        require_sector=require_sector,
    )


def ready_from(
    matched: Matched,
    observer_tables: ObserverTables,
    positions: DataFrame,
    zone_edges: DataFrame,
    *,
    cell: float = CELL,
    exclusive: bool = False,
    by_record: bool = False,
    drop_fully_observed: bool = False,
    require_sector: bool = False,
) -> ReadyData:
    """``ready_data`` from its first half on."""
    keep, year, accounts = matched.keep, matched.year, matched.accounts
    observers, labelled, reports = matched.observers, matched.labelled, matched.reports
    cells = keep(zone_cells(zone_edges, cell))
    sectored = assign_sector(reconciled_landings(labelled))
    located = locate(sectored, cells, "LAT", "LON", "ZONE", cell)
    zoned = with_fallback(located, observers, positions, cells, cell)
    features, sought = panel_features(observer_tables, year), sought_sets(observer_tables, year)
    evidence = trip_evidence(observers, features, sought)
    tagged = label_landings(zoned, evidence, exclusive=exclusive, keep=keep)
    tagged = keep(accounts.watch(tagged, "labelled", label_counts(exclusive)))

    by_zone = split_by_zone(tagged)
    splits = splits_of(tagged, exclusive=exclusive, by_record=by_record)
    landings = splits.directed.kept
    quarters = observed_quarters(landings)
    removed = removed_records(by_zone, *splits, quarters)
    kept = quarters.kept if drop_fully_observed else landings
    trips = aggregate_trips(kept, require_sector=require_sector)
    return ReadyData(
        trips,
        grouping_table(trips),
        removed,
        reports,
        coverage_summary(landings),
        landings,
        observers,
        labelled,
        tagged,
        by_zone,
        splits,
        quarters,
        accounts,
    )


def write_ready_data(
    ready: ReadyData, directory: str, year: int, run_date: dt.date | None = None
) -> dict[str, str]:
    """Write the five report tables and the coverage report, put in place as one set."""
    return write_reports(
        {
            "MissingTrips": ready.reports.missing,
            "ObserverCheck": ready.reports.observer_check,
            "RemovedRecords": ready.removed,
            "Aggregated": ready.trips,
            "DataforGrouping": ready.strata,
        },
        directory,
        year,
        run_date,
        coverage=ready.coverage,
    )
