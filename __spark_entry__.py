"""Queries over the supplied tables, each with its statement in DuckDB SQL."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bindings import oracle as sql  # noqa: E402
from bindings import tables  # noqa: E402
from haulback import schemas  # noqa: E402
from haulback.operators import allocate, bootstrap, coverage, ratio, splits  # noqa: E402
from haulback.operators import trips, zones  # noqa: E402
from haulback.operators import reconcile as rec  # noqa: E402
from haulback.operators.joins import Split  # noqa: E402
from haulback.operators.lineage import cut_lineage, work_folder  # noqa: E402
from haulback.operators.sector import assign_sector  # noqa: E402
from haulback.plans.ready import Matched, ReadyData, ready_from, write_ready_data  # noqa: E402
from haulback.session import tune  # noqa: E402
from haulback.sources import landings, observers, positions, reports, snapshots  # noqa: E402
from haulback.sources.stored import stored_table  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


class Work:
    """The estimate over one set of tables, by the library's own chain; parts are built when first
    asked for. The steps that many queries start from are written once to the session's work folder.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.inputs = tables.inputs(tune(spark), sf_dir)

    @cached_property
    def matched(self) -> Matched:
        return Matched(self.inputs.landings, self.inputs.observers)

    @cached_property
    def ready(self) -> ReadyData:
        return ready_from(self.matched, self.inputs.observers, self.positions, self.inputs.zone_edges)

    @property
    def wide(self) -> DataFrame:
        return self.matched.wide

    @property
    def observers(self) -> DataFrame:
        return self.matched.observers

    @property
    def labelled(self) -> DataFrame:
        return self.matched.labelled

    @property
    def reports(self) -> rec.TripReports:
        return self.matched.reports

    def variant(self, **keywords) -> DataFrame:
        return rec.reconcile(self.wide, self.observers, **keywords)

    def variant_reports(self, **keywords) -> rec.TripReports:
        return rec.trip_reports(self.variant(**keywords), self.observers)

    @cached_property
    def positions(self) -> DataFrame:
        return positions.vessel_positions(self.inputs.mobile, self.inputs.fixed)

    @cached_property
    def sectored(self) -> DataFrame:
        return assign_sector(rec.reconciled_landings(self.labelled))

    @cached_property
    def cells(self) -> DataFrame:
        return cut_lineage(zones.zone_cells(self.inputs.zone_edges))

    @cached_property
    def located(self) -> DataFrame:
        return cut_lineage(zones.locate(self.sectored, self.cells, "LAT", "LON", "ZONE"))

    @cached_property
    def unlocated(self) -> DataFrame:
        return self.located.filter(~F.coalesce(F.col("ZONE") >= 1, F.lit(False)))

    @property
    def zoned(self) -> Split:
        return self.ready.zoned

    @property
    def commercial(self) -> Split:
        return self.ready.splits.commercial

    @cached_property
    def panel_features(self) -> DataFrame:
        return observers.panel_features(self.inputs.observers)

    @cached_property
    def sought_sets(self) -> DataFrame:
        return observers.sought_sets(self.inputs.observers)

    @property
    def panel(self) -> Split:
        return self.ready.splits.panel

    @property
    def sought(self) -> Split:
        return self.ready.splits.directed

    @property
    def trips(self) -> DataFrame:
        return self.ready.trips

    @cached_property
    def kept_trips(self) -> DataFrame:
        return cut_lineage(self.trips)

    @property
    def strata(self) -> DataFrame:
        return self.ready.strata

    @cached_property
    def groups(self) -> DataFrame:
        return positions.stratum_groups(tables.group_table(trips.grouping_table(self.kept_trips)))

    @cached_property
    def with_group(self) -> DataFrame:
        return bootstrap.attach_groups(self.kept_trips, self.groups)

    @cached_property
    def grouped(self) -> DataFrame:
        return bootstrap.grouped_trips(self.kept_trips, self.groups)

    @cached_property
    def boot(self) -> bootstrap.Bootstrap:
        return bootstrap.bootstrap_multiplier(
            self.kept_trips, self.groups, sql.NBOOT, seed=sql.SEED
        )

    @cached_property
    def results(self) -> DataFrame:
        return tables.group_results(self.with_group)

    @cached_property
    def totals(self) -> DataFrame:
        return allocate.vessel_totals(allocate.attach_groups_full(self.kept_trips, self.groups))

    @property
    def quarters(self) -> Split:
        return self.ready.quarters

    @property
    def coverage(self) -> coverage.CoverageSummary:
        return self.ready.coverage

    @cached_property
    def snapshot(self) -> str:
        """Folder of the written snapshot, with the pulled tables laid out by vessel and date."""
        path, i = self.folder(), self.inputs
        snapshots.write_snapshot(
            path, sql.YEAR, i.landings, i.observers, self.fleets(), self.position_classes(), buckets=8
        )
        return path

    @cached_property
    def written(self) -> dict[str, str]:
        """Paths of the written reports and coverage sheets, one set."""
        return write_ready_data(self.ready, self.folder(), sql.YEAR)

    def folder(self) -> str:
        """A new folder beside the session's written steps, for what a query writes and reads."""
        return f"{work_folder(self.spark)}/haulback/{uuid.uuid4().hex}"

    def fleets(self) -> dict[str, DataFrame]:
        """Fleet trips by gear class: even vessels mobile, odd ones fixed."""
        trip = self.inputs.landings.records.select(
            F.col("vr_number_fishing").alias("VR_NUMBER_FISHING"),
            F.col("trip_id").alias("TRIP_ID"),
            F.col("landed_date").alias("LANDED_DATE"),
        ).distinct()
        even = F.col("VR_NUMBER_FISHING") % 2 == 0
        return {"mobile": trip.filter(even), "fixed": trip.filter(~even)}

    def position_classes(self) -> dict[str, DataFrame]:
        return {"mobile": self.inputs.mobile, "fixed": self.inputs.fixed}

    def outcome(self, *names: str) -> DataFrame:
        return self.labelled.filter(F.col("OUTCOME").isin(*names))


_RECONCILED = [*schemas.LANDING]
_LANDED = [*schemas.LANDING_KEYS]
_FLEETS = """SELECT DISTINCT v AS VR_NUMBER_FISHING, k AS TRIP_ID, d AS LANDED_DATE,
    CASE WHEN v % 2 = 0 THEN 'mobile' ELSE 'fixed' END AS gear_class
    FROM lineitem JOIN ord ON l_orderkey = k WHERE year(d) = {y}"""
sql.STEPS["year_fleets"] = _FLEETS.format(y=sql.YEAR)


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _select(step: str, *rounded: str, cols: str = "*", digits: int = 6) -> str:
    if rounded:
        parts = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in rounded)
        cols = f"{cols} REPLACE ({parts})"
    return f"SELECT {cols} FROM {step}"


_OUT = sql.columns([*_LANDED, "TRIP_OBS"])
_CURVE = ("perc", "bcperc", "MEANMULT", "perc2", "bcperc2")
_SCORES = ("MULT", "ZALPHA", "Z0", "CORRECTED")


_POSITION_SNAPSHOT = f"""SELECT VR_NUMBER, POSITION_UTC_DATE, LATITUDE, LONGITUDE,
    {sql.YEAR} AS year, CASE WHEN mobile THEN 'mobile' ELSE 'fixed' END AS gear_class
    FROM positions p WHERE year("DATE") = {sql.YEAR} AND EXISTS (SELECT 1 FROM year_fleets f
    WHERE f.VR_NUMBER_FISHING = p.VR_NUMBER
    AND f.gear_class = CASE WHEN mobile THEN 'mobile' ELSE 'fixed' END)"""


def _groups_from_csv(w: Work) -> DataFrame:
    """The strata report with a GROUP column added, as its reader sees it."""
    grouped = tables.group_table(w.strata)
    path = reports.write_reports({"DataforGrouping": grouped}, w.folder(), sql.YEAR)
    return positions.read_groups(w.spark, path["DataforGrouping"])


def _landing_dates_from_text(w: Work) -> DataFrame:
    """Landing records stored with day-month-year text, read with dates."""
    path = w.folder()
    text = F.date_format("landed_date", "dd-MM-yyyy HH:mm")
    w.inputs.landings.records.withColumn("landed_date", text).write.parquet(f"{path}/records")
    read = stored_table(w.spark, f"{path}/records", schemas.RECORDS, date_format="dd-MM-yyyy")
    return read.select("trip_id", F.col("landed_date").cast("string").alias("landed_date")).distinct()


def _snapshot_round_trip(w: Work) -> DataFrame:
    parts = {
        "records": landings.LandingTables.from_parquet(w.spark, f"{w.snapshot}/landings").records,
        "positions": positions.read_positions(w.spark, w.snapshot, sql.YEAR),
        "fleets": w.spark.read.parquet(f"{w.snapshot}/fleets"),
    }
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def _positions_from_snapshot(w: Work) -> DataFrame:
    return positions.read_positions(w.spark, w.snapshot, sql.YEAR)


def _fleets_from_snapshot(w: Work) -> DataFrame:
    return w.spark.read.parquet(f"{w.snapshot}/fleets")


def _exact_matches_by_vessel(w: Work) -> DataFrame:
    """The year's landings and observer trips met where they lie."""
    return rec.exact_matches(*snapshots.read_pulled(w.spark, w.snapshot, sql.YEAR), by_vessel=True)


def _stored(group: str, name: str) -> Callable[[Work], DataFrame]:
    kinds = {"landings": landings.LandingTables, "observers": observers.ObserverTables}
    return lambda w: getattr(kinds[group].from_parquet(w.spark, f"{w.snapshot}/{group}"), name)


def _report(name: str, frame: Callable[[Work], DataFrame], fmt: str = "csv") -> Callable[[Work], DataFrame]:
    """A written report read again under the types of the frame it was written from."""

    def read(w: Work) -> DataFrame:
        reader = w.spark.read.schema(frame(w).schema)
        if fmt == "csv":
            reader = reader.options(header=True, enforceSchema=False, nullValue=None)
        found = reader.format(fmt).load(w.written[name])
        return _rounded(found, *(c for c in ("COVERAGE", "value") if c in found.columns))

    return read


_SETS_PER_TRIP = "istrips, range(3) AS sets(s)"
# Every table of the snapshot, from the supplied tables.
_SNAPSHOT_TABLES = {
    ("landings", "records"): """SELECT * REPLACE (CAST(landed_date AS VARCHAR) AS landed_date,
        CAST(date_fished AS VARCHAR) AS date_fished), 12 AS gear_code, vr_number_fishing AS licence_id,
        trip_id AS mon_doc_id, vr_number_fishing % 5 AS nafo_unit_area_id,
        vr_number_fishing % 25 AS lic_quota_id FROM records""",
    ("landings", "vessels"): "SELECT * FROM vessels",
    ("landings", "areas"): """SELECT r_regionkey AS area_id,
        CASE WHEN r_regionkey < 3 THEN '5Z' || r_name ELSE r_name END AS area FROM region""",
    ("landings", "lic_quotas"): """SELECT n_nationkey AS lic_quota_id, n_nationkey + 100 AS sflt_quota_id
        FROM nation""",
    ("landings", "sflt_quotas"): """SELECT n_nationkey + 100 AS sflt_quota_id, sflt_desc_id,
        n_nationkey % 7 AS fleet_quota_id FROM nation JOIN codes ON nation = n_nationkey""",
    ("landings", "sflt_descs"): """SELECT sflt_desc_id, n_name AS desc_eng
        FROM nation JOIN codes ON nation = n_nationkey""",
    ("landings", "fleet_quotas"): "SELECT n_nationkey AS fleet_quota_id FROM nation WHERE n_nationkey < 6",
    ("landings", "doc_attributes"): """SELECT k AS mon_doc_id,
        CASE WHEN st = 'O' AND v % 25 <> 17 THEN 742 ELSE 741 END AS column_defn_id,
        CASE WHEN st = 'F' OR v % 25 = 17 THEN 'T' || k ELSE '' END AS data_value
        FROM ord, range(CASE WHEN st = 'F' AND k % 53 = 0 THEN 2 ELSE 1 END) AS copies(n)""",
    ("observers", "isvessels"): """SELECT c_custkey AS vess_id, CAST(c_custkey AS VARCHAR) AS cfv,
        c_name AS vessel_name FROM customer""",
    ("observers", "istrips"): """SELECT k AS trip_id, v AS vess_id, TRIP AS trip, TRIPCD_ID AS tripcd_id,
        CONF_NUMBER AS conf_number, CAST(LANDED_DATE AS VARCHAR) AS landing_date FROM istrips""",
    ("observers", "isfishsets"): f"""SELECT k * 3 + s AS fishset_id, k AS trip_id, k AS gear_id, s + 1 AS set_no,
        CASE WHEN unnumbered THEN 4 WHEN k % 13 = 0 AND s = 0 THEN 7 WHEN k % 4 = 0 AND s = 2 THEN 4
            ELSE 1 END AS setcd_id, CASE WHEN k % 12 = 2 THEN 16 WHEN k % 12 = 7 THEN NULL
            WHEN (k + s) % 2 = 0 THEN 10 ELSE 11 END AS specscd_id,
        CASE WHEN v % 5 < 3 THEN '5Z' || s ELSE '4X' END AS nafarea_id FROM {_SETS_PER_TRIP}""",
    ("observers", "issetprofile"): f"""SELECT k * 3 + s AS fishset_id, p AS pntcd_id,
        CAST(d - CAST(s AS INTEGER) AS VARCHAR) AS setdate,
        CAST(40.0 + k % 4 + s * 0.25 + p * 0.125 AS DOUBLE) AS latitude,
        CAST(-(66.0 + k % 5 + s * 0.25) AS DOUBLE) AS longitude FROM {_SETS_PER_TRIP}, range(1, 3) AS points_of(p)""",
    ("observers", "isgears"): "SELECT k AS gear_id, GEARCD_ID AS gearcd_id FROM istrips",
    ("observers", "isgearfeatures"): "SELECT k AS gear_id, feature AS gearfcd_id FROM features",
}


def _definitions() -> dict[str, tuple[Callable[[Work], DataFrame], str]]:
    """Query name to its Spark form and its SQL over the oracle's steps."""
    year = sql.YEAR
    in_year = f"year(LANDED_DATE) = {year}"
    return {
        # Sources.
        "landing_records": (
            lambda w: landings.landing_records(w.inputs.landings),
            _select("landing_records"),
        ),
        "landing_records_of_year": (
            lambda w: landings.landing_records(w.inputs.landings, year),
            f"SELECT * FROM landing_records WHERE {in_year}",
        ),
        "trip_numbers": (
            lambda w: landings.trip_numbers(w.inputs.landings),
            _select("trip_numbers"),
        ),
        "species_weights": (
            lambda w: landings.species_weights(
                landings.landing_records_with_trip(w.inputs.landings)
            ),
            _select("species_weights"),
        ),
        "wide_landings": (lambda w: w.wide, _select("wide")),
        "observer_trips": (lambda w: w.observers, _select("observers")),
        "panel_features": (lambda w: w.panel_features, _select("panel_features")),
        "sought_sets": (lambda w: w.sought_sets, _select("sought_sets")),
        "observer_trips_of_year": (
            lambda w: observers.pull_observer_trips(w.inputs.observers, year),
            f"({sql.STEPS['observers']})".replace(
                "FROM points", f"FROM (SELECT * FROM points WHERE year(setdate) = {year})"
            ),
        ),
        "panel_features_of_year": (
            lambda w: observers.panel_features(w.inputs.observers, year),
            f"SELECT * FROM panel_features WHERE year(LANDING_DATE) = {year}",
        ),
        "sought_sets_of_year": (
            lambda w: observers.sought_sets(w.inputs.observers, year),
            f"SELECT * FROM sought_sets WHERE year(LANDING_DATE) = {year}",
        ),
        "vessel_positions": (
            lambda w: positions.position_days(w.positions),
            _select("positions", cols="* EXCLUDE (mobile)"),
        ),
        "stratum_groups": (lambda w: w.groups, _select("stratum_groups")),
        "fleet_snapshot": (
            lambda w: snapshots.fleet_snapshot(w.fleets(), year),
            f"SELECT *, {year} AS year FROM year_fleets",
        ),
        "position_snapshot": (
            lambda w: snapshots.position_snapshot(w.fleets(), w.position_classes(), year),
            _POSITION_SNAPSHOT,
        ),
        # Readers and sinks, written and read again.
        "groups_from_csv": (_groups_from_csv, _select("stratum_groups")),
        "landing_dates_from_text": (
            _landing_dates_from_text,
            "SELECT DISTINCT trip_id, CAST(landed_date AS VARCHAR) AS landed_date FROM records",
        ),
        "snapshot_round_trip": (
            _snapshot_round_trip,
            f"""SELECT 'records' AS name, count(*) AS n FROM records
            UNION ALL SELECT 'positions', count(*) FROM ({_POSITION_SNAPSHOT})
            UNION ALL SELECT 'fleets', count(*) FROM year_fleets""",
        ),
        "positions_from_snapshot": (
            _positions_from_snapshot,
            f"SELECT * EXCLUDE (year, gear_class) FROM ({_POSITION_SNAPSHOT})",
        ),
        "fleets_from_snapshot": (_fleets_from_snapshot, f"SELECT *, {year} AS year FROM year_fleets"),
        **{f"snapshot_{name}": (_stored(group, name), text) for (group, name), text in _SNAPSHOT_TABLES.items()},
        "exact_matches_by_vessel": (
            _exact_matches_by_vessel,
            sql.exact_of(f"SELECT * FROM wide WHERE {in_year}", year),
        ),
        "reports_round_trip": (_report("DataforGrouping", lambda w: w.strata), _select("strata", "COVERAGE")),
        "missing_trips_report": (_report("MissingTrips", lambda w: w.reports.missing), _select("missing")),
        "observer_check_report": (
            _report("ObserverCheck", lambda w: w.reports.observer_check),
            _select("check_list"),
        ),
        "removed_records_report": (_report("RemovedRecords", lambda w: w.ready.removed), _select("removed")),
        "ready_trips_report": (_report("Aggregated", lambda w: w.trips), _select("trips")),
        "coverage_round_trip": (
            _report("FLEET-ZONE-Q SUMMARY", lambda w: w.coverage.stratum),
            _select("stratum_coverage", "COVERAGE"),
        ),
        "fleet_coverage_sheet": (
            _report("FLEET SUMMARY", lambda w: w.coverage.fleet),
            _select("fleet_coverage", "COVERAGE"),
        ),
        "mean_coverage_sheet": (
            _report("MEAN COVERAGE", lambda w: w.coverage.mean),
            "SELECT 'MEAN COVERAGE' AS desc, round(avg(COVERAGE), 6) AS value FROM fleet_coverage",
        ),
        "fleets_all_observed_sheet": (
            _report("FLEETS ALL OBS", lambda w: w.coverage.fleet_all_observed),
            "SELECT * FROM fleet_coverage WHERE COVERAGE = 1",
        ),
        "strata_all_observed_sheet": (
            _report("FLEET-ZONE-Q ALL OBS", lambda w: w.coverage.stratum_all_observed),
            "SELECT * FROM stratum_coverage WHERE COVERAGE = 1",
        ),
        # Reconciliation.
        "first_observer_rows": (
            lambda w: rec.first_observer_rows(w.observers),
            _select("first_observers"),
        ),
        "exact_matches": (lambda w: rec.exact_matches(w.wide, w.observers), _select("exact")),
        "exact_equal": (
            lambda w: w.outcome(rec.EXACT_EQUAL).select(*_RECONCILED),
            f"SELECT {sql.columns(_RECONCILED)} FROM exact_equal",
        ),
        "exact_differ": (
            lambda w: w.outcome(rec.EXACT_DIFFER).select(*_RECONCILED, "TRIP_LANDING", "TRIP_OBS"),
            f"SELECT {sql._REPAIRED}, TRIP AS TRIP_LANDING, TRIP_OBS FROM exact_differ",
        ),
        "near_matches": (
            lambda w: _near(w),
            f"""SELECT {_OUT}, TRIPCD_OBS IS NOT NULL AS MATCHED FROM near""",
        ),
        "near_equal": (
            lambda w: w.outcome(rec.NEAR_EQUAL).select(*_RECONCILED),
            f"SELECT {sql.columns(_RECONCILED)} FROM near_equal",
        ),
        "near_differ": (
            lambda w: w.outcome(rec.NEAR_DIFFER).select(*_RECONCILED, "TRIP_LANDING", "TRIP_OBS"),
            f"SELECT {sql._REPAIRED}, TRIP AS TRIP_LANDING, TRIP_OBS FROM near_differ",
        ),
        "unobserved_landings": (
            lambda w: w.outcome(rec.UNOBSERVED).select(*_RECONCILED),
            f"SELECT {sql.columns(_RECONCILED)} FROM unobserved",
        ),
        "absent_landings": (
            lambda w: w.outcome(rec.NOT_IN_OBSERVER_DATA).select(*_RECONCILED),
            f"SELECT {sql.columns(_RECONCILED)} FROM absent",
        ),
        "reconciled_landings": (
            lambda w: rec.reconciled_landings(w.labelled),
            _select("reconciled"),
        ),
        "reconciled_null_as_blank": (
            lambda w: rec.reconciled_landings(w.variant(null_trip_as_blank=True)),
            _select("as_blank"),
        ),
        "reconciled_replacing_incorrect": (
            lambda w: rec.reconciled_landings(w.variant(replace_incorrect=True)),
            _select("replaced"),
        ),
        "reconciled_nearest_only": (
            lambda w: rec.reconciled_landings(w.variant(nearest_only=True)),
            _select("nearest_reconciled"),
        ),
        "trip_errors": (lambda w: w.reports.errors, _select("errors")),
        "missing_trips": (lambda w: w.reports.missing, _select("missing")),
        "incorrect_trips": (lambda w: w.reports.incorrect, _select("incorrect")),
        **{
            f"{report}_{name}": (
                lambda w, report=report, keyword=keyword: getattr(
                    w.variant_reports(**{keyword: True}), report.removesuffix("_trips").removeprefix("trip_")
                ),
                _select(f"{report.removesuffix('_trips').removeprefix('trip_')}{step}"),
            )
            for report in ("trip_errors", "missing_trips")
            for name, keyword, step in (
                ("null_as_blank", "null_trip_as_blank", "_as_blank"),
                ("replacing_incorrect", "replace_incorrect", ""),
                ("nearest_only", "nearest_only", "_nearest"),
            )
        },
        "absent_trips": (
            lambda w: rec.not_in_observer_data(w.labelled),
            _select("absent_trips"),
        ),
        "observer_check": (lambda w: w.reports.observer_check, _select("check_list")),
        # Sector and zone.
        "sectors": (lambda w: w.sectored, _select("sectored")),
        "reported_zones": (lambda w: w.located, _select("located")),
        "mean_positions": (
            lambda w: zones.mean_positions(
                w.positions, w.unlocated.filter("TRIP IS NULL OR TRIP = ''")
            ),
            _select("mean_positions"),
        ),
        "corrected_zones": (
            lambda w: zones.corrected_zones(w.unlocated, w.observers, w.positions, w.cells),
            _select("corrected"),
        ),
        "zoned_landings": (lambda w: w.zoned.kept, _select("zoned")),
        "no_zone_landings": (lambda w: w.zoned.removed, _select("no_zone")),
        # Splits.
        "commercial_landings": (lambda w: w.commercial.kept, _select("commercial")),
        "non_commercial_landings": (lambda w: w.commercial.removed, _select("non_commercial")),
        "panel_landings": (lambda w: w.panel.kept, _select("panel")),
        "no_panel_landings": (lambda w: w.panel.removed, _select("no_panel")),
        "panel_landings_exclusive": (
            lambda w: splits.no_panel(
                w.commercial.kept, w.panel_features, exclusive=True
            ).kept,
            _select("panel_exclusive"),
        ),
        "other_species_landings": (
            lambda w: _by_reason(w, splits.OTHER_SPECIES_COMMENT),
            _select("other_species"),
        ),
        "all_cod_landings": (
            lambda w: _by_reason(w, splits.ALL_COD_COMMENT),
            _select("all_cod"),
        ),
        "last_cod_landings": (
            lambda w: _by_reason(w, splits.LAST_COD_COMMENT),
            f"SELECT {sql._FILLED} FROM last_cod",
        ),
        "pollock_landings": (
            lambda w: _by_reason(w, splits.POLLOCK_COMMENT),
            f"SELECT {sql._FILLED} FROM pollock",
        ),
        "directed_landings": (lambda w: w.sought.removed, _select("directed")),
        "sought_landings": (lambda w: w.sought.kept, _select("sought")),
        "sought_landings_by_record": (
            lambda w: splits.splits_of(w.ready.labelled, by_record=True).directed.kept,
            _select("sought_by_record"),
        ),
        # Coverage.
        "fleet_coverage": (
            lambda w: _rounded(w.coverage.fleet, "COVERAGE"),
            _select("fleet_coverage", "COVERAGE"),
        ),
        "mean_coverage": (
            lambda w: w.coverage.mean.withColumn(
                "value", F.round("value", 6)
            ),
            "SELECT 'MEAN COVERAGE' AS desc, round(avg(COVERAGE), 6) AS value FROM fleet_coverage",
        ),
        "fleets_all_observed": (
            lambda w: w.coverage.fleet_all_observed,
            "SELECT * FROM fleet_coverage WHERE COVERAGE = 1",
        ),
        "stratum_coverage": (
            lambda w: _rounded(w.coverage.stratum, "COVERAGE"),
            _select("stratum_coverage", "COVERAGE"),
        ),
        "strata_all_observed": (
            lambda w: w.coverage.stratum_all_observed,
            "SELECT * FROM stratum_coverage WHERE COVERAGE = 1",
        ),
        "fully_observed_strata": (
            lambda w: splits.fully_observed_strata(w.sought.kept),
            _select("full_strata"),
        ),
        "quarter_landings": (
            lambda w: w.quarters.kept,
            _select("quarter_kept"),
        ),
        "fully_observed_landings": (
            lambda w: w.quarters.removed,
            _select("quarter_removed"),
        ),
        "removed_records": (lambda w: w.ready.removed, _select("removed")),
        # Trips and multiplier.
        "ready_trips": (lambda w: w.trips, _select("trips")),
        "ready_data_trips": (lambda w: w.kept_trips, _select("trips")),
        "ready_trips_not_fully_observed": (
            lambda w: trips.aggregate_trips(
                w.quarters.kept
            ),
            sql.trips_of("quarter_kept"),
        ),
        "ready_trips_with_sector": (
            lambda w: trips.aggregate_trips(w.sought.kept, require_sector=True),
            "SELECT * FROM trips WHERE SECTOR IS NOT NULL",
        ),
        "grouping_table": (
            lambda w: _rounded(trips.grouping_table(w.trips), "COVERAGE"),
            _select("strata", "COVERAGE"),
        ),
        "landings_multiplier": (
            lambda w: _rounded(ratio.landings_multiplier(w.trips), "MULTIPLIER"),
            _select(f"({sql.multiplier('trips')})", "MULTIPLIER"),
        ),
        "landings_multiplier_by_sector": (
            lambda w: _rounded(ratio.landings_multiplier(w.trips, ["SECTOR"]), "MULTIPLIER"),
            _select(f"({sql.multiplier('trips', 'SECTOR')})", "MULTIPLIER"),
        ),
        "grouped_trips": (lambda w: w.grouped, _select("grouped")),
        # Bootstrap.
        "bootstrap_replicates": (
            lambda w: _rounded(w.boot.replicates, "MULT"),
            _select("replicates", "MULT"),
        ),
        "bootstrap_replicates_in_small_blocks": (
            lambda w: _rounded(
                bootstrap.bootstrap_multiplier(
                    w.kept_trips, w.groups, sql.NBOOT, seed=sql.SEED, block_size=sql.SMALL_BLOCK
                ).replicates,
                "MULT",
            ),
            _select("replicates_small", "MULT"),
        ),
        "bootstrap_scores": (
            lambda w: _rounded(
                bootstrap.ranked_scores(w.boot.replicates, sql.NBOOT).drop("PLAIN"), *_SCORES
            ),
            _select("scores", *_SCORES, cols="* EXCLUDE (AT_MOST)"),
        ),
        "bootstrap_summary": (
            lambda w: _rounded(w.boot.summary, "MEANMULT", "VAR").withColumn(
                "BIAS", F.round("BIAS", 6) + 0.0
            ),
            """SELECT "GROUP", round(MEANMULT, 6) AS MEANMULT, round(VAR, 6) AS VAR,
            round(BIAS, 6) + 0 AS BIAS FROM summary""",
        ),
        "bootstrap_curves": (
            lambda w: _rounded(w.boot.curves, *_CURVE, digits=4),
            _select("curves", *_CURVE, digits=4),
        ),
        # Allocation.
        "grouped_with_empty_strata": (
            lambda w: allocate.attach_groups_full(w.kept_trips, w.groups),
            _select("full_groups"),
        ),
        "vessel_totals": (lambda w: w.totals, _select("totals")),
        "significant_totals": (
            lambda w: allocate.significant_totals(w.totals, w.results),
            _select("significant"),
        ),
        "vessel_discards": (
            lambda w: _rounded(
                allocate.assign_discards(w.kept_trips, w.groups, w.results), "DISCARDS"
            ),
            _select("discards", "DISCARDS"),
        ),
        "vessel_discards_ignoring_empty": (
            lambda w: _rounded(
                allocate.assign_discards(w.kept_trips, w.groups, w.results, ignore_empty=True),
                "DISCARDS",
            ),
            _select("discards_known", "DISCARDS"),
        ),
    }


def _near(w: Work) -> DataFrame:
    exact = rec.exact_matches(w.wide, w.observers)
    rest = exact.filter(F.col("TRIPCD_OBS").isNull()).drop("TRIP_OBS", "TRIPCD_OBS")
    near = rec.near_matches(rest, w.observers)
    return rec.repeat_rows(near, "N_NEAR").select(
        *_LANDED,
        F.col("TRIP_NEAR").alias("TRIP_OBS"),
        F.coalesce("CODED", F.lit(False)).alias("MATCHED"),
    )


def _by_reason(w: Work, reason: str) -> DataFrame:
    return w.sought.removed.filter(F.col("COMMENT") == reason).drop("COMMENT")


def _dates_as_text(df: DataFrame) -> DataFrame:
    dates = {n: F.col(n).cast("string") for n, t in df.dtypes if t == "date"}
    return df.withColumns(dates) if dates else df


_STARTED: dict[tuple[str, ...], Work] = {}


def work(spark: SparkSession, sf_dir: str) -> Work:
    """The steps of a session over the files of a folder as they are now, shared by its queries."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{{{','.join(tables.SUPPLIED)}}}.parquet")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    state = [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in found]
    key = (spark.sparkContext.applicationId, sf_dir, *state)
    if key not in _STARTED:
        _STARTED[key] = Work(spark, sf_dir)
    return _STARTED[key]


def _query(build: Callable[[Work], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _dates_as_text(build(work(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Landings multiplier of every sector, from the raw tables."""
    w = work(spark, SMOKE_DIR)
    return ratio.landings_multiplier(w.trips, ["SECTOR"])


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and statements of the training-data operators; none where the subpackage is absent."""
    try:
        import corpus_pipeline
        from haulback.llm import queries as llm
    except ImportError:
        return {}, {}

    statement = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.SQL, **statement}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: _query(build) for name, (build, _) in _definitions().items()}
    return own | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    own = {
        name: sql.statement(select if name in _WITHOUT_DATES else _dates_as_text_sql(select))
        for name, (_, select) in _definitions().items()
    }
    return own | _training_data()[1]


def _dates_as_text_sql(select: str) -> str:
    return f"""SELECT COLUMNS(lambda c: c NOT LIKE '%DATE%'),
    CAST(COLUMNS(lambda c: c LIKE '%DATE%') AS VARCHAR) FROM ({select})"""


_WITHOUT_DATES = {
    "trip_numbers", "stratum_groups", "fleet_coverage", "mean_coverage", "fleets_all_observed",
    "stratum_coverage", "strata_all_observed", "fully_observed_strata", "grouping_table",
    "landings_multiplier", "landings_multiplier_by_sector", "grouped_trips",
    "bootstrap_replicates", "bootstrap_replicates_in_small_blocks", "bootstrap_scores",
    "bootstrap_summary", "bootstrap_curves",
    "vessel_totals", "significant_totals", "vessel_discards", "vessel_discards_ignoring_empty",
    "groups_from_csv", "landing_dates_from_text", "snapshot_round_trip", "reports_round_trip", "coverage_round_trip",
    "fleet_coverage_sheet", "mean_coverage_sheet", "fleets_all_observed_sheet", "strata_all_observed_sheet",
    *(f"snapshot_{name}" for _, name in _SNAPSHOT_TABLES),
}
