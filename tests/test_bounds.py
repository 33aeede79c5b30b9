"""What a task holds and what is shuffled do not follow from a few hot keys or from the tables' size."""

import glob
import re

import pytest

from haulback import schemas, tune
from haulback.operators import allocate, bootstrap, splits
from haulback.operators import reconcile as rec
from haulback.operators.lineage import cut_lineage
from haulback.operators.zones import mean_positions
from haulback.plans.ready import Matched
from haulback.sources.landings import LandingTables, pull_landings
from haulback.sources.observers import ObserverTables, pull_observer_trips
from tests.frames import DAY, observers, trips, values, zoned
from tests.test_plans import plan, stored  # noqa: F401

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FILES = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def large(spark):
    """No table is small enough to be sent unless the code says so."""
    before = {k: spark.conf.get(k) for k in (THRESHOLD, ADVISORY, FILES)}
    spark.conf.set(THRESHOLD, "-1")
    yield tune(spark)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_fleets_are_sent_to_the_records(large, stored):  # noqa: F811
    wide = pull_landings(LandingTables.from_parquet(large, stored), 2023)
    assert "hashpartitioning(lic_quota_id" not in plan(wide)
    assert [r.SFLT_DESC_ID for r in wide.collect()] == [90]


def test_strata_are_sent_to_the_landings_and_trips(large):
    split = splits.observed_quarters(zoned(large, {"TRIP": "T"}, {"Q": 3}))
    assert "SortMergeJoin" not in plan(split.kept) and split.kept.count() == split.removed.count() == 1
    groups = large.createDataFrame([(90, 1, 2, "A"), (90, None, 2, "B")], schemas.GROUPS)
    grouped = bootstrap.attach_groups(trips(large, {}, {"ZONE": None}), groups)
    assert "SortMergeJoin" not in plan(grouped) and values(grouped, "GROUP") == [("A",), ("B",)]


def test_groups_are_not_shuffled_whole(large):
    groups = large.createDataFrame([(90, 1, 2, "A")], schemas.GROUPS)
    own = trips(large, {"TRIP_ID": 1}, {"TRIP_ID": 2, "HAD": 3.0})
    numbered = bootstrap.number_rows(bootstrap.grouped_trips(own, groups))
    results = large.createDataFrame([("A", "Y", 8.0)], schemas.GROUP_RESULTS)
    shared = allocate.assign_discards(own, groups, results)
    for df in (numbered, shared):
        assert not re.search(r"SortMergeJoin \[_?GROUP#\d+\]", plan(df), re.I)
    assert values(numbered, "IDX") == [(0,), (1,)] and values(shared, "DISCARDS") == [(8.0,)]


def test_positions_are_folded_where_they_are_read(large):
    stamp = DAY.strftime("%Y/%m/%d")
    rows = [(3, f"{stamp} 01:00:00", 1.0, -2.0), (3, f"{stamp} 02:00:00", 2.0, None), (3, f"{stamp} 03:00:00", None, None),
            (4, f"{stamp} 01:00:00", None, 5.0), (3, "2023/01/01 00:00:00", 9.0, 9.0)]
    means = mean_positions(large.createDataFrame(rows, schemas.POSITIONS), zoned(large, {"VR_NUMBER_FISHING": 3}, {"VR_NUMBER_FISHING": 4}))
    assert "partial_sum(LATITUDE" in plan(means)
    assert values(means, "VR_NUMBER", "DATE", "MEAN_LAT", "MEAN_LON") == [(3, DAY, 1.5, -2.0), (4, DAY, None, 5.0)]


def test_points_are_folded_by_set_where_they_are_read(large, stored):  # noqa: F811
    pulled = pull_observer_trips(ObserverTables.from_parquet(large, stored), 2023)
    assert re.search(r"keys=\[fishset_id#\d+L\], functions=\[partial_min\(setdate", plan(pulled))
    assert values(pulled, "TRIP", "MINDATE", "LAT", "LON") == [("T1", DAY, 40.5, -66.0)]


def test_landings_are_shuffled_once_for_both_directed_tables(large):
    land = zoned(large, {"TRIP_ID": 5, "100": 9.0, "110": 1.0}, {"TRIP_ID": None, "100": 9.0, "110": 1.0}, {"100": 1.0, "110": 9.0})
    none = large.createDataFrame([], "TRIP string, X int")
    evidence = splits.trip_evidence(
        observers(large, {"TRIP": "T1"}), none.withColumnRenamed("X", "GEARFCD_ID"), none.withColumnRenamed("X", "SPECSCD_ID")
    )
    labelled = splits.label_landings(land, evidence, keep=cut_lineage)
    assert len(re.findall(r"hashpartitioning\(coalesce\(TRIP_ID", plan(labelled))) == 1
    assert "hashpartitioning(coalesce(VR_NUMBER_FISHING" not in plan(labelled)
    assert labelled.columns == [*schemas.ZONED, "NON_COMMERCIAL", "N_BARE", "N_PANEL", "N_OTHER", "N_KEPT", "ALL_COD", "LAST_COD", "POLLOCK", "TWIN"]
    assert values(labelled, "TRIP_ID", "TWIN") == [(1, False), (5, True), (None, True)]


def test_first_half_writes_what_is_asked_for(spark, stored):  # noqa: F811
    kept = []

    def keep(df):
        kept.append(df.columns)
        return cut_lineage(df)

    half = Matched(LandingTables.from_parquet(spark, stored), ObserverTables.from_parquet(spark, stored), 2023, keep=keep)
    assert rec.first_observer_rows(half.observers).count() == 1 and len(kept) == 1
    assert half.labelled.count() == 1 and len(kept) == 3 and half.reports.errors.count() == 0


def test_a_task_takes_a_bounded_share(large):
    large.conf.set(ADVISORY, "64MB")
    large.conf.set(FILES, "2000")
    tune(large)
    assert (large.conf.get(ADVISORY), large.conf.get(FILES)) == (f"{4 << 20}b", "2000")


def test_written_steps_are_packed_tightly(spark, tmp_path):
    cut_lineage(spark.range(3), str(tmp_path))
    assert glob.glob(f"{tmp_path}/**/*.zstd.parquet", recursive=True)
