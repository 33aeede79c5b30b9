"""The plans are the ones meant: equi-joins, pushed filters, no Python."""

import datetime as dt
import math

import pytest

from haulback import schemas
from haulback.operators import allocate, bootstrap, splits, zones
from haulback.operators import reconcile as rec
from haulback.operators.lineage import cut_lineage
from haulback.sources.landings import LandingTables, pull_landings
from haulback.sources.observers import ObserverTables, pull_observer_trips
from tests.frames import landings, observers, trips, zoned

SCHEMAS = {
    "records": schemas.RECORDS, "vessels": schemas.VESSELS, "areas": schemas.AREAS,
    "lic_quotas": schemas.LIC_QUOTAS, "sflt_quotas": schemas.SFLT_QUOTAS,
    "sflt_descs": schemas.SFLT_DESCS, "fleet_quotas": schemas.FLEET_QUOTAS,
    "doc_attributes": schemas.DOC_ATTRIBUTES, "isvessels": schemas.ISVESSELS,
    "istrips": schemas.ISTRIPS, "isfishsets": schemas.ISFISHSETS,
    "issetprofile": schemas.ISSETPROFILE, "isgears": schemas.ISGEARS,
    "isgearfeatures": schemas.ISGEARFEATURES,
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def assert_distributed(df):
    text = plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert bad not in text, bad


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.date(2023, 5, 10)
    rows = {
        "records": [
            (1, 1, 1, day, day, 12, 413000, 663000, 7, code, kg, 1, 1, 1)
            for code, kg in ((100, 5.0), (110, 2.0), (110, None), (170, 3.0), (200, 1.0))
        ]
        + [(1, 2, 2, dt.date(2022, 5, 1), day, 12, 0, 0, 7, 100, 5.0, 2, 1, 1)],
        "vessels": [(1, "A", 30.0, 50.0)],
        "areas": [(1, "5ZE"), (2, "4X")],
        "lic_quotas": [(1, 1)],
        "sflt_quotas": [(1, 90, 1)],
        "sflt_descs": [(90, "x")],
        "fleet_quotas": [(1,)],
        "doc_attributes": [(1, 741, "T1"), (1, 742, "no")],
        "isvessels": [(1, "1", "A")],
        "istrips": [(1, 1, "T1", 7001, "c", day)],
        "isfishsets": [(1, 1, 1, 1, 1, 10, "5Z"), (2, 1, 2, 2, 1, 10, "5Z"), (3, 1, 3, 3, 1, 10, "4X")],
        "issetprofile": [(1, 1, day, 41.0, -66.0), (1, 2, day, 40.5, None), (2, 1, day, 1.0, 1.0)],
        "isgears": [(1, 12), (2, 71), (3, None)],
        "isgearfeatures": [(1, 89)],
    }
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{folder}/{name}")
    return folder


def test_landings_from_parquet(spark, stored):
    df = pull_landings(LandingTables.from_parquet(spark, stored), 2023)
    (row,) = df.collect()
    assert (row["100"], row["110"], row["170"], row.TRIP) == (5.0, None, 3.0, "T1")
    assert (row.LAT, row.LON, row.TC, row.LC) == (41.5, -66.5, 2, 3)
    assert_distributed(df)
    text = plan(df)
    assert "GreaterThanOrEqual(landed_date,2023-01-01)" in text
    assert "LessThan(landed_date,2024-01-01)" in text
    assert "In(species_code, [100,110,170])" in text
    assert "EqualTo(column_defn_id,741)" in text
    assert "StringStartsWith(area,5Z)" in text


def test_observers_from_parquet(spark, stored):
    df = pull_observer_trips(ObserverTables.from_parquet(spark, stored), 2023)
    (row,) = df.collect()
    assert (row.GEARCD_ID, row.LAT, row.LON, row.TRIP) == (12, 40.5, -66.0, "T1")
    assert_distributed(df)
    assert "GreaterThanOrEqual(setdate,2023-01-01)" in plan(df)


def test_reconcile_plan(spark):
    assert_distributed(rec.reconcile(landings(spark, {}), observers(spark, {})))


def test_split_plans(spark):
    land, obs = zoned(spark, {}), observers(spark, {})
    features = spark.createDataFrame([("T", 89)], "TRIP string, GEARFCD_ID int")
    sought = spark.createDataFrame([("T", 16)], "TRIP string, SPECSCD_ID int")
    for split in (
        splits.non_commercial(land, obs),
        splits.no_panel(land, features),
        splits.species_sought(land, sought),
        splits.observed_quarters(land),
    ):
        assert_distributed(split.kept)
        assert_distributed(split.removed)


def test_zone_plan(spark):
    edges = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 1.0, 1.0)], schemas.ZONE_EDGES)
    positions = spark.createDataFrame([(1, "2023/05/10 00:00:00", 1.0, 1.0)], schemas.POSITIONS)
    land = landings(spark, {}, schema=schemas.LANDINGS_WIDE + ", SECTOR int")
    got = zones.assign_zone(land, observers(spark, {}), positions, edges)
    assert_distributed(got.kept)
    assert_distributed(got.removed)


def test_bootstrap_and_allocation_plans(spark):
    data = trips(spark, {})
    groups = spark.createDataFrame([(90, 1, 2, "A")], schemas.GROUPS)
    shares = spark.createDataFrame([("A", "Y", 1.0)], schemas.GROUP_RESULTS)
    grouped = bootstrap.grouped_trips(data, groups)
    text = plan(bootstrap.replicate_multipliers(grouped, 10))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "SinglePartition"):
        assert bad not in text, bad
    # Segments, then blocks; the draws of rows stay in the engine.
    assert text.count("MapInArrow") == 2
    assert_distributed(allocate.assign_discards(data, groups, shares))


def test_missing_trip_numbers_are_spread(spark):
    """A join on the trip number sends rows without one to many partitions."""
    land = zoned(spark, *[{"TRIP_ID": i} for i in range(400)])
    marked = splits.non_commercial(land, observers(spark, {"TRIP": "T", "SETCD_ID": 7})).kept
    text = plan(marked)
    assert "_salt" in text
    assert marked.count() == 400


def test_labels_without_a_window(spark, tmp_path):
    """Missing and blank numbers do not travel; directed trips and records come as small tables."""
    for name, df in (("land", zoned(spark, {})), ("obs", observers(spark, {}))):
        df.write.parquet(f"{tmp_path}/{name}")
    land, obs = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("land", "obs"))
    features = spark.createDataFrame([("T", 89)], "TRIP string, GEARFCD_ID int")
    sought = spark.createDataFrame([("T", 16)], "TRIP string, SPECSCD_ID int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        evidence = splits.trip_evidence(obs, features, sought)
        whole = plan(splits.label_landings(land, evidence))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        labelled = splits.label_landings(land, evidence, keep=lambda df: cut_lineage(df, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert_distributed(splits.splits_of(labelled).directed.removed)
    assert "Window" not in whole and "partial_min" in whole
    # Written, both are sent to the landings, which then do not travel at all.
    text = plan(labelled)
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text


def test_points_do_not_travel_to_a_small_map(spark, tmp_path):
    edges = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 1.0, 1.0)], schemas.ZONE_EDGES)
    zones.zone_cells(edges).write.parquet(f"{tmp_path}/cells")
    zoned(spark, {}).drop("ZONE").write.parquet(f"{tmp_path}/land")
    land, cells = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("land", "cells"))
    text = plan(zones.locate(land, cells, "LAT", "LON", "ZONE"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert text.count("isnotnull(LON") + text.count("isnotnull(LAT") > 0


def test_a_detailed_polygon_lists_few_edges(spark):
    """4000 edges over 10 degrees, and 4000 in two cells: no part of a cell lists more than 16."""
    for radius, cx, cy in ((5.0, -65.0, 42.0), (0.1, -65.1, 42.1)):
        n, pi = 4000, math.pi
        ring = [(cx + radius * math.cos(2 * pi * i / n), cy + radius * math.sin(2 * pi * i / n)) for i in range(n)]
        rows = [(1, 0, i, *ring[i], *ring[(i + 1) % n]) for i in range(n)]
        cells = cut_lineage(zones.zone_cells(spark.createDataFrame(rows, schemas.ZONE_EDGES)))
        report = zones.index_report(cells).collect()
        assert max(r.most_edges for r in report if r.depth < zones.MAX_DEPTH) <= 16
        assert max(r.most_edges for r in report) <= 40
        assert sum(r.edges for r in report) < 12_000
        assert sum(r.without_edges for r in report) > 200
        points = [(cx + f * radius * math.cos(k), cy + f * radius * math.sin(k)) for k in range(60) for f in (0.01, 0.5, 0.999, 1.001)]
        points += [(cx, cy - 1.02 * radius), (cx, cy - 0.98 * radius), (cx + 40, cy), (cx - 40, cy)]
        df = spark.createDataFrame(points, "x double, y double")
        inside = lambda x, y: sum(
            (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) for _, _, _, x1, y1, x2, y2 in rows
        ) % 2
        got = zones.locate(df, cells, "y", "x", "z").collect()
        assert [r.z for r in got] == [inside(r.x, r.y) for r in got]
