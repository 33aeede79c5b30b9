import datetime as dt
import os
from dataclasses import replace
from types import SimpleNamespace

import pytest

from haulback import schemas
from haulback.operators.coverage import coverage_summary
from haulback.operators.lineage import clear_work, cut_lineage, work_folder
from haulback.operators.reconcile import exact_matches
from haulback.operators.trips import grouping_table
from haulback.plans.ready import ready_data, write_ready_data
from haulback.sources.landings import LandingTables
from haulback.sources.observers import ObserverTables
from haulback.sources.positions import parse_day_month_year, read_groups, read_positions
from haulback.sources.reports import COVERAGE_SHEETS, write_coverage, write_reports
from haulback.sources import publish
from haulback.sources.by_vessel import write_by_vessel
from haulback.sources.publish import finish_started, publication, published
from haulback.sources.snapshots import read_pulled, write_snapshot
from haulback.sources.stored import stored_table
from pyspark.sql import functions as F
from tests.frames import day, landings, observers, trips, values, zoned
from tests.test_plans import plan, stored  # noqa: F401

RUN_DATE = dt.date(2024, 3, 1)


def test_reports_carry_year_and_run_date(spark, tmp_path):
    strata = grouping_table(trips(spark, {"TRIP": "T"}, {"TRIP_ID": 2}))
    paths = write_reports({"DataforGrouping": strata}, str(tmp_path), 2023, RUN_DATE)
    assert paths["DataforGrouping"].endswith("Discards_DataforGrouping_2023_2024-03-01")
    back = spark.read.csv(paths["DataforGrouping"], header=True)
    assert back.columns == ["SECTOR", "ZONE", "Q", "UNOBS", "OBS", "COVERAGE", "DGROUP"]


def test_coverage_sheets(spark, tmp_path):
    paths = write_coverage(coverage_summary(zoned(spark, {})), str(tmp_path), RUN_DATE, "parquet")
    assert set(paths) == set(COVERAGE_SHEETS.values())
    back = spark.read.parquet(paths["FLEET SUMMARY"])
    assert values(back, "SECTOR", "UNOBS") == [(90, 1)]


def test_groups_from_csv(spark, tmp_path):
    path = tmp_path / "groups.csv"
    path.write_text(
        "X,SECTOR,ZONE,Q,UNOBS,OBS,COVERAGE,DGROUP,GROUP\n1,90,1,2,1,1,0.5,1,A\n2,89,,1,1,1,0.5,,\n"
    )
    got = read_groups(spark, str(path))
    assert values(got, "SECTOR", "ZONE", "Q", "GROUP") == [(89, None, 1, None), (90, 1, 2, "A")]


def test_day_month_year_text(spark):
    df = spark.createDataFrame([("10-05-2023 00:00",), ("x",), (None,)], "s string").coalesce(1)
    got = [r[0] for r in df.select(parse_day_month_year(F.col("s"))).collect()]
    assert got == [dt.date(2023, 5, 10), None, None]


def test_snapshot_replaces_only_its_year(spark, stored, tmp_path):  # noqa: F811
    land = LandingTables.from_parquet(spark, stored)
    obs = ObserverTables.from_parquet(spark, stored)

    def fleet(vessel, *years):
        rows = [(vessel, dt.date(y, 6, 1)) for y in years]
        return spark.createDataFrame(rows, "VR_NUMBER_FISHING long, LANDED_DATE date")

    def track(*rows):
        return spark.createDataFrame(
            [(v, f"{y}/06/01 00:00:00", 1.0, 1.0) for v, y in rows], schemas.POSITIONS
        )

    fleets = {"mobile": fleet(1, 2022, 2023), "fixed": fleet(2, 2023)}
    positions = {"mobile": track((1, 2022), (1, 2023), (9, 2023)), "fixed": track((2, 2023))}
    folder = str(tmp_path)
    write_snapshot(folder, 2022, land, obs, fleets, positions)
    write_snapshot(folder, 2023, land, obs, fleets, positions)
    assert values(read_positions(spark, folder, 2022), "VR_NUMBER") == [(1,)]
    assert values(read_positions(spark, folder, 2023), "VR_NUMBER") == [(1,), (2,)]
    assert spark.read.parquet(f"{folder}/fleets").count() == 3
    again = LandingTables.from_parquet(spark, f"{folder}/landings")
    assert again.records.count() == land.records.count()


def test_ready_data_from_stored_tables(spark, stored, tmp_path):  # noqa: F811
    land = LandingTables.from_parquet(spark, stored)
    obs = ObserverTables.from_parquet(spark, stored)
    box = [(-67, 41, -66, 41), (-66, 41, -66, 42), (-66, 42, -67, 42), (-67, 42, -67, 41)]
    edges = spark.createDataFrame(
        [(1, 0, i, *map(float, e)) for i, e in enumerate(box)], schemas.ZONE_EDGES
    )
    positions = spark.createDataFrame([], schemas.POSITIONS)
    ready = ready_data(land, obs, positions, edges, 2023)
    kept = []

    def elsewhere(df):
        kept.append(df.columns)
        return cut_lineage(df, str(tmp_path / "own"))

    own = ready_data(land, obs, positions, edges, 2023, keep=elsewhere)
    assert values(ready.removed, "TRIP", "COMMENT") == [("T1", "DID NOT USE SEPARATOR PANEL")]
    assert values(own.removed, "TRIP", "COMMENT") == [("T1", "DID NOT USE SEPARATOR PANEL")]
    assert ready.trips.columns == own.trips.columns and len(kept) == 8 and ready.trips.count() == 0
    paths = write_ready_data(ready, str(tmp_path), 2023, RUN_DATE)
    assert len(paths) == 10


def test_strata_written_grouped_and_read(spark, tmp_path):
    """The hand-over every user makes: write the strata, add GROUP, read them again."""
    strata = grouping_table(
        trips(spark, {"TRIP": "T", "ZONE": 5}, {"TRIP_ID": 2, "ZONE": 5}, {"ZONE": None, "Q": None})
    )
    grouped = strata.withColumn("GROUP", F.lit("A"))
    expected = values(grouped, "SECTOR", "ZONE", "Q", "GROUP")
    for name, table in (("plain", grouped), ("numbered", grouped.select(F.lit(1).alias("X"), "*"))):
        path = write_reports({name: table}, str(tmp_path), 2023, RUN_DATE)[name]
        assert values(read_groups(spark, path), "SECTOR", "ZONE", "Q", "GROUP") == expected
    path = write_reports({"bare": strata}, str(tmp_path), 2023, RUN_DATE)["bare"]
    with pytest.raises(ValueError, match="GROUP"):
        read_groups(spark, path)


def test_wrong_or_absent_columns_are_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", "10-05-2023")], "a long, b string, d string").write.parquet(path)
    assert stored_table(spark, path, "b string, a long").columns == ["b", "a"]
    with pytest.raises(TypeError, match="a bigint, not int"):
        stored_table(spark, path, "a int, b string")
    with pytest.raises(TypeError, match="no c"):
        stored_table(spark, path, "a long, c string")
    dated = stored_table(spark, path, "a long, d date", date_format="dd-MM-yyyy")
    assert values(dated, "a", "d") == [(1, dt.date(2023, 5, 10))]


def test_database_options_by_table():
    """What the reader is given; no database is asked."""

    class Reader:
        def format(self, name):
            assert name == "jdbc"
            return self

        def options(self, **given):
            self.given = given
            return self

        def load(self):
            return self.given

    class Session:
        @property
        def read(self):
            return Reader()

    split = {"dbtable": "R", "partitionColumn": "trip_id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    names = {n: n.upper() for n in LandingTables.names()} | {"records": split}
    got = LandingTables.from_jdbc(Session(), names, url="jdbc:x", fetchsize=10)
    assert got.vessels == {"url": "jdbc:x", "fetchsize": 10, "dbtable": "VESSELS"}
    assert got.records == {"url": "jdbc:x", "fetchsize": 10, **split}


def test_folder_for_intermediate_tables(spark, stored, tmp_path):  # noqa: F811
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(unset)
    assert work_folder(unset, "/shared") == "/shared"
    folder = str(tmp_path)
    edges = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 1.0, 1.0)], schemas.ZONE_EDGES)
    ready = ready_data(
        LandingTables.from_parquet(spark, stored),
        ObserverTables.from_parquet(spark, stored),
        spark.createDataFrame([], schemas.POSITIONS),
        edges,
        folder=folder,
    )
    (own,) = os.listdir(f"{folder}/haulback")
    assert ready.trips.count() == 0 and len(os.listdir(f"{folder}/haulback/{own}")) == 8
    os.makedirs(f"{folder}/haulback/another-application")
    assert clear_work(spark, folder) and os.listdir(f"{folder}/haulback") == ["another-application"]
    assert not clear_work(spark, folder)


def test_a_run_that_fails_leaves_the_former_set(spark, stored, tmp_path):  # noqa: F811
    land, obs = LandingTables.from_parquet(spark, stored), ObserverTables.from_parquet(spark, stored)
    folder = str(tmp_path / "snapshot")
    fleet = spark.createDataFrame([(1, dt.date(2023, 6, 1))], "VR_NUMBER_FISHING long, LANDED_DATE date")
    track = spark.createDataFrame([(1, "2023/06/01 00:00:00", 1.0, 1.0)], schemas.POSITIONS)
    args = ({"mobile": fleet, "fixed": fleet.limit(0)}, {"mobile": track, "fixed": track})
    write_snapshot(folder, 2023, land, obs, *args)
    before = published(spark, folder)
    assert len(before) == 16 and "fleets/year=2023" in before
    broken = replace(obs, isgears=obs.isgears.withColumn("gearcd_id", F.raise_error(F.lit("no gears")).cast("int")))
    twice = replace(land, records=land.records.unionAll(land.records))
    with pytest.raises(Exception, match="no gears"):
        write_snapshot(folder, 2023, twice, broken, *args)
    assert published(spark, folder) == before
    assert sorted(os.listdir(folder)) == ["._published.json.crc", "_published.json", "fleets", "landings", "observers", "positions"]
    again = LandingTables.from_parquet(spark, f"{folder}/landings")
    assert again.records.count() == land.records.count()
    write_snapshot(folder, 2023, twice, obs, *args)
    assert LandingTables.from_parquet(spark, f"{folder}/landings").records.count() == 2 * land.records.count()


def test_reports_are_put_in_place_together(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "a int")
    write_reports({"A": one, "B": one}, str(tmp_path), 2023, RUN_DATE)
    bad = one.select(F.raise_error(F.lit("stop")).cast("int").alias("a"))
    with pytest.raises(Exception, match="stop"):
        write_reports({"A": one.unionAll(one), "B": bad}, str(tmp_path), 2023, RUN_DATE)
    names = ["Discards_A_2023_2024-03-01", "Discards_B_2023_2024-03-01"]
    assert [spark.read.csv(f"{tmp_path}/{n}", header=True).count() for n in names] == [1, 1]


def test_moves_of_a_run_that_ended_among_them_are_carried_out(spark, tmp_path, monkeypatch):
    one = spark.createDataFrame([(1,)], "a int")
    folder = str(tmp_path)
    for name in ("a", "b", "c"):
        one.write.parquet(f"{folder}/{name}")
    moved, move = [], publish._Files.move

    def stop_after_one(self, name, to):
        if not to.startswith("_") and moved:
            raise RuntimeError("lost")
        moved.extend([to] if not to.startswith("_") else [])
        move(self, name, to)

    monkeypatch.setattr(publish._Files, "move", stop_after_one)
    with pytest.raises(RuntimeError, match="lost"), publication(spark, folder) as stage:
        for name in ("a", "b"):
            one.unionAll(one).write.parquet(stage.path(name))
        stage.path("c")  # the new set has none
    monkeypatch.setattr(publish._Files, "move", move)
    assert spark.read.parquet(f"{folder}/b").count() == 1
    assert finish_started(spark, folder) and not finish_started(spark, folder)
    assert [spark.read.parquet(f"{folder}/{n}").count() for n in ("a", "b")] == [2, 2]
    assert not os.path.exists(f"{folder}/c") and published(spark, folder) == ["a", "b"]
    assert not [n for n in os.listdir(folder) if "stag" in n or "publishing" in n]


def test_tables_by_vessel_meet_without_a_shuffle(spark, tmp_path):
    rows = [{"VR_NUMBER_FISHING": v, "LANDED_DATE": day(v % 5), "TRIP_ID": v} for v in range(40)]
    land = landings(spark, *rows, {"VR_NUMBER_FISHING": None, "TRIP_ID": 99})
    obs = observers(spark, *[{"VR_NUMBER_FISHING": v, "LANDED_DATE": day(v % 5), "TRIP": f"T{v}"} for v in range(0, 40, 3)])
    expected = values(exact_matches(land, obs), "TRIP_ID", "TRIP_OBS")
    for name, df in (("landings", land), ("observers", obs)):
        write_by_vessel(df, f"{tmp_path}/pulled/{name}_2023", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        stored = read_pulled(spark, str(tmp_path), 2023)
        met = exact_matches(*stored, by_vessel=True)
        assert values(met, "TRIP_ID", "TRIP_OBS") == expected
        whole = plan(stored.landings.dropna(subset=["VR_NUMBER_FISHING", "LANDED_DATE"]).transform(
            lambda df: exact_matches(df, stored.observers, by_vessel=True)
        ))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Landings with a vessel and a date meet their trips bucket by bucket.
    join = met_join(whole)
    assert "SortMergeJoin" in join and "Exchange" not in join and "Bucketed: true" in join


def met_join(text):
    """The part of a plan under its first join."""
    lines = text.splitlines()
    start = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = len(lines[start]) - len(lines[start].lstrip(" :+-"))
    end = next((i for i, line in enumerate(lines[start + 1 :], start + 1) if len(line) - len(line.lstrip(" :+-*()0123456789")) <= depth), len(lines))
    return "\n".join(lines[start:end])


def test_rows_are_accounted_for(spark, stored, tmp_path):  # noqa: F811
    land = LandingTables.from_parquet(spark, stored)
    obs = ObserverTables.from_parquet(spark, stored)
    box = [(-67, 41, -66, 41), (-66, 41, -66, 42), (-66, 42, -67, 42), (-67, 42, -67, 41)]
    edges = spark.createDataFrame([(1, 0, i, *map(float, e)) for i, e in enumerate(box)], schemas.ZONE_EDGES)
    positions = spark.createDataFrame([], schemas.POSITIONS)
    ready = ready_data(land, obs, positions, edges, 2023)
    steps = ready.accounts.steps()
    assert ready.accounts.problems() == []
    assert [s.name for s in steps] == ["reconcile", "zone", "commercial", "panel", "directed"]
    assert (steps[0].taken, steps[3].removed, steps[4].kept) == (1, 1, 0)

    def losing(df):
        return cut_lineage(df.filter("1 = 0") if "N_KEPT" in df.columns and "TWIN" not in df.columns else df)

    lossy = ready_data(land, obs, positions, edges, 2023, keep=losing)
    assert lossy.accounts.problems() == ["zone: of 1 rows 1 are lost"]

    def doubling(df):
        return cut_lineage(df.unionAll(df) if "N_KEPT" in df.columns and "TWIN" not in df.columns else df)

    double = ready_data(land, obs, positions, edges, 2023, keep=doubling)
    assert double.accounts.problems() == ["zone: of 1 rows 1 are there twice"]
