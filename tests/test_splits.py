from haulback import schemas
from haulback.operators import splits
from haulback.operators.coverage import coverage_summary
from haulback.operators.trips import aggregate_trips, grouping_table
from tests.frames import DAY, observers, trips, values, zoned


def features(spark, *rows):
    return spark.createDataFrame(list(rows), "TRIP string, GEARFCD_ID int")


def sought(spark, *rows):
    return spark.createDataFrame(list(rows), "TRIP string, SPECSCD_ID int")


def test_non_commercial_matches_missing_with_missing(spark):
    land = zoned(spark, {"TRIP_ID": 1, "TRIP": "T1"}, {"TRIP_ID": 2}, {"TRIP_ID": 3, "TRIP": ""})
    obs = observers(spark, {"TRIP": "T1"}, {"TRIP": None, "SETCD_ID": 7})
    got = splits.non_commercial(land, obs)
    assert values(got.kept, "TRIP_ID") == [(1,), (3,)]
    assert values(got.removed, "TRIP_ID", "COMMENT") == [(2, "NON COMMERCIAL TRIP")]


def test_non_commercial_lists_a_record_once(spark):
    land = zoned(spark, {"TRIP": "T1"}, {"TRIP": "T1"})
    got = splits.non_commercial(land, observers(spark, {"TRIP": "T1", "SETCD_ID": 7}))
    assert got.removed.count() == 1 and got.kept.count() == 0


def test_trip_with_both_features_is_on_both_sides_unless_exclusive(spark):
    land = zoned(spark, {"TRIP": "T1"}, {"TRIP": "T2", "TRIP_ID": 2})
    both = features(spark, ("T1", 89), ("T1", 90), ("T2", 90), ("T2", 90))
    got = splits.no_panel(land, both)
    assert values(got.kept, "TRIP_ID") == [(1,), (2,), (2,)]
    assert values(got.removed, "TRIP_ID") == [(1,)]
    got = splits.no_panel(land, both, exclusive=True)
    assert values(got.kept, "TRIP_ID") == [(2,)] and values(got.removed, "TRIP_ID") == [(1,)]


def weights(cod, had, pol=None, **more):
    return {"100": cod, "110": had, "170": pol, **more}


def directed(spark, *rows, species=(), **options):
    got = splits.species_sought(zoned(spark, *rows), sought(spark, *species or [("-", 10)]), **options)
    cols = ("TRIP_ID", "LOG_EFRT_STD_INFO_ID")
    return values(got.kept, *cols), values(got.removed, *cols, "COMMENT")


def test_all_sets_cod_directed(spark):
    kept, removed = directed(
        spark,
        weights(9.0, 10.0, TRIP_ID=1, LOG_EFRT_STD_INFO_ID=1),
        weights(1.0, 0.0, TRIP_ID=1, LOG_EFRT_STD_INFO_ID=2),
        weights(4.0, 5.0, TRIP_ID=2, LOG_EFRT_STD_INFO_ID=3),
        weights(9.0, 1.0, TRIP_ID=3, LOG_EFRT_STD_INFO_ID=4),
        weights(0.0, 0.0, TRIP_ID=3, LOG_EFRT_STD_INFO_ID=5),
    )
    assert kept == [(2, 3), (3, 4), (3, 5)]
    assert removed == [(1, 1, splits.ALL_COD_COMMENT), (1, 2, splits.ALL_COD_COMMENT)]


def test_last_sets_cod_directed(spark):
    kept, removed = directed(
        spark,
        weights(1.0, 10.0, TRIP_ID=1, LOG_EFRT_STD_INFO_ID=1),
        weights(9.0, 10.0, TRIP_ID=1, LOG_EFRT_STD_INFO_ID=3),
        weights(9.0, 10.0, TRIP_ID=2, LOG_EFRT_STD_INFO_ID=1),
        weights(1.0, 10.0, TRIP_ID=2, LOG_EFRT_STD_INFO_ID=2),
        weights(5.0, 0.0, TRIP_ID=1, LOG_EFRT_STD_INFO_ID=9),
        by_record=True,
    )
    assert kept == [(1, 1), (1, 9), (2, 1), (2, 2)]
    assert removed == [(1, 3, splits.LAST_COD_COMMENT)]


def test_pollock_must_exceed_cod_and_haddock(spark):
    kept, removed = directed(
        spark,
        weights(1.0, 2.0, 3.0, TRIP_ID=1),
        weights(1.0, 2.0, 3.1, TRIP_ID=2),
    )
    assert kept == [(1, 1)] and removed == [(2, 1, splits.POLLOCK_COMMENT)]


def test_other_species_once_per_species(spark):
    species = [("T1", 16), ("T1", 16), ("T1", 17), ("T1", None), ("T2", 10), ("T2", 11)]
    rows = [weights(1.0, 9.0, TRIP="T1"), weights(1.0, 9.0, TRIP="T2", TRIP_ID=2)]
    kept, removed = directed(spark, *rows, species=species)
    assert kept == [(2, 1)] and removed == [(1, 1, splits.OTHER_SPECIES_COMMENT)] * 2


def test_record_with_a_missing_weight_stays_and_twins_leave(spark):
    rows = [
        weights(None, 1.0, 9.0, TRIP_ID=1),
        weights(0.0, 1.0, 9.0, TRIP_ID=2, LOG_EFRT_STD_INFO_ID=1),
    ]
    kept, removed = directed(spark, *rows)
    assert kept == [(1, 1)]
    assert removed == [(1, 1, splits.POLLOCK_COMMENT), (2, 1, splits.POLLOCK_COMMENT)]
    kept, _ = directed(spark, *rows, by_record=True)
    assert kept == []


def test_fully_observed_strata_leave_and_missing_keys_match(spark):
    land = zoned(
        spark,
        {"TRIP_ID": 1, "SECTOR": None, "TRIP": "T1"},
        {"TRIP_ID": 2, "TRIP": "T2"},
        {"TRIP_ID": 3},
        {"TRIP_ID": 4, "ZONE": 2},
    )
    got = splits.observed_quarters(land)
    assert values(got.removed, "TRIP_ID") == [(1,)]
    assert values(got.kept, "TRIP_ID") == [(2,), (3,), (4,)]


def test_coverage_tables(spark):
    land = zoned(
        spark, {"TRIP": "T"}, {"TRIP": ""}, {}, {}, {"SECTOR": 89, "TRIP": "T"}, {"ZONE": 2}
    )
    got = coverage_summary(land)
    assert values(got.fleet, "SECTOR", "OBS", "UNOBS", "COVERAGE") == [
        (89, 1, 0, 1.0),
        (90, 2, 3, 0.4),
    ]
    assert values(got.mean, "desc", "value") == [("MEAN COVERAGE", 0.7)]
    assert values(got.fleet_all_observed, "SECTOR") == [(89,)]
    assert values(got.stratum_all_observed, "SECTOR", "ZONE") == [(89, 1)]


def test_coverage_when_nothing_is_observed(spark):
    got = coverage_summary(zoned(spark, {}, {}))
    assert values(got.fleet, "OBS", "UNOBS", "COVERAGE") == [(0, 2, 0.0)]
    assert got.stratum_all_observed.count() == 0


def test_trip_aggregate_skips_missing_weights(spark):
    rows = [weights(None, 2.0, None), weights(None, 3.0, None), weights(1.0, None, None, TRIP="")]
    got = values(aggregate_trips(zoned(spark, *rows)), "COD", "HAD", "POL", "OBS")
    assert got == [(0.0, 5.0, 0.0, "N"), (1.0, 0.0, 0.0, "Y")]


def test_trip_aggregate_may_require_a_sector(spark):
    land = zoned(spark, {"SECTOR": None}, {"TRIP_ID": 2})
    assert aggregate_trips(land).count() == 2
    assert aggregate_trips(land, require_sector=True).count() == 1


def test_grouping_table_classes(spark):
    def stratum(zone, observed, unobserved):
        some = [{"ZONE": zone, "TRIP": "T", "TRIP_ID": i} for i in range(observed)]
        return some + [{"ZONE": zone, "TRIP_ID": 100 + i} for i in range(unobserved)]

    rows = stratum(1, 1, 4) + stratum(2, 1, 1) + stratum(3, 1, 9) + stratum(4, 2, 0)
    got = values(grouping_table(trips(spark, *rows)), "ZONE", "UNOBS", "OBS", "DGROUP")
    assert got == [(1, 4, 1, None), (2, 1, 1, 1), (3, 9, 1, 2)]


def test_labels_give_the_same_splits(spark):
    """The splits read off the labels are those of the single functions, one after the other."""
    import random

    draw = random.Random(7)
    kg = lambda: draw.choice([None, 0.0, 1.0, 2.0, 5.0])
    land = zoned(
        spark,
        *[
            {
                "TRIP_ID": draw.randrange(60), "TRIP": draw.choice([None, "", *"ABCDEFGH"]),
                "LOG_EFRT_STD_INFO_ID": draw.choice([None, *range(5)]), "ZONE": draw.choice([None, 0, 1, 2]),
                "100": kg(), "110": kg(), "170": kg(), "DATE_FISHED": draw.choice([None, DAY]),
            }
            for _ in range(400)
        ],
    )
    obs = observers(spark, {"TRIP": "A", "SETCD_ID": 7}, {"TRIP": None, "SETCD_ID": 1}, {"TRIP": "B"})
    features = spark.createDataFrame(
        [("B", 89), ("B", 90), ("C", 90), ("C", 90), ("D", 89), ("", 90), ("", 90)], "TRIP string, GEARFCD_ID int"
    )
    sought = spark.createDataFrame(
        [("E", 16), ("E", 17), ("E", 10), ("F", None), ("G", 11), (None, 16)], "TRIP string, SPECSCD_ID int"
    )
    evidence = splits.trip_evidence(obs, features, sought)
    here = land.filter("ZONE >= 1")
    for exclusive in (False, True):
        labelled = splits.label_landings(land, evidence, exclusive=exclusive)
        for by_record in (False, True):
            got = splits.splits_of(labelled, exclusive=exclusive, by_record=by_record)
            commercial = splits.non_commercial(here, obs)
            panel = splits.no_panel(commercial.kept, features, exclusive=exclusive)
            directed = splits.species_sought(panel.kept, sought, by_record=by_record)
            for one, two in zip(got, (commercial, panel, directed), strict=True):
                for side in ("kept", "removed"):
                    a, b = getattr(one, side), getattr(two, side)
                    cols = [c for c in (*schemas.ZONED, "COMMENT") if c in b.columns]
                    assert values(a, *cols) == values(b, *cols), (exclusive, by_record, side)
