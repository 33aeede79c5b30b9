import pytest

from haulback.operators import reconcile as rec
from tests.frames import day, landings, observers, values


def outcomes(df):
    return values(df, "TRIP_ID", "OUTCOME", "TRIP")


def test_exact_pass(spark):
    land = landings(
        spark,
        {"TRIP_ID": 1, "VR_NUMBER_FISHING": 1, "TRIP": "T1"},
        {"TRIP_ID": 2, "VR_NUMBER_FISHING": 2, "TRIP": ""},
        {"TRIP_ID": 3, "VR_NUMBER_FISHING": 3, "TRIP": "T3"},
        {"TRIP_ID": 4, "VR_NUMBER_FISHING": 4},
        {"TRIP_ID": 5, "VR_NUMBER_FISHING": 5},
    )
    obs = observers(
        spark,
        {"VR_NUMBER_FISHING": 1, "TRIP": "T1"},
        {"VR_NUMBER_FISHING": 2, "TRIP": "T2"},
        {"VR_NUMBER_FISHING": 3, "TRIP": "X3"},
        {"VR_NUMBER_FISHING": 4, "TRIP": "T4"},
        {"VR_NUMBER_FISHING": 5},
    )
    assert outcomes(rec.reconcile(land, obs)) == [
        (1, rec.EXACT_EQUAL, "T1"),
        (2, rec.EXACT_DIFFER, "T2"),
        (3, rec.EXACT_DIFFER, "T3"),
        (4, rec.UNRESOLVED, None),
        (5, rec.EXACT_EQUAL, None),
    ]
    blank = rec.reconcile(land, obs, null_trip_as_blank=True, replace_incorrect=True)
    assert outcomes(blank) == [
        (1, rec.EXACT_EQUAL, "T1"),
        (2, rec.EXACT_DIFFER, "T2"),
        (3, rec.EXACT_DIFFER, "X3"),
        (4, rec.EXACT_DIFFER, "T4"),
        (5, rec.EXACT_EQUAL, None),
    ]


@pytest.mark.parametrize(
    ("gap", "expected"),
    [(1, rec.NEAR_EQUAL), (2, rec.NEAR_EQUAL), (-2, rec.NEAR_EQUAL), (3, rec.NOT_IN_OBSERVER_DATA)],
)
def test_near_pass_reaches_two_days(spark, gap, expected):
    land = landings(spark, {"TRIP": "T1"})
    obs = observers(spark, {"TRIP": "T1", "LANDED_DATE": day(gap)})
    assert [r.OUTCOME for r in rec.reconcile(land, obs).collect()] == [expected]


def test_every_near_row_repeats_the_landing(spark):
    land = landings(spark, {"TRIP": "T1"})
    obs = observers(
        spark,
        {"TRIP": "T1", "LANDED_DATE": day(1), "SETCD_ID": 1},
        {"TRIP": "T1", "LANDED_DATE": day(1), "SETCD_ID": 7},
        {"TRIP": "T2", "LANDED_DATE": day(-2)},
    )
    got = rec.reconcile(land, obs)
    assert [r.OUTCOME for r in got.orderBy("OUTCOME").collect()] == [
        rec.NEAR_DIFFER,
        rec.NEAR_EQUAL,
        rec.NEAR_EQUAL,
    ]
    nearest = rec.reconcile(land, obs, nearest_only=True).collect()
    assert [(r.OUTCOME, r.TRIP_OBS) for r in nearest] == [(rec.NEAR_EQUAL, "T1")]


def test_both_missing_is_kept_only_in_the_exact_pass(spark):
    land = landings(spark, {})
    near = observers(spark, {"LANDED_DATE": day(1)})
    assert [r.OUTCOME for r in rec.reconcile(land, near).collect()] == [rec.UNRESOLVED]
    got = rec.reconcile(land, near, null_trip_as_blank=True)
    assert [r.OUTCOME for r in got.collect()] == [rec.NEAR_EQUAL]


def test_row_without_trip_code_does_not_match(spark):
    land = landings(spark, {"TRIP": "T1"}, {"TRIP_ID": 2, "VR_NUMBER_FISHING": 2})
    obs = observers(
        spark, {"TRIP": "T1", "TRIPCD_ID": None}, {"VR_NUMBER_FISHING": 2, "TRIPCD_ID": None}
    )
    assert outcomes(rec.reconcile(land, obs)) == [
        (1, rec.NOT_IN_OBSERVER_DATA, "T1"),
        (2, rec.UNOBSERVED, None),
    ]


def test_first_observer_row_is_the_lowest_trip_with_missing_last(spark):
    obs = observers(spark, {"TRIP": None}, {"TRIP": "T9"}, {"TRIP": "T2", "SETCD_ID": 7})
    assert values(rec.first_observer_rows(obs), "TRIP", "SETCD_ID") == [("T2", 7)]


def test_reports(spark):
    land = landings(
        spark,
        {"TRIP_ID": 1, "VR_NUMBER_FISHING": 1, "TRIP": ""},
        {"TRIP_ID": 1, "VR_NUMBER_FISHING": 1, "TRIP": "", "LOG_EFRT_STD_INFO_ID": 2},
        {"TRIP_ID": 2, "VR_NUMBER_FISHING": 2, "TRIP": "T2"},
        {"TRIP_ID": 3, "VR_NUMBER_FISHING": 3, "TRIP": "T3"},
    )
    obs = observers(
        spark, {"VR_NUMBER_FISHING": 1, "TRIP": "T1"}, {"VR_NUMBER_FISHING": 2, "TRIP": "X2"}
    )
    got = rec.trip_reports(rec.reconcile(land, obs), obs)
    assert values(got.missing, "TRIP_ID", "TRIP_LANDING", "TRIP_OBS") == [(1, "", "T1")]
    assert values(got.incorrect, "TRIP_ID", "TRIP_LANDING", "TRIP_OBS") == [(2, "T2", "X2")]
    assert got.errors.count() == 3
    assert values(got.observer_check, "TRIP", "TRIP_LANDING", "COMMENT") == [
        ("3", "T3", None),
        ("X2", "match", rec.CHECK_COMMENT),
    ]


def test_bins_hold_two_rows_of_a_trip_whatever_the_tolerance(spark):
    import random

    draw = random.Random(3)
    rows = [{"VR_NUMBER_FISHING": draw.choice([1, 2, None]), "LANDED_DATE": day(draw.randint(-400, 400)), "TRIP": f"T{i}"} for i in range(60)]
    obs = observers(spark, *rows)
    known = sum(r["VR_NUMBER_FISHING"] is not None for r in rows)
    days = [(v, d) for v in (1, 2, 3, None) for d in range(-420, 421, 3)]
    land = landings(spark, *[{"VR_NUMBER_FISHING": v, "LANDED_DATE": day(d), "TRIP_ID": i} for i, (v, d) in enumerate(days)])
    for tolerance in (0, 2, 60):
        assert rec.binned_observers(obs, tolerance).count() == 2 * known
        got = rec.near_matches(land, obs, tolerance).select("TRIP_ID", "TRIP_NEAR").collect()
        expected = []
        for i, (v, d) in enumerate(days):
            near = [r["TRIP"] for r in rows if v is not None and r["VR_NUMBER_FISHING"] == v and abs((r["LANDED_DATE"] - day(d)).days) <= tolerance]
            expected += [(i, t) for t in near or [None]]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected)), tolerance
