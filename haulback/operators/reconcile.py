"""Match landings to observer trips by vessel and landing date, exactly and then within days."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.missing import nulls_last
from haulback.operators.joins import null_safe_join, repeat_rows

VESSEL_DAY = ["VR_NUMBER_FISHING", "LANDED_DATE"]

EXACT_EQUAL = "exact_equal"
EXACT_DIFFER = "exact_differ"
NEAR_EQUAL = "near_equal"
NEAR_DIFFER = "near_differ"
UNOBSERVED = "unobserved"
NOT_IN_OBSERVER_DATA = "not_in_observer_data"
UNRESOLVED = "unresolved"

# Comment texts of the reports.
CHECK_MARK = "match"
CHECK_COMMENT = "Check if VRN, date landed, and trip number are correct"
MISSING_COMMENT = "trip number missing"
INCORRECT_COMMENT = "trip number incorrect as compared to observer data"


class TripReports(NamedTuple):
    errors: DataFrame
    missing: DataFrame
    incorrect: DataFrame
    observer_check: DataFrame


def first_observer_rows(observers: DataFrame) -> DataFrame:
    """One observer row per vessel and landing date: lowest trip, then every other column.

    A minimum over a struct, so each task sends on one row per key however many it holds.
    """
    value = ["TRIP", "TRIPCD_ID", "CONF_NUMBER", "MINDATE", "MAXDATE", "GEARCD_ID", "SETCD_ID"]
    first = F.min(F.struct(*nulls_last(*value))).alias("first")
    return (
        observers.groupBy(*VESSEL_DAY)
        .agg(first)
        .select(*VESSEL_DAY, *[F.col(f"first.{c}").alias(c) for c in value])
    )


def exact_matches(landings: DataFrame, observers: DataFrame, *, by_vessel: bool = False) -> DataFrame:
    """Landings with the first observer row of their vessel and landing date, null = null.

    ``by_vessel`` says that both tables are laid out by vessel and day (``sources.by_vessel``): the
    landings that have both then meet their observer rows where they lie, without a shuffle, and only
    the others are matched apart.  Tables that are not are shuffled once, so that adaptive execution
    can split a vessel-day of very many landings.
    """
    first = first_observer_rows(observers).withColumnsRenamed({"TRIP": "TRIP_OBS", "TRIPCD_ID": "TRIPCD_OBS"})
    first = first.select(*VESSEL_DAY, "TRIP_OBS", "TRIPCD_OBS")
    if not by_vessel:
        return null_safe_join(landings, first, VESSEL_DAY)
    known = landings.filter(_known()).join(first.filter(_known()), VESSEL_DAY, "left")
    apart = null_safe_join(landings.filter(~_known()), first.filter(~_known()), VESSEL_DAY)
    return known.select(*apart.columns).unionByName(apart)


def _known() -> Column:
    return F.col("VR_NUMBER_FISHING").isNotNull() & F.col("LANDED_DATE").isNotNull()


def _bin(day: Column, tolerance: int) -> Column:
    return F.floor(F.unix_date(day) / (2 * tolerance + 1))


def binned_observers(observers: DataFrame, tolerance: int = 2) -> DataFrame:
    """Observer trips in the two bins of days that their tolerance can reach: BIN beside each row.

    Bins are as wide as the reach, 2 x tolerance + 1 days, so a trip is listed twice whatever the
    tolerance.  Rows alike in what the reconciliation reads are folded into one with a count.
    """
    folded = observers.filter(_known()).groupBy(
        *VESSEL_DAY, F.col("TRIP").alias("TRIP_NEAR"), F.col("TRIPCD_ID").isNotNull().alias("CODED")
    ).agg(F.count(F.lit(1)).alias("N_NEAR"))
    first = _bin(F.date_sub("LANDED_DATE", tolerance), tolerance)
    return folded.withColumn("BIN", F.explode(F.array(first, first + 1)))


def near_observer_days(
    landings: DataFrame, observers: DataFrame, tolerance: int = 2, nearest_only: bool = False
) -> DataFrame:
    """The observer trips that each (vessel, day) of the landings can match.

    The landings' distinct days meet the trips of their bin and keep those within the tolerance, so
    the landings themselves join by (vessel, day), as in the exact pass.  COPIES is how many trips
    that day matches.  ``nearest_only`` keeps the
    smallest day gap, then the lowest trip.
    """
    days = landings.select("VR_NUMBER_FISHING", F.col("LANDED_DATE").alias("DAY")).dropna().distinct()
    days = days.withColumn("BIN", _bin(F.col("DAY"), tolerance))
    trips = binned_observers(observers, tolerance)
    gap = F.abs(F.datediff("DAY", "LANDED_DATE"))
    days = days.join(trips, ["VR_NUMBER_FISHING", "BIN"]).filter(gap <= tolerance)
    if not nearest_only:
        copies = F.sum("N_NEAR").over(Window.partitionBy("VR_NUMBER_FISHING", "DAY"))
        return days.select("VR_NUMBER_FISHING", "DAY", "TRIP_NEAR", "CODED", "N_NEAR", copies.alias("COPIES"))
    best = F.min(F.struct(gap.alias("gap"), *nulls_last("TRIP_NEAR"), F.col("CODED")))
    return (
        days.groupBy("VR_NUMBER_FISHING", "DAY")
        .agg(best.alias("b"))
        .select(
            "VR_NUMBER_FISHING",
            "DAY",
            F.col("b.TRIP_NEAR").alias("TRIP_NEAR"),
            F.col("b.CODED").alias("CODED"),
            F.lit(1).cast("long").alias("N_NEAR"),
            F.lit(1).cast("long").alias("COPIES"),
        )
    )


def near_matches(
    landings: DataFrame,
    observers: DataFrame,
    tolerance: int = 2,
    nearest_only: bool = False,
) -> DataFrame:
    """Landings with every observer trip of their vessel landed within the tolerance."""
    return join_near(landings, near_observer_days(landings, observers, tolerance, nearest_only))


def join_near(landings: DataFrame, days: DataFrame, only: Column | None = None) -> DataFrame:
    """Landings with the trips of their vessel and day.

    ``only`` limits which landings may match; the others come through once, unmatched.
    """
    days = days.withColumnRenamed("VR_NUMBER_FISHING", "VR_NEAR")
    cond = (
        F.col("VR_NUMBER_FISHING").eqNullSafe(F.col("VR_NEAR"))
        & F.col("LANDED_DATE").eqNullSafe(F.col("DAY"))
    )
    if only is not None:
        cond = cond & only
    joined = landings.join(days, cond, "left").drop("VR_NEAR", "DAY")
    return joined.withColumns({c: F.coalesce(c, F.lit(1)) for c in ("N_NEAR", "COPIES")})


def reconcile(
    landings: DataFrame,
    observers: DataFrame,
    *,
    tolerance: int = 2,
    null_trip_as_blank: bool = False,
    replace_incorrect: bool = False,
    nearest_only: bool = False,
) -> DataFrame:
    """Landings labelled with how they met the observer data, trip numbers repaired.

    Adds TRIP_LANDING (as landed), TRIP_OBS (observer's), OUTCOME, and COPIES, the rows that the
    landing has become; TRIP is the repaired number.
    Both passes join on vessel and date, so the landings are shuffled once for the two of them; their
    distinct vessels and days are read beside that, so pass a written table.
    """
    exact = exact_matches(landings, observers).withColumn("EXACT", F.col("TRIPCD_OBS").isNotNull())
    days = near_observer_days(landings, observers, tolerance, nearest_only)
    joined = join_near(exact, days, only=~F.col("EXACT"))
    near = ~F.col("EXACT") & F.coalesce("CODED", F.lit(False))
    joined = joined.withColumn(
        "TRIP_OBS", F.when(F.col("EXACT"), F.col("TRIP_OBS")).when(near, F.col("TRIP_NEAR"))
    )

    landed, observed = F.col("TRIP"), F.col("TRIP_OBS")
    if null_trip_as_blank:
        landed, observed = F.coalesce(landed, F.lit("")), F.coalesce(observed, F.lit(""))
    near_equal = landed == observed
    exact_equal = landed.eqNullSafe(observed)
    differ = landed != observed
    outcome = (
        F.when(F.col("EXACT") & exact_equal, EXACT_EQUAL)
        .when(F.col("EXACT") & differ, EXACT_DIFFER)
        .when(near & near_equal, NEAR_EQUAL)
        .when(near & differ, NEAR_DIFFER)
        .when(F.col("EXACT") | near, UNRESOLVED)
        .when(F.col("TRIP").isNull(), UNOBSERVED)
        .otherwise(NOT_IN_OBSERVER_DATA)
    )
    takes_observer = landed == ""
    if replace_incorrect:
        takes_observer = F.lit(True)
    repaired = F.when(
        F.col("OUTCOME").isin(EXACT_DIFFER, NEAR_DIFFER) & takes_observer,
        F.coalesce("TRIP_OBS", "TRIP"),
    ).otherwise(F.col("TRIP"))
    labelled = (
        joined.withColumn("OUTCOME", outcome)
        .withColumn("TRIP_LANDING", F.col("TRIP"))
        .withColumn("TRIP", repaired)
    )
    return repeat_rows(labelled, "N_NEAR").select(
        *schemas.LANDING, "TRIP_LANDING", "TRIP_OBS", "OUTCOME", "COPIES"
    )


def reconciled_landings(labelled: DataFrame) -> DataFrame:
    """The reconciled landings: every outcome but the unresolved, with repaired trip numbers."""
    return labelled.filter(F.col("OUTCOME") != UNRESOLVED).select(*schemas.LANDING)


def trip_errors(labelled: DataFrame) -> DataFrame:
    """Matched landings whose trip number differs from the observer's, with a comment."""
    blank = _blank()
    keys = [c for c in schemas.LANDING_KEYS if c != "TRIP"]
    return labelled.filter(F.col("OUTCOME").isin(EXACT_DIFFER, NEAR_DIFFER)).select(
        *keys,
        "TRIP_LANDING",
        "TRIP_OBS",
        F.when(blank, MISSING_COMMENT).otherwise(INCORRECT_COMMENT).alias("COMMENT"),
    )


def _blank() -> Column:
    """A missing number differs from the observer's only where it is taken for a blank one."""
    return F.coalesce(F.col("TRIP_LANDING") == "", F.lit(True))


def trip_reports(labelled: DataFrame, observers: DataFrame) -> TripReports:
    """Errors, missing and incorrect trip numbers, and the list for the observer programme."""
    errors = trip_errors(labelled)
    brief = errors.select(
        "VR_NUMBER_FISHING", "TRIP_ID", "LANDED_DATE", "TRIP_LANDING", "TRIP_OBS"
    )
    missing = brief.filter(_blank()).distinct()
    incorrect = brief.filter(~_blank()).distinct()

    trips = observers.select("VR_NUMBER_FISHING", "TRIP", "LANDED_DATE").distinct()
    suspects = incorrect.select(F.col("TRIP_OBS").alias("TRIP")).distinct()
    to_check = null_safe_join(trips, suspects, ["TRIP"], "left_semi").select(
        "VR_NUMBER_FISHING",
        "TRIP",
        "LANDED_DATE",
        F.lit(CHECK_MARK).alias("TRIP_LANDING"),
        F.lit(CHECK_COMMENT).alias("COMMENT"),
    )
    observer_check = to_check.unionByName(not_in_observer_data(labelled), allowMissingColumns=True)
    return TripReports(errors, missing, incorrect, observer_check)


def not_in_observer_data(labelled: DataFrame) -> DataFrame:
    """Landings with a trip number that met no observer trip."""
    return (
        labelled.filter(F.col("OUTCOME") == NOT_IN_OBSERVER_DATA)
        .select(
            "VR_NUMBER_FISHING",
            F.col("TRIP_ID").cast("string").alias("TRIP"),
            "LANDED_DATE",
            "TRIP_LANDING",
        )
        .distinct()
    )
