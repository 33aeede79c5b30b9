"""Prorate a group's discards to its vessels by their share of the haddock landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.missing import ieee_divide, na_sum
from haulback.operators.bootstrap import attach_groups, in_group
from haulback.operators.joins import null_safe_join

VESSEL_KEYS = ["GROUP", *schemas.STRATUM, "VR_NUMBER_FISHING", "VESSEL_NAME", "LICENCE_ID"]


def attach_groups_full(trips: DataFrame, groups: DataFrame) -> DataFrame:
    """Full outer join of trips and grouping strata: strata without trips stay as empty rows.

    Built as a left join and the unmatched strata, because a full outer join can neither broadcast
    the small side nor split a hot stratum.
    """
    groups = groups.select(*schemas.STRATUM, "GROUP")
    present = trips.select(*schemas.STRATUM).distinct()
    empty = null_safe_join(groups, present, schemas.STRATUM, "left_anti")
    return attach_groups(trips, groups).unionByName(empty, allowMissingColumns=True)


def vessel_totals(grouped: DataFrame) -> DataFrame:
    """Cod and haddock by group, stratum and vessel; null when any trip's weight is."""
    return (
        grouped.filter(in_group())
        .groupBy(*VESSEL_KEYS)
        .agg(na_sum("COD").alias("COD"), na_sum("HAD").alias("HAD"))
    )


def significant_totals(totals: DataFrame, results: DataFrame) -> DataFrame:
    """Vessel totals of the groups with discards to share; the results, a row per group, are sent to them."""
    results = results.select("GROUP", "SIGNIFICANT", "SIGDISC").filter("SIGDISC > 0")
    return totals.join(F.broadcast(results), "GROUP")


def share_discards(totals: DataFrame) -> DataFrame:
    """HAD / group HAD x SIGDISC; the group sum is folded and joined back, not windowed."""
    sums = totals.groupBy(F.col("GROUP").alias("_group")).agg(na_sum("HAD").alias("_group_had"))
    share = ieee_divide(F.col("HAD"), F.col("_group_had"))
    return (
        totals.join(F.broadcast(sums), F.col("GROUP") == F.col("_group"))
        .withColumn("DISCARDS", share * F.col("SIGDISC"))
        .drop("_group", "_group_had")
    )


def assign_discards(
    trips: DataFrame, groups: DataFrame, results: DataFrame, *, ignore_empty: bool = False
) -> DataFrame:
    """Discards by stratum and vessel.

    ``results`` has GROUP, SIGNIFICANT and SIGDISC from the caller.  A grouping stratum without
    trips has no haddock weight and leaves its whole group's shares unknown; ``ignore_empty``
    drops such strata first.
    """
    grouped = attach_groups(trips, groups) if ignore_empty else attach_groups_full(trips, groups)
    shared = share_discards(significant_totals(vessel_totals(grouped), results))
    return shared.select(*VESSEL_KEYS[1:], "DISCARDS")
