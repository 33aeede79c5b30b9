"""Observer coverage by sector and by stratum."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.missing import count_where


class CoverageSummary(NamedTuple):
    fleet: DataFrame
    mean: DataFrame
    fleet_all_observed: DataFrame
    stratum: DataFrame
    stratum_all_observed: DataFrame


def coverage_by(landings: DataFrame, on: Sequence[str]) -> DataFrame:
    """Observed and unobserved fishing sets per key; every group has a set to divide by."""
    counted = landings.groupBy(*on).agg(
        count_where(F.col("TRIP").isNotNull()).alias("OBS"),
        count_where(F.col("TRIP").isNull()).alias("UNOBS"),
    )
    return counted.withColumn("COVERAGE", F.col("OBS") / (F.col("OBS") + F.col("UNOBS")))


def mean_coverage(fleet: DataFrame) -> DataFrame:
    """Unweighted mean over the sectors."""
    return fleet.agg(F.avg("COVERAGE").alias("value")).select(
        F.lit("MEAN COVERAGE").alias("desc"), "value"
    )


def all_observed(coverage: DataFrame) -> DataFrame:
    return coverage.filter(F.col("COVERAGE") == 1)


def coverage_summary(landings: DataFrame) -> CoverageSummary:
    """The five tables of the coverage report.

    Sectors are summed from the strata, so the landings are read and shuffled once.
    """
    stratum = coverage_by(landings, schemas.STRATUM)
    fleet = fleet_coverage(stratum)
    return CoverageSummary(
        fleet=fleet,
        mean=mean_coverage(fleet),
        fleet_all_observed=all_observed(fleet),
        stratum=stratum,
        stratum_all_observed=all_observed(stratum),
    )


def fleet_coverage(stratum: DataFrame) -> DataFrame:
    fleet = stratum.groupBy("SECTOR").agg(F.sum("OBS").alias("OBS"), F.sum("UNOBS").alias("UNOBS"))
    return fleet.withColumn("COVERAGE", F.col("OBS") / (F.col("OBS") + F.col("UNOBS")))
