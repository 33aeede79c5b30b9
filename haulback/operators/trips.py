"""Trips aggregated from fishing sets, and the strata table a caller groups by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.missing import count_where, known_sum

GOOD_COVERAGE = 0.2  # Fixed value: above it a stratum stands alone.


def aggregate_trips(landings: DataFrame, *, require_sector: bool = False) -> DataFrame:
    """Weights per trip, stratum and vessel; a trip without a known weight has 0."""
    if require_sector:
        landings = landings.filter(F.col("SECTOR").isNotNull())
    keys = [
        F.col(c).cast("int").alias(c) if c in ("Q", "ZONE") else F.col(c) for c in schemas.TRIP_KEYS
    ]
    return (
        landings.groupBy(*keys)
        .agg(
            known_sum("100").alias("COD"),
            known_sum("110").alias("HAD"),
            known_sum("170").alias("POL"),
        )
        .withColumn("OBS", observed_flag())
    )


def observed_flag():
    """N without a trip number; a blank number counts as observed."""
    return F.when(F.col("TRIP").isNull(), "N").otherwise("Y")


def grouping_table(trips: DataFrame) -> DataFrame:
    """Strata not fully observed, with coverage by trip and whether they can stand alone."""
    coverage = F.col("COVERAGE")
    return (
        trips.groupBy(*schemas.STRATUM)
        .agg(
            count_where(F.col("TRIP").isNull()).alias("UNOBS"),
            count_where(F.col("TRIP").isNotNull()).alias("OBS"),
        )
        .withColumn("COVERAGE", F.col("OBS") / (F.col("UNOBS") + F.col("OBS")))
        .filter(coverage != 1)
        .withColumn(
            "DGROUP",
            F.when((coverage > GOOD_COVERAGE) & (coverage < 1), 1).when(
                coverage < GOOD_COVERAGE, 2
            ),
        )
    )
