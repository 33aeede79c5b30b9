"""Observer sources: trips, separator-panel features, species sought."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback.functions.codes import (
    EXCLUDED_GEARS,
    NO_PANEL_FEATURE,
    OTTER_TRAWL,
    PANEL_FEATURE,
)
from haulback import schemas
from haulback.sources.landings import AREA_PREFIX, year_range
from haulback.sources.stored import database_table, stored_table


@dataclass(frozen=True)
class ObserverTables:
    """The observer database as lazy frames (schemas in ``haulback.schemas``)."""

    isvessels: DataFrame
    istrips: DataFrame
    isfishsets: DataFrame
    issetprofile: DataFrame
    isgears: DataFrame
    isgearfeatures: DataFrame

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, path: str, *, date_format: str | None = None
    ) -> ObserverTables:
        """Stored tables, checked against ``haulback.schemas``; see ``stored_table`` for text dates."""
        return cls(
            **{
                n: stored_table(spark, f"{path}/{n}", getattr(schemas, n.upper()), date_format=date_format)
                for n in cls.names()
            }
        )

    @classmethod
    def from_jdbc(cls, spark: SparkSession, tables: dict[str, str | dict], **options) -> ObserverTables:
        """Tables of a database; ``tables`` maps a field to its table or to reader options of its own
        (see ``database_table``), ``options`` hold for all."""
        return cls(**{n: database_table(spark, tables[n], options) for n in cls.names()})


def _sets(tables: ObserverTables) -> DataFrame:
    return tables.isfishsets.filter(F.col("nafarea_id").startswith(AREA_PREFIX))


def _trips_with_vessel(tables: ObserverTables) -> DataFrame:
    return tables.istrips.join(tables.isvessels, "vess_id")


def pull_observer_trips(tables: ObserverTables, year: int | None = None) -> DataFrame:
    """One row per vessel, trip, landing date, gear and set type with first/last set and position.

    Profile points are folded per set where they are read, then per trip, gear and set type before
    the wide vessel and trip attributes are attached, so only the folded rows travel; trip ids and gear ids that share a
    trip number or gear code are folded again by the outer grouping.
    """
    points = tables.issetprofile.filter(year_range(F.col("setdate"), year)).filter(
        F.col("setdate").isNotNull()
    )
    gears = tables.isgears.filter(~F.col("gearcd_id").isin(*EXCLUDED_GEARS))
    folds = [
        F.min("MINDATE").alias("MINDATE"),
        F.max("MAXDATE").alias("MAXDATE"),
        F.min("LAT").alias("LAT"),
        F.min("LON").alias("LON"),
    ]
    by_set = points.groupBy("fishset_id").agg(
        F.min("setdate").alias("MINDATE"),
        F.max("setdate").alias("MAXDATE"),
        F.min("latitude").alias("LAT"),
        F.min("longitude").alias("LON"),
    )
    folded = (
        _sets(tables)
        .select("fishset_id", "trip_id", "gear_id", "setcd_id")
        .join(by_set, "fishset_id")
        .groupBy("trip_id", "gear_id", "setcd_id")
        .agg(*folds)
    )
    keys = [
        F.col("cfv").cast("long").alias("VR_NUMBER_FISHING"),
        F.col("vessel_name").alias("VESSEL_NAME"),
        F.col("trip").alias("TRIP"),
        F.col("tripcd_id").alias("TRIPCD_ID"),
        F.col("conf_number").alias("CONF_NUMBER"),
        F.col("landing_date").alias("LANDED_DATE"),
        F.col("gearcd_id").alias("GEARCD_ID"),
        F.col("setcd_id").alias("SETCD_ID"),
    ]
    return (
        folded.join(_trips_with_vessel(tables), "trip_id")
        .join(gears, "gear_id")
        .groupBy(*keys)
        .agg(*folds)
    )


def panel_features(tables: ObserverTables, year: int | None = None) -> DataFrame:
    """Trawl trips with their panel feature (89 none, 90 fitted) and number of sets."""
    trips = _trips_with_vessel(tables).filter(year_range(F.col("landing_date"), year))
    trips = trips.filter(F.col("landing_date").isNotNull())
    gears = tables.isgears.filter(F.col("gearcd_id") == OTTER_TRAWL)
    features = tables.isgearfeatures.filter(
        F.col("gearfcd_id").isin(NO_PANEL_FEATURE, PANEL_FEATURE)
    )
    points = tables.issetprofile.filter(F.col("pntcd_id") == 2).select("fishset_id")
    return (
        _sets(tables)
        .select("fishset_id", "trip_id", "gear_id", "set_no")
        .join(points, "fishset_id")
        .join(gears, "gear_id")
        .join(features, "gear_id")
        .join(trips, "trip_id")
        .groupBy(
            F.col("cfv").alias("CFV"),
            F.col("vessel_name").alias("VESSEL_NAME"),
            F.col("trip").alias("TRIP"),
            F.col("landing_date").alias("LANDING_DATE"),
            F.col("gearcd_id").alias("GEARCD_ID"),
            F.col("gearfcd_id").alias("GEARFCD_ID"),
        )
        .agg(F.count("set_no").alias("N_SETS"))
    )


def sought_sets(tables: ObserverTables, year: int | None = None) -> DataFrame:
    """Fishing sets with the species they sought, each set date once."""
    trips = _trips_with_vessel(tables).filter(year_range(F.col("landing_date"), year))
    trips = trips.filter(F.col("landing_date").isNotNull())
    points = tables.issetprofile.filter(F.col("pntcd_id").isin(1, 2))
    return (
        _sets(tables)
        .filter(F.col("setcd_id") == 1)
        .select("fishset_id", "trip_id", "gear_id", "set_no", "specscd_id")
        .join(points.select("fishset_id", "setdate").distinct(), "fishset_id")
        .join(tables.isgears, "gear_id")
        .join(trips, "trip_id")
        .select(
            F.col("cfv").alias("CFV"),
            F.col("vessel_name").alias("VESSEL_NAME"),
            F.col("trip").alias("TRIP"),
            F.col("gearcd_id").alias("GEARCD_ID"),
            F.col("landing_date").alias("LANDING_DATE"),
            F.col("specscd_id").alias("SPECSCD_ID"),
            F.col("set_no").alias("SET_NO"),
            F.col("setdate").alias("SETDATE"),
        )
        .distinct()
    )
