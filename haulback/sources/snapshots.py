"""Yearly snapshot of the input tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback import schemas
from haulback.sources.by_vessel import read_by_vessel, write_by_vessel
from haulback.sources.landings import LandingTables, pull_landings, year_range
from haulback.sources.observers import ObserverTables, pull_observer_trips
from haulback.sources.positions import position_days
from haulback.sources.publish import publication

GEAR_CLASSES = ("mobile", "fixed")


def fleet_snapshot(fleets: dict[str, DataFrame], year: int) -> DataFrame:
    """Fleet trips of both gear classes landed in the calendar year."""
    return _by_class(
        {name: df.filter(year_range(F.col("LANDED_DATE"), year)) for name, df in fleets.items()},
        year,
    )


def position_snapshot(
    fleets: dict[str, DataFrame], positions: dict[str, DataFrame], year: int
) -> DataFrame:
    """Positions in the year of the vessels that landed in each gear class."""
    out = {}
    for name, table in positions.items():
        vessels = (
            fleets[name]
            .filter(year_range(F.col("LANDED_DATE"), year))
            .select(F.col("VR_NUMBER_FISHING").alias("VR_NUMBER"))
            .distinct()
        )
        dated = position_days(table).filter(year_range(F.col("DATE"), year)).drop("DATE")
        out[name] = dated.join(vessels, "VR_NUMBER", "left_semi")
    return _by_class(out, year)


def _by_class(tables: dict[str, DataFrame], year: int) -> DataFrame:
    parts = [
        df.withColumn("year", F.lit(year)).withColumn("gear_class", F.lit(name))
        for name, df in tables.items()
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def write_snapshot(
    directory: str,
    year: int,
    landings: LandingTables,
    observers: ObserverTables,
    fleets: dict[str, DataFrame],
    positions: dict[str, DataFrame],
    *,
    buckets: int = 0,
) -> None:
    """Write databases (all years), fleets and positions (one year, by gear class) as Parquet.

    Fleets and positions are keyed by gear class; only the year's partitions are replaced.  With
    ``buckets`` the year's landings and observer trips, as they are pulled from the databases, are
    written as well, laid out by vessel and landing date in so many buckets, so that matching them
    needs no shuffle (``read_pulled``).  All tables are put in place together: a run that fails
    leaves the former snapshot whole.
    """
    spark = landings.records.sparkSession
    with publication(spark, directory) as stage:
        for group, tables in (("landings", landings), ("observers", observers)):
            for name in tables.names():
                getattr(tables, name).write.parquet(stage.path(f"{group}/{name}"))
        parts = {"fleets": fleet_snapshot(fleets, year), "positions": position_snapshot(fleets, positions, year)}
        for name, df in parts.items():
            path = stage.path(name, f"year={year}")
            df.write.partitionBy("year", "gear_class").parquet(path)
        if buckets:
            pulled = {
                "landings": pull_landings(landings, year).select(*schemas.LANDING),
                "observers": pull_observer_trips(observers, year),
            }
            for name, df in pulled.items():
                write_by_vessel(df, stage.path(f"pulled/{name}_{year}"), buckets)


class Pulled(NamedTuple):
    landings: DataFrame
    observers: DataFrame


def read_pulled(spark: SparkSession, directory: str, year: int) -> Pulled:
    """A year's landings and observer trips as the snapshot has laid them out by vessel and date."""
    return Pulled(*(read_by_vessel(spark, f"{directory}/pulled/{name}_{year}") for name in Pulled._fields))
