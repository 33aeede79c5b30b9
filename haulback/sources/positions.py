"""Vessel positions of both gear classes, and the caller's stratum groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback import schemas

POSITION_DAY = "yyyy/MM/dd"


def vessel_positions(mobile: DataFrame, fixed: DataFrame) -> DataFrame:
    return mobile.unionByName(fixed)


def read_positions(spark: SparkSession, snapshot_dir: str, year: int) -> DataFrame:
    """Positions of a year from a snapshot; the year and class are partition directories."""
    return (
        spark.read.schema(f"{schemas.POSITIONS}, year int, gear_class string")
        .parquet(f"{snapshot_dir}/positions")
        .filter(F.col("year") == year)
        .drop("year", "gear_class")
    )


def position_days(positions: DataFrame) -> DataFrame:
    """Positions with their calendar day; the stamp is wall-clock text, so no time zone applies."""
    return positions.withColumn("DATE", F.try_to_date(position_day_text(), POSITION_DAY))


def position_day_text() -> Column:
    return F.substring("POSITION_UTC_DATE", 1, 10)


def parse_day_month_year(text: Column, fmt: str = "dd-MM-yyyy") -> Column:
    """Date from day-month-year text; the exact form depends on the source's session setting."""
    return F.try_to_date(F.substring(text, 1, 10), fmt)


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Stratum groups from the strata CSV with an added GROUP column.

    Columns are found by the names in the header, so their order and any others do not matter; one
    that is absent, or a value of a stratum that is no integer, is an error.
    """
    table = spark.read.option("enforceSchema", False).csv(path, header=True)
    absent = [c for c in [*schemas.STRATUM, "GROUP"] if c not in table.columns]
    if absent:
        raise ValueError(f"{path} lacks {', '.join(absent)}; it has {', '.join(table.columns)}")
    return table.select(*[F.col(c).cast("int").alias(c) for c in schemas.STRATUM], "GROUP")


def stratum_groups(table: DataFrame) -> DataFrame:
    """The same from any table that carries the four columns among others."""
    return table.select("SECTOR", "ZONE", "Q", "GROUP")
