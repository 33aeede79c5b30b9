"""Landings source: one row per fishing set, weights of the three species side by side."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.codes import (
    SPECIES,
    TRIP_ATTRIBUTE,
    decode_coordinate,
    length_class,
    tonnage_class,
)
from haulback.functions.missing import known_sum, na_sum
from haulback.operators.joins import null_safe_join
from haulback.sources.stored import database_table, stored_table

AREA_PREFIX = "5Z"


@dataclass(frozen=True)
class LandingTables:
    """The landings database as lazy frames (schemas in ``haulback.schemas``)."""

    records: DataFrame
    vessels: DataFrame
    areas: DataFrame
    lic_quotas: DataFrame
    sflt_quotas: DataFrame
    sflt_descs: DataFrame
    fleet_quotas: DataFrame
    doc_attributes: DataFrame

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, path: str, *, date_format: str | None = None
    ) -> LandingTables:
        """Stored tables, checked against ``haulback.schemas``; see ``stored_table`` for text dates."""
        return cls(
            **{
                n: stored_table(spark, f"{path}/{n}", getattr(schemas, n.upper()), date_format=date_format)
                for n in cls.names()
            }
        )

    @classmethod
    def from_jdbc(cls, spark: SparkSession, tables: dict[str, str | dict], **options) -> LandingTables:
        """Tables of a database; ``tables`` maps a field to its table or to reader options of its own
        (see ``database_table``), ``options`` hold for all."""
        return cls(**{n: database_table(spark, tables[n], options) for n in cls.names()})


def year_range(date: Column, year: int | None) -> Column:
    """date falls in the year, as a range so that it reaches the scan; no test without a year."""
    if year is None:
        return F.lit(True)
    return (date >= F.lit(dt.date(year, 1, 1))) & (date < F.lit(dt.date(year + 1, 1, 1)))


def wanted_records(tables: LandingTables, year: int | None = None) -> DataFrame:
    """Records of the three species landed in the year, with a known fishing date."""
    return tables.records.filter(
        F.col("species_code").isin(*SPECIES)
        & year_range(F.col("landed_date"), year)
        & F.quarter("date_fished").isNotNull()
    )


def with_attributes(records: DataFrame, tables: LandingTables, *measures: str) -> DataFrame:
    """Records of the area with vessel, area and fleet attributes, under the wide column names.

    The fleets, a row per licence quota, are sent to the records: by the few quotas there are, a
    shuffle would put all records into as many tasks.
    """
    areas = tables.areas.filter(F.col("area").startswith(AREA_PREFIX))
    fleets = (
        tables.lic_quotas.join(tables.sflt_quotas, "sflt_quota_id")
        .join(tables.sflt_descs, "sflt_desc_id")
        .join(tables.fleet_quotas.select("fleet_quota_id"), "fleet_quota_id")
        .select("lic_quota_id", "sflt_desc_id", "desc_eng")
    )
    joined = (
        records.join(areas, F.col("nafo_unit_area_id") == F.col("area_id"))
        .join(F.broadcast(fleets), "lic_quota_id")
        .join(tables.vessels, F.col("vr_number_fishing") == F.col("vr_number"))
    )
    return joined.select(
        F.year("landed_date").alias("YEAR"),
        F.quarter("date_fished").alias("Q"),
        F.col("vr_number_fishing").alias("VR_NUMBER_FISHING"),
        F.col("vessel_name").alias("VESSEL_NAME"),
        tonnage_class(F.col("gross_tonnage")).alias("TC"),
        length_class(F.col("loa")).alias("LC"),
        F.col("trip_id").alias("TRIP_ID"),
        F.col("landed_date").alias("LANDED_DATE"),
        F.col("log_efrt_std_info_id").alias("LOG_EFRT_STD_INFO_ID"),
        F.col("date_fished").alias("DATE_FISHED"),
        F.col("gear_code").alias("GEAR_CODE"),
        F.col("area").alias("AREA"),
        decode_coordinate(F.col("latitude")).alias("LAT"),
        decode_coordinate(F.col("longitude"), sign=-1).alias("LON"),
        F.col("licence_id").alias("LICENCE_ID"),
        F.col("sflt_desc_id").alias("SFLT_DESC_ID"),
        F.col("desc_eng").alias("DESC_ENG"),
        F.col("mon_doc_id").alias("MON_DOC_ID"),
        *measures,
    )


def landing_records(tables: LandingTables, year: int | None = None) -> DataFrame:
    """Species records of the area and year with vessel, area and fleet attributes."""
    named = wanted_records(tables, year).withColumnsRenamed(
        {"species_code": "SPECIES_CODE", "rnd_weight_kgs": "RND_WEIGHT_KGS"}
    )
    return with_attributes(named, tables, "SPECIES_CODE", "RND_WEIGHT_KGS")


def trip_numbers(tables: LandingTables) -> DataFrame:
    """Observer trip number entered on each document."""
    return tables.doc_attributes.filter(F.col("column_defn_id") == TRIP_ATTRIBUTE).select(
        F.col("mon_doc_id").alias("MON_DOC_ID"), F.col("data_value").alias("TRIP")
    )


def species_weights(records: DataFrame) -> DataFrame:
    """Weight by set and species: null when any record of the species has no weight."""
    return records.groupBy(*schemas.LANDING_KEYS, "SPECIES_CODE").agg(
        na_sum("RND_WEIGHT_KGS").alias("SUM_WEIGHT")
    )


def landing_records_with_trip(tables: LandingTables, year: int | None = None) -> DataFrame:
    return with_trip_numbers(landing_records(tables, year), tables)


def with_trip_numbers(records: DataFrame, tables: LandingTables) -> DataFrame:
    """Records with their document's trip number; several numbers repeat the record."""
    salts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return null_safe_join(records, trip_numbers(tables), ["MON_DOC_ID"], salts=salts)


# What is known of a species in a group of records.
ABSENT, KNOWN, UNKNOWN = 0, 1, 2


def _state(code: int) -> str:
    return f"_state_{code}"


def pull_landings(tables: LandingTables, year: int | None = None) -> DataFrame:
    """Wide landings of one year (of all years without one).

    Records are folded by their own keys first, so the attribute joins, the document join and the
    wide grouping handle one row per set instead of one per species record.  A weight is null when
    the species is absent or any of its records has no weight.
    """
    records = wanted_records(tables, year)
    keys = [c for c in records.columns if c not in ("species_code", "rnd_weight_kgs")]
    weight = F.col("rnd_weight_kgs")
    partial, total = [], []
    for code in SPECIES:
        own = F.col("species_code") == code
        state = F.when(own & weight.isNull(), UNKNOWN).when(own, KNOWN).otherwise(ABSENT)
        partial += [
            known_sum(F.when(own, weight)).alias(str(code)),
            F.max(state).alias(_state(code)),
        ]
        known = F.max(_state(code)) == KNOWN
        total.append(F.when(known, F.sum(str(code))).alias(str(code)))
    folded = records.groupBy(*keys).agg(*partial)
    measures = [c for code in SPECIES for c in (str(code), _state(code))]
    numbered = with_trip_numbers(with_attributes(folded, tables, *measures), tables)
    return numbered.groupBy(*schemas.LANDING_KEYS).agg(*total).select(*schemas.LANDING)
