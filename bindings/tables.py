"""The estimate's input tables, derived by Spark from the supplied order and event tables.

Every derived table grows with its source; key expressions are chosen so that each branch of the
estimate (missing, blank, equal and different trip numbers, near dates, fallback positions, ...)
has rows at any scale.  ``bindings.oracle`` states the same derivation in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback import schemas
from haulback.sources.landings import LandingTables
from haulback.sources.observers import ObserverTables

# Sub-fleet code of each nation key; 7001 belongs to no sector.
SFLT_CODES = [
    90, 89, 881, 92, 93, 884, 94, 885, 95, 8976, 886, 311, 7001, 8977, 9318, 9317, 10865, 3328,
    9319, 10866, 12305, 1472, 1817, 12195, 1523,
]

# Invented zones as (zone, rings of (x, y)): rectangles, a concave one, one with a hole, a triangle.
ZONES = [
    (1, [[(-67, 40), (-66, 40), (-66, 42), (-67, 42)]]),
    (2, [[(-67, 42), (-66, 42), (-66, 44), (-67, 44)]]),
    (
        3,
        [
            [
                (-69, 40), (-67, 40), (-67, 44), (-67.5, 44),
                (-67.5, 41.5), (-68.5, 42.25), (-68.5, 44), (-69, 44),
            ]
        ],
    ),
    (
        4,
        [
            [(-70, 40), (-69, 40), (-69, 44), (-70, 44)],
            [(-69.75, 41), (-69.25, 41), (-69.25, 42.5), (-69.75, 42.5)],
        ],
    ),
    (5, [[(-70.5, 40), (-69.5, 40), (-70, 43)]]),
]

SUPPLIED = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, "
    "l_tax double, l_returnflag string",
    "customer": "c_custkey long, c_name string, c_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
}

MOBILE_EVENTS = ("click", "view")


def zone_edge_rows() -> list[tuple]:
    rows = []
    for zone, rings in ZONES:
        for r, ring in enumerate(rings):
            for i, (x1, y1) in enumerate(ring):
                x2, y2 = ring[(i + 1) % len(ring)]
                rows.append((zone, r, i, float(x1), float(y1), float(x2), float(y2)))
    return rows


@dataclass(frozen=True)
class Inputs:
    landings: LandingTables
    observers: ObserverTables
    mobile: DataFrame
    fixed: DataFrame
    zone_edges: DataFrame


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A supplied table under its stated schema, so that no job runs to infer one."""
    return spark.read.schema(SUPPLIED[table]).parquet(f"{sf}/{table}.parquet")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("v"),
        F.col("o_orderstatus").alias("st"),
        F.to_date("o_orderdate").alias("d"),
    )


def _is(mod: int, rest: int = 0, col: str = "k") -> Column:
    return F.col(col) % mod == rest


def landing_tables(spark: SparkSession, sf: str) -> LandingTables:
    orders = _orders(spark, sf)
    k, v = F.col("k"), F.col("v")
    set_no = F.col("set_no")
    number, tax, flag = F.col("l_linenumber"), F.col("l_tax"), F.col("l_returnflag")
    lines = _read(spark, sf, "lineitem").select(
        "l_orderkey",
        (number % 3).alias("set_no"),
        F.when((number == 7) & (tax == 0.08), 200)
        .when(flag == "A", 100)
        .when(flag == "N", 110)
        .otherwise(170)
        .alias("species_code"),
        F.when((F.col("l_discount") != 0) | (tax != 0), F.col("l_quantity")).alias("rnd_weight_kgs"),
    )
    records = lines.join(orders, F.col("l_orderkey") == k).select(
        v.alias("vr_number_fishing"),
        k.alias("trip_id"),
        (k * 10 + set_no).alias("log_efrt_std_info_id"),
        F.col("d").alias("landed_date"),
        F.when(~_is(97, 5), F.date_sub("d", set_no)).alias("date_fished"),
        F.lit(12).alias("gear_code"),
        F.when(_is(17), 0)
        .otherwise(400000 + (k % 4) * 10000 + (v * 7) % 6000)
        .cast("int")
        .alias("latitude"),
        F.when(_is(17), 0)
        .otherwise(660000 + (k % 5) * 10000 + (v * 11) % 6000)
        .cast("int")
        .alias("longitude"),
        v.alias("licence_id"),
        "species_code",
        "rnd_weight_kgs",
        k.alias("mon_doc_id"),
        (v % 5).cast("int").alias("nafo_unit_area_id"),
        (v % 25).cast("int").alias("lic_quota_id"),
    )
    customers = _read(spark, sf, "customer")
    balance = F.col("c_acctbal")
    regions = _read(spark, sf, "region")
    nations = _read(spark, sf, "nation")
    key = F.col("n_nationkey")
    code = F.element_at(F.array(*[F.lit(c) for c in SFLT_CODES]), key + 1)
    numbered = F.when((F.col("st") == "O") & ~_is(25, 17, "v"), 742).otherwise(741)
    number = F.when((F.col("st") == "F") | _is(25, 17, "v"), F.concat(F.lit("T"), k.cast("string")))
    entered = orders.withColumn(
        "copies", F.when((F.col("st") == "F") & _is(53), F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1))
        )
    )
    return LandingTables(
        records=records,
        vessels=customers.select(
            F.col("c_custkey").alias("vr_number"),
            F.col("c_name").alias("vessel_name"),
            F.when(balance >= 0, balance / 4).alias("gross_tonnage"),
            F.when(balance >= 0, balance / 60).alias("loa"),
        ),
        areas=regions.select(
            F.col("r_regionkey").alias("area_id"),
            F.when(F.col("r_regionkey") < 3, F.concat(F.lit("5Z"), F.col("r_name")))
            .otherwise(F.col("r_name"))
            .alias("area"),
        ),
        lic_quotas=nations.select(key.alias("lic_quota_id"), (key + 100).alias("sflt_quota_id")),
        sflt_quotas=nations.select(
            (key + 100).alias("sflt_quota_id"),
            code.alias("sflt_desc_id"),
            (key % 7).alias("fleet_quota_id"),
        ),
        sflt_descs=nations.select(code.alias("sflt_desc_id"), F.col("n_name").alias("desc_eng")),
        fleet_quotas=nations.filter(key < 6).select(key.alias("fleet_quota_id")),
        doc_attributes=entered.select(
            k.alias("mon_doc_id"),
            numbered.alias("column_defn_id"),
            F.coalesce(number, F.lit("")).alias("data_value"),
            F.explode("copies"),
        ).drop("col"),
    )


def observer_tables(spark: SparkSession, sf: str) -> ObserverTables:
    k, v, st = F.col("k"), F.col("v"), F.col("st")
    orders = _orders(spark, sf)
    observed = orders.filter((st.isin("F", "P") & ~_is(3)) | ((st == "O") & _is(5)))
    # Trips without a number: no trawl gear and no commercial sets, or the missing number would
    # take every unobserved landing out with it.
    unnumbered = (st == "O") & _is(10)
    s, p = F.col("s"), F.col("p")
    sets = observed.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(2))))
    points = sets.withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(2))))
    gears = observed.select(k.alias("gear_id"), "k", "st")
    text = k.cast("string")
    features = [F.when(_is(7), 89), F.when(_is(2), 90), F.when(_is(5), 50)]
    return ObserverTables(
        isvessels=_read(spark, sf, "customer").select(
            F.col("c_custkey").alias("vess_id"),
            F.col("c_custkey").cast("string").alias("cfv"),
            F.col("c_name").alias("vessel_name"),
        ),
        istrips=observed.select(
            k.alias("trip_id"),
            v.alias("vess_id"),
            F.when(unnumbered, F.lit(None))
            .when(_is(11), F.concat(F.lit("X"), text))
            .otherwise(F.concat(F.lit("T"), text))
            .alias("trip"),
            F.when(~_is(23), 7001 + k % 2).cast("int").alias("tripcd_id"),
            F.concat(F.lit("C"), text).alias("conf_number"),
            F.date_add("d", (k % 7 - 3).cast("int")).alias("landing_date"),
        ),
        isfishsets=sets.select(
            (k * 3 + s).alias("fishset_id"),
            k.alias("trip_id"),
            k.alias("gear_id"),
            (s + 1).alias("set_no"),
            F.when(unnumbered, 4)
            .when(_is(13) & (s == 0), 7)
            .when(_is(4) & (s == 2), 4)
            .otherwise(1)
            .alias("setcd_id"),
            F.when(_is(12, 2), 16)
            .when(_is(12, 7), F.lit(None))
            .when((k + s) % 2 == 0, 10)
            .otherwise(11)
            .cast("int")
            .alias("specscd_id"),
            F.when(v % 5 < 3, F.concat(F.lit("5Z"), s.cast("string")))
            .otherwise("4X")
            .alias("nafarea_id"),
        ),
        issetprofile=points.select(
            (k * 3 + s).alias("fishset_id"),
            p.alias("pntcd_id"),
            F.date_sub("d", s).alias("setdate"),
            (40.0 + k % 4 + s * 0.25 + p * 0.125).alias("latitude"),
            (-(66.0 + k % 5 + s * 0.25)).alias("longitude"),
        ),
        isgears=gears.select(
            "gear_id",
            F.when(_is(29), 71)
            .when(_is(31), F.lit(None))
            .when(unnumbered | _is(37), 41)
            .otherwise(12)
            .cast("int")
            .alias("gearcd_id"),
        ),
        isgearfeatures=gears.select(
            "gear_id", F.explode(F.array_compact(F.array(*features))).alias("gearfcd_id")
        ),
    )


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    events = _read(spark, sf, "events").select(
        "event_id", "event_type", "user_id", F.date_format("ts", "HH:mm:ss").alias("clock")
    )
    day = F.date_sub("d", (F.col("event_id") % 3).cast("int"))
    return events.join(
        _orders(spark, sf).select("v", "d"), F.col("user_id") == F.col("v")
    ).select(
        F.col("user_id").alias("VR_NUMBER"),
        F.concat(F.date_format(day, "yyyy/MM/dd"), F.lit(" "), F.col("clock")).alias(
            "POSITION_UTC_DATE"
        ),
        (40.03125 + (F.col("event_id") % 64) / 16).alias("LATITUDE"),
        (-(66.03125 + (F.col("event_id") * 7) % 80 / 16)).alias("LONGITUDE"),
        "event_type",
    )


def inputs(spark: SparkSession, sf: str) -> Inputs:
    positions = _positions(spark, sf)
    mobile = F.col("event_type").isin(*MOBILE_EVENTS)
    return Inputs(
        landings=landing_tables(spark, sf),
        observers=observer_tables(spark, sf),
        mobile=positions.filter(mobile).drop("event_type"),
        fixed=positions.filter(~mobile).drop("event_type"),
        zone_edges=spark.createDataFrame(zone_edge_rows(), schemas.ZONE_EDGES),
    )


def group_table(strata: DataFrame) -> DataFrame:
    """The caller's step: a GROUP on each stratum, and one stratum that has no trips."""
    sector = F.col("SECTOR")
    group = (
        F.when(sector == 881, "excluded")
        .when(sector == 90, "G90")
        .when(sector == 89, "G89")
        .when(sector.isin(311, 885), "MOBILE")
        .when(sector.isin(884, 886), "FIXED")
    )
    named = strata.withColumn("GROUP", group).select(*schemas.STRATUM, "GROUP")
    empty = strata.sparkSession.createDataFrame([(884, 99, 1, "FIXED")], schemas.GROUPS)
    return named.unionByName(empty)


def group_results(grouped: DataFrame) -> DataFrame:
    """The caller's significance table, from the grouped trips."""
    factor = F.when(F.col("GROUP") == "MOBILE", 0.0).otherwise(0.0625)
    return (
        grouped.filter(F.col("GROUP").isNotNull() & (F.col("GROUP") != "excluded"))
        .groupBy("GROUP")
        .agg(F.sum("COD").alias("COD"))
        .select("GROUP", F.lit("Y").alias("SIGNIFICANT"), (F.col("COD") * factor).alias("SIGDISC"))
    )
