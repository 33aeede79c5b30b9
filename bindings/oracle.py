"""The same tables and results stated in DuckDB SQL, for comparison with the Spark queries.

``STEPS`` holds named common table expressions; ``statement(select)`` puts in front of a SELECT
those it needs, in order.
"""

from __future__ import annotations

import math
import re

from bindings.tables import MOBILE_EVENTS, SFLT_CODES, zone_edge_rows

# Fixed values of the method, stated here again so that a wrong one in the library shows.
TONNAGE_BOUNDS = {7: 2000, 6: 1000, 5: 500, 4: 150, 3: 50, 2: 25, 1: 1}
LENGTH_BOUNDS = {6: 125, 5: 100, 4: 65, 3: 45, 2: 35, 1: 1}
SECTOR_CODES = {
    90: (90, 91, 92, 93, 94, 95, 8976, 8977, 9318, 9319, 10865, 10866, 12305, 12195),
    89: (89, 9317),
    881: (881,),
    884: (884, 6875),
    885: (885, 1472),
    886: (886, 1817),
    311: (311, 1523),
    3328: (3328,),
}
SATURATION = 8.292
PROBABILITIES = [k / 1000 for k in range(1, 991)]
# Of the draws: a Mersenne prime, the rows of a block, the split points of a stream, and halvings that
# leave single blocks of the largest group.
PRIME = (1 << 31) - 1
BLOCK_SIZE = 512
STREAM_POINTS = 1 << 15
HALVINGS = 8

SEED = 10
NBOOT = 1000
SMALL_BLOCK = 256
YEAR = 1998


def values(rows) -> str:
    def lit(v):
        if isinstance(v, str):
            return f"'{v}'"
        if v in (float("inf"), float("-inf")):
            return f"'{v}'::DOUBLE"
        return f"{v!r}::DOUBLE" if isinstance(v, float) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def divide(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} <> 0 THEN {a} / {b} "
        f"WHEN isnan({a}) THEN 'nan'::DOUBLE WHEN {a} > 0 THEN 'inf'::DOUBLE "
        f"WHEN {a} < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END"
    )


def na_sum(x: str) -> str:
    return f"CASE WHEN count(*) = count({x}) THEN sum({x}) END"


def classes(x: str, bounds: dict[int, int]) -> str:
    whens = " ".join(f"WHEN {x} >= {low} THEN {label}" for label, low in bounds.items())
    return f"CASE {whens} ELSE 0 END"


def coordinate(x: str, sign: int) -> str:
    return (
        f"CASE WHEN {x} > 0 THEN round(trunc({x} / 10000) + ({x} % 10000) / 6000, 5) * {sign} END"
    )


def matches(a: str, b: str, cols: list[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def normal_quantile(p: float) -> float:
    """The standard normal quantile, by bisection of the distribution function."""
    ends = {0.0: float("-inf"), 0.5: 0.0, 1.0: float("inf")}
    if p in ends:
        return ends[p]
    low, high = -10.0, 10.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if math.erfc(-middle / math.sqrt(2)) / 2 < p else (low, middle)
    return (low + high) / 2


def columns(cols: list[str], prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in cols)


IDENT = [
    "YEAR", "Q", "VR_NUMBER_FISHING", "VESSEL_NAME", "TC", "LC", "TRIP_ID", "LANDED_DATE",
    "LOG_EFRT_STD_INFO_ID", "DATE_FISHED", "GEAR_CODE", "AREA", "LON", "LAT", "LICENCE_ID",
    "SFLT_DESC_ID", "DESC_ENG",
]
WEIGHTS = ["100", "110", "170"]
LAND = [*IDENT, "TRIP", *WEIGHTS]
ZONED = [*LAND, "SECTOR", "ZONE"]
STRATUM = ["SECTOR", "ZONE", "Q"]
TRIP_KEYS = [
    "VR_NUMBER_FISHING", "VESSEL_NAME", "LICENCE_ID", "TC", "LC", "TRIP_ID", "LANDED_DATE",
    "GEAR_CODE", "Q", "TRIP", "ZONE", "SECTOR",
]
RECORD_KEYS = ["VR_NUMBER_FISHING", "TRIP_ID", "LANDED_DATE", "DATE_FISHED", *WEIGHTS]
OBSERVER_ORDER = ", ".join(
    f"{c} NULLS LAST"
    for c in ["TRIP", "TRIPCD_ID", "CONF_NUMBER", "MINDATE", "MAXDATE", "GEARCD_ID", "SETCD_ID"]
)
C, H, P = 'coalesce("100", 0)', 'coalesce("110", 0)', 'coalesce("170", 0)'

STEPS: dict[str, str] = {}
S = STEPS

# Source tables.
S["ord"] = """SELECT o_orderkey AS k, o_custkey AS v, o_orderstatus AS st,
    CAST(o_orderdate AS DATE) AS d FROM orders"""
S["records"] = """SELECT v AS vr_number_fishing, k AS trip_id,
    k * 10 + l_linenumber % 3 AS log_efrt_std_info_id, d AS landed_date,
    CASE WHEN k % 97 <> 5 THEN d - l_linenumber % 3 END AS date_fished,
    CASE WHEN k % 17 = 0 THEN 0 ELSE 400000 + (k % 4) * 10000 + (v * 7) % 6000 END AS latitude,
    CASE WHEN k % 17 = 0 THEN 0 ELSE 660000 + (k % 5) * 10000 + (v * 11) % 6000 END AS longitude,
    CASE WHEN l_linenumber = 7 AND l_tax = 0.08 THEN 200 WHEN l_returnflag = 'A' THEN 100
        WHEN l_returnflag = 'N' THEN 110 ELSE 170 END AS species_code,
    CASE WHEN l_discount <> 0 OR l_tax <> 0 THEN l_quantity END AS rnd_weight_kgs
    FROM lineitem JOIN ord ON l_orderkey = k"""
S["vessels"] = """SELECT c_custkey AS vr_number, c_name AS vessel_name,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal / 4 END AS gross_tonnage,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal / 60 END AS loa FROM customer"""
S["codes"] = (
    "SELECT * FROM (" + values(list(enumerate(SFLT_CODES))) + ") AS t(nation, sflt_desc_id)"
)
S["fleets"] = """SELECT n_nationkey AS nation, sflt_desc_id, n_name AS desc_eng
    FROM nation JOIN codes ON nation = n_nationkey
    WHERE n_nationkey % 7 IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 6)"""
S["landing_records"] = f"""SELECT CAST(year(landed_date) AS INTEGER) AS YEAR,
    CAST(quarter(date_fished) AS INTEGER) AS Q, vr_number_fishing AS VR_NUMBER_FISHING,
    vessel_name AS VESSEL_NAME, {classes("gross_tonnage", TONNAGE_BOUNDS)} AS TC,
    {classes("loa", LENGTH_BOUNDS)} AS LC, trip_id AS TRIP_ID, landed_date AS LANDED_DATE,
    log_efrt_std_info_id AS LOG_EFRT_STD_INFO_ID, date_fished AS DATE_FISHED, 12 AS GEAR_CODE,
    '5Z' || r_name AS AREA, {coordinate("longitude", -1)} AS LON,
    {coordinate("latitude", 1)} AS LAT, vr_number_fishing AS LICENCE_ID,
    sflt_desc_id AS SFLT_DESC_ID, desc_eng AS DESC_ENG, species_code AS SPECIES_CODE,
    rnd_weight_kgs AS RND_WEIGHT_KGS, trip_id AS MON_DOC_ID
    FROM records JOIN vessels ON vr_number = vr_number_fishing
    JOIN region ON r_regionkey = vr_number_fishing % 5
    JOIN fleets ON nation = vr_number_fishing % 25
    WHERE r_regionkey < 3 AND species_code IN (100, 110, 170) AND date_fished IS NOT NULL"""
S["trip_numbers"] = """SELECT k AS MON_DOC_ID,
    CASE WHEN st = 'F' OR v % 25 = 17 THEN 'T' || k ELSE '' END AS TRIP
    FROM ord, range(CASE WHEN st = 'F' AND k % 53 = 0 THEN 2 ELSE 1 END) AS copies(n)
    WHERE st <> 'O' OR v % 25 = 17"""
S["numbered"] = """SELECT r.*, t.TRIP FROM landing_records r
    LEFT JOIN trip_numbers t ON r.MON_DOC_ID IS NOT DISTINCT FROM t.MON_DOC_ID"""
S["species_weights"] = f"""SELECT {columns(IDENT)}, TRIP, SPECIES_CODE,
    {na_sum("RND_WEIGHT_KGS")} AS SUM_WEIGHT FROM numbered GROUP BY ALL"""
S["wide"] = f"""SELECT {columns(IDENT)}, TRIP,
    max(SUM_WEIGHT) FILTER (SPECIES_CODE = 100) AS "100",
    max(SUM_WEIGHT) FILTER (SPECIES_CODE = 110) AS "110",
    max(SUM_WEIGHT) FILTER (SPECIES_CODE = 170) AS "170"
    FROM species_weights GROUP BY ALL"""
S["obs_ord"] = """SELECT *, st = 'O' AND k % 10 = 0 AS unnumbered FROM ord
    WHERE (st IN ('F', 'P') AND k % 3 <> 0) OR (st = 'O' AND k % 5 = 0)"""
S["istrips"] = """SELECT k, v, CASE WHEN unnumbered THEN NULL WHEN k % 11 = 0 THEN 'X' || k
    ELSE 'T' || k END AS TRIP, CAST(CASE WHEN k % 23 <> 0 THEN 7001 + k % 2 END AS INTEGER)
    AS TRIPCD_ID, 'C' || k AS CONF_NUMBER, d + CAST(k % 7 - 3 AS INTEGER) AS LANDED_DATE, d,
    CASE WHEN k % 29 = 0 THEN 71 WHEN k % 31 = 0 THEN NULL
        WHEN unnumbered OR k % 37 = 0 THEN 41 ELSE 12 END AS GEARCD_ID, unnumbered FROM obs_ord"""
S["sets"] = """SELECT i.*, CAST(s AS INTEGER) AS s,
    CASE WHEN unnumbered THEN 4 WHEN k % 13 = 0 AND s = 0 THEN 7
        WHEN k % 4 = 0 AND s = 2 THEN 4 ELSE 1 END AS SETCD_ID,
    CASE WHEN k % 12 = 2 THEN 16 WHEN k % 12 = 7 THEN NULL WHEN (k + s) % 2 = 0 THEN 10
        ELSE 11 END AS SPECSCD_ID FROM istrips i, range(3) AS sets(s) WHERE v % 5 < 3"""
S["points"] = """SELECT sets.*, p, d - s AS setdate,
    40.0 + k % 4 + s * 0.25 + p * 0.125 AS latitude, -(66.0 + k % 5 + s * 0.25) AS longitude
    FROM sets, range(1, 3) AS points(p)"""
S["observers"] = """SELECT v AS VR_NUMBER_FISHING, c_name AS VESSEL_NAME, TRIP, TRIPCD_ID,
    CONF_NUMBER, LANDED_DATE, min(setdate) AS MINDATE, max(setdate) AS MAXDATE, GEARCD_ID,
    SETCD_ID, CAST(min(latitude) AS DOUBLE) AS LAT, CAST(min(longitude) AS DOUBLE) AS LON
    FROM points JOIN customer ON c_custkey = v WHERE GEARCD_ID NOT IN (71, 62)
    GROUP BY ALL"""
S["features"] = """SELECT k, feature FROM obs_ord, (VALUES (89, 7), (90, 2), (50, 5)) f(feature, m)
    WHERE k % m = 0"""
S["panel_features"] = """SELECT CAST(v AS VARCHAR) AS CFV, c_name AS VESSEL_NAME, TRIP,
    LANDED_DATE AS LANDING_DATE, GEARCD_ID, feature AS GEARFCD_ID, count(s + 1) AS N_SETS
    FROM points JOIN features USING (k) JOIN customer ON c_custkey = v
    WHERE p = 2 AND GEARCD_ID = 12 AND feature IN (89, 90) GROUP BY ALL"""
S["sought_sets"] = """SELECT DISTINCT CAST(v AS VARCHAR) AS CFV, c_name AS VESSEL_NAME, TRIP,
    GEARCD_ID, LANDED_DATE AS LANDING_DATE, SPECSCD_ID, s + 1 AS SET_NO, setdate AS SETDATE
    FROM points JOIN customer ON c_custkey = v WHERE p IN (1, 2) AND SETCD_ID = 1"""
S["positions"] = f"""SELECT user_id AS VR_NUMBER,
    strftime(d - CAST(event_id % 3 AS INTEGER), '%Y/%m/%d') || ' ' || strftime(ts, '%H:%M:%S')
        AS POSITION_UTC_DATE, d - CAST(event_id % 3 AS INTEGER) AS "DATE",
    40.03125 + (event_id % 64) / 16 AS LATITUDE,
    -(66.03125 + ((event_id * 7) % 80) / 16) AS LONGITUDE,
    event_type IN {MOBILE_EVENTS} AS mobile
    FROM events JOIN ord ON user_id = v"""

# Reconciliation.
def first_observers_of(observers: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT VR_NUMBER_FISHING, LANDED_DATE,
    TRIP, TRIPCD_ID, CONF_NUMBER, MINDATE, MAXDATE, GEARCD_ID, SETCD_ID, row_number() OVER (
    PARTITION BY VR_NUMBER_FISHING, LANDED_DATE ORDER BY {OBSERVER_ORDER}) AS rn FROM {observers})
    WHERE rn = 1"""


def exact_with(wide: str, first: str) -> str:
    return f"""SELECT w.*, f.TRIP AS TRIP_OBS, f.TRIPCD_ID AS TRIPCD_OBS FROM {wide} w
    LEFT JOIN {first} f
    ON w.VR_NUMBER_FISHING IS NOT DISTINCT FROM f.VR_NUMBER_FISHING
    AND w.LANDED_DATE IS NOT DISTINCT FROM f.LANDED_DATE"""


def exact_of(wide: str, year: int) -> str:
    """The exact matches of a year's landings with the observer trips that set gear in it."""
    of_year = S["observers"].replace("FROM points", f"FROM (SELECT * FROM points WHERE year(setdate) = {year})")
    return exact_with(f"({wide})", f"({first_observers_of(f'({of_year})')})")


S["first_observers"] = first_observers_of("observers")
S["exact"] = exact_with("wide", "first_observers")
S["matched"] = "SELECT * FROM exact WHERE TRIPCD_OBS IS NOT NULL"
S["unmatched"] = """SELECT * EXCLUDE (TRIP_OBS, TRIPCD_OBS) FROM exact
    WHERE TRIPCD_OBS IS NULL"""
S["near"] = """SELECT u.*, o.TRIP AS TRIP_OBS, o.TRIPCD_ID AS TRIPCD_OBS FROM unmatched u
    LEFT JOIN observers o ON u.VR_NUMBER_FISHING = o.VR_NUMBER_FISHING
    AND u.LANDED_DATE BETWEEN o.LANDED_DATE - 2 AND o.LANDED_DATE + 2"""
S["near_matched"] = "SELECT * FROM near WHERE TRIPCD_OBS IS NOT NULL"
S["near_unmatched"] = "SELECT * FROM near WHERE TRIPCD_OBS IS NULL"
S["exact_equal"] = "SELECT * FROM matched WHERE TRIP IS NOT DISTINCT FROM TRIP_OBS"
S["exact_differ"] = "SELECT * FROM matched WHERE TRIP <> TRIP_OBS"
S["near_equal"] = "SELECT * FROM near_matched WHERE TRIP = TRIP_OBS"
S["near_differ"] = "SELECT * FROM near_matched WHERE TRIP <> TRIP_OBS"
S["unobserved"] = "SELECT * FROM near_unmatched WHERE TRIP IS NULL"
S["absent"] = "SELECT * FROM near_unmatched WHERE TRIP IS NOT NULL"
_REPAIRED = f"""{columns(IDENT)}, CASE WHEN TRIP = '' THEN TRIP_OBS ELSE TRIP END AS TRIP,
    {columns(WEIGHTS)}"""
S["reconciled"] = f"""SELECT {columns(LAND)} FROM exact_equal
    UNION ALL SELECT {_REPAIRED} FROM exact_differ
    UNION ALL SELECT {columns(LAND)} FROM near_equal
    UNION ALL SELECT {_REPAIRED} FROM near_differ
    UNION ALL SELECT {columns(LAND)} FROM unobserved
    UNION ALL SELECT {columns(LAND)} FROM absent"""
S["errors"] = f"""SELECT {columns(IDENT)}, TRIP AS TRIP_LANDING, TRIP_OBS,
    CASE WHEN TRIP = '' THEN 'trip number missing'
        ELSE 'trip number incorrect as compared to observer data' END AS COMMENT
    FROM (SELECT * FROM exact_differ UNION ALL SELECT * FROM near_differ)"""
_BRIEF = "VR_NUMBER_FISHING, TRIP_ID, LANDED_DATE, TRIP_LANDING, TRIP_OBS"
S["missing"] = f"SELECT DISTINCT {_BRIEF} FROM errors WHERE TRIP_LANDING = ''"
S["incorrect"] = f"SELECT DISTINCT {_BRIEF} FROM errors WHERE TRIP_LANDING <> ''"
S["absent_trips"] = """SELECT DISTINCT VR_NUMBER_FISHING, CAST(TRIP_ID AS VARCHAR) AS TRIP,
    LANDED_DATE, TRIP AS TRIP_LANDING FROM absent"""
S["to_check"] = """SELECT DISTINCT VR_NUMBER_FISHING, TRIP, LANDED_DATE,
    'match' AS TRIP_LANDING, 'Check if VRN, date landed, and trip number are correct' AS COMMENT
    FROM observers WHERE TRIP IN (SELECT TRIP_OBS FROM incorrect)"""
S["check_list"] = """SELECT * FROM to_check UNION ALL BY NAME SELECT * FROM absent_trips"""

# Variants of the reconciliation.
S["as_blank"] = f"""SELECT {columns(IDENT)},
    CASE WHEN TRIPCD_OBS IS NOT NULL AND coalesce(TRIP, '') <> coalesce(TRIP_OBS, '')
        AND coalesce(TRIP, '') = '' THEN TRIP_OBS ELSE TRIP END AS TRIP, {columns(WEIGHTS)}
    FROM (SELECT * FROM matched UNION ALL SELECT * FROM near)"""
S["replaced"] = f"""SELECT {columns(LAND)} FROM exact_equal
    UNION ALL SELECT {columns(IDENT)}, TRIP_OBS, {columns(WEIGHTS)} FROM exact_differ
    UNION ALL SELECT {columns(LAND)} FROM near_equal
    UNION ALL SELECT {columns(IDENT)}, TRIP_OBS, {columns(WEIGHTS)} FROM near_differ
    UNION ALL SELECT {columns(LAND)} FROM unobserved
    UNION ALL SELECT {columns(LAND)} FROM absent"""
S["nearest"] = """SELECT u.*, n.TRIP_OBS, n.coded FROM unmatched u LEFT JOIN LATERAL (
    SELECT o.TRIP AS TRIP_OBS, o.TRIPCD_ID IS NOT NULL AS coded FROM observers o
    WHERE u.VR_NUMBER_FISHING = o.VR_NUMBER_FISHING
        AND abs(date_diff('day', o.LANDED_DATE, u.LANDED_DATE)) <= 2
    ORDER BY abs(date_diff('day', o.LANDED_DATE, u.LANDED_DATE)), o.TRIP NULLS LAST,
        o.TRIPCD_ID IS NOT NULL LIMIT 1) n ON true"""
S["nearest_reconciled"] = f"""SELECT {columns(LAND)} FROM exact_equal
    UNION ALL SELECT {_REPAIRED} FROM exact_differ
    UNION ALL SELECT {_REPAIRED} FROM nearest WHERE coded AND TRIP_OBS IS NOT NULL
        AND TRIP IS NOT NULL
    UNION ALL SELECT {columns(LAND)} FROM nearest WHERE coded IS NOT TRUE"""

# Reports of the variants: a missing number is a blank one.
def reports_of(tag: str, differ: str, absent: str = "absent") -> None:
    S[f"errors_{tag}"] = f"""SELECT {columns(IDENT)}, TRIP AS TRIP_LANDING, TRIP_OBS,
    CASE WHEN coalesce(TRIP, '') = '' THEN 'trip number missing'
        ELSE 'trip number incorrect as compared to observer data' END AS COMMENT FROM ({differ})"""
    S[f"missing_{tag}"] = f"""SELECT DISTINCT {_BRIEF} FROM errors_{tag}
    WHERE coalesce(TRIP_LANDING, '') = ''"""


reports_of("as_blank", """SELECT * FROM (SELECT * FROM matched UNION ALL SELECT * FROM near_matched)
    WHERE coalesce(TRIP, '') <> coalesce(TRIP_OBS, '')""")
reports_of("nearest", """SELECT * EXCLUDE (TRIPCD_OBS) FROM exact_differ
    UNION ALL SELECT * EXCLUDE (coded) FROM nearest WHERE coded AND TRIP <> TRIP_OBS""")

# Sector and zone.
S["sectors"] = (
    "SELECT * FROM ("
    + values([(c, s) for s, members in SECTOR_CODES.items() for c in members])
    + ") AS t(code, SECTOR)"
)
S["sectored"] = """SELECT r.*, SECTOR FROM reconciled r LEFT JOIN sectors
    ON code = SFLT_DESC_ID"""
S["edges"] = (
    "SELECT * FROM (" + values(zone_edge_rows()) + ") AS t(zone_id, ring, seq, x1, y1, x2, y2)"
)


def zone_of(points: str, lat: str, lon: str) -> str:
    """Lowest zone with an odd number of edges east of the point, per distinct point."""
    return f"""SELECT lat, lon, min(zone_id) AS zone FROM (
    SELECT lat, lon, zone_id FROM (SELECT DISTINCT {lat} AS lat, {lon} AS lon FROM {points})
    JOIN edges ON (y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
    GROUP BY lat, lon, zone_id HAVING count(*) % 2 = 1) GROUP BY lat, lon"""


def zone_value(lat: str, lon: str, zone: str) -> str:
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN coalesce({zone}, 0) END"


S["reported_zones"] = zone_of("sectored", "LAT", "LON")
S["located"] = f"""SELECT s.*, {zone_value("s.LAT", "s.LON", "z.zone")} AS ZONE FROM sectored s
    LEFT JOIN reported_zones z ON s.LAT = z.lat AND s.LON = z.lon"""
S["unlocated"] = "SELECT * FROM located WHERE ZONE IS NULL OR ZONE < 1"
S["observer_positions"] = """SELECT DISTINCT ON (TRIP) TRIP, LAT AS OBS_LAT, LON AS OBS_LON
    FROM observers ORDER BY TRIP, (LAT IS NULL OR LON IS NULL), LAT, LON"""
S["wanted_days"] = """SELECT DISTINCT VR_NUMBER_FISHING, DATE_FISHED FROM unlocated
    WHERE TRIP IS NULL OR TRIP = ''"""
S["mean_positions"] = """SELECT VR_NUMBER, "DATE", avg(LATITUDE) AS MEAN_LAT,
    avg(LONGITUDE) AS MEAN_LON FROM positions
    WHERE (VR_NUMBER, "DATE") IN (SELECT (VR_NUMBER_FISHING, DATE_FISHED) FROM wanted_days)
    GROUP BY VR_NUMBER, "DATE" """
S["fallback"] = """SELECT u.*, CASE WHEN length(u.TRIP) > 0 THEN OBS_LAT ELSE MEAN_LAT END AS FLAT,
    CASE WHEN length(u.TRIP) > 0 THEN OBS_LON ELSE MEAN_LON END AS FLON FROM unlocated u
    LEFT JOIN observer_positions o ON u.TRIP = o.TRIP
    LEFT JOIN mean_positions m ON u.VR_NUMBER_FISHING = m.VR_NUMBER AND u.DATE_FISHED = m."DATE" """
S["fallback_zones"] = zone_of("fallback", "FLAT", "FLON")
S["corrected"] = f"""SELECT {columns(LAND, "f.")}, f.SECTOR,
    coalesce({zone_value("f.FLAT", "f.FLON", "z.zone")}, f.ZONE) AS ZONE FROM fallback f
    LEFT JOIN fallback_zones z ON f.FLAT = z.lat AND f.FLON = z.lon"""
S["zoned"] = f"""SELECT {columns(ZONED)} FROM located WHERE ZONE >= 1
    UNION ALL SELECT {columns(ZONED)} FROM corrected WHERE ZONE >= 1"""
S["no_zone"] = f"""SELECT {columns(ZONED)}, 'NO ZONE' AS COMMENT FROM corrected
    WHERE ZONE IS NULL OR ZONE < 1"""

# Splits.
S["type7"] = "SELECT DISTINCT TRIP FROM observers WHERE SETCD_ID = 7"
S["commercial"] = """SELECT * FROM zoned z WHERE NOT EXISTS (
    SELECT 1 FROM type7 t WHERE z.TRIP IS NOT DISTINCT FROM t.TRIP)"""
S["non_commercial"] = """SELECT DISTINCT *, 'NON COMMERCIAL TRIP' AS COMMENT FROM zoned z
    WHERE EXISTS (SELECT 1 FROM type7 t WHERE z.TRIP IS NOT DISTINCT FROM t.TRIP)"""
S["with_features"] = """SELECT c.*, f.GEARFCD_ID FROM commercial c LEFT JOIN panel_features f
    ON c.TRIP IS NOT DISTINCT FROM f.TRIP"""
S["panel"] = """SELECT * EXCLUDE (GEARFCD_ID) FROM with_features
    WHERE GEARFCD_ID IS NULL OR GEARFCD_ID <> 89"""
S["no_panel"] = """SELECT * EXCLUDE (GEARFCD_ID), 'DID NOT USE SEPARATOR PANEL' AS COMMENT
    FROM with_features WHERE GEARFCD_ID = 89"""
S["panel_exclusive"] = """SELECT * FROM commercial c WHERE NOT EXISTS (SELECT 1
    FROM panel_features f WHERE GEARFCD_ID = 89 AND c.TRIP IS NOT DISTINCT FROM f.TRIP)"""
S["other_species"] = """SELECT p.* FROM panel p JOIN (SELECT DISTINCT TRIP, SPECSCD_ID
    FROM sought_sets WHERE SPECSCD_ID NOT IN (10, 11)) s ON p.TRIP IS NOT DISTINCT FROM s.TRIP"""
S["ratios"] = f"SELECT *, {divide(C, H)} AS ratio FROM panel"
S["flagged"] = """SELECT *, CASE WHEN isnan(ratio) THEN NULL WHEN ratio > 0.8 THEN 1 ELSE 0 END
    AS flag FROM ratios"""
S["all_cod_trips"] = """SELECT TRIP_ID FROM flagged GROUP BY TRIP_ID
    HAVING count(*) = count(flag) AND avg(flag) = 1"""
S["all_cod"] = "SELECT * FROM panel WHERE TRIP_ID IN (SELECT TRIP_ID FROM all_cod_trips)"
S["finite"] = "SELECT * FROM flagged WHERE isfinite(ratio)"
S["turned_trips"] = """SELECT DISTINCT TRIP_ID FROM (SELECT TRIP_ID,
    first_value(flag) OVER w AS f, last_value(flag) OVER w AS l FROM finite WINDOW w AS (
    PARTITION BY TRIP_ID ORDER BY LOG_EFRT_STD_INFO_ID, flag
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) WHERE f = 0 AND l = 1"""
S["last_cod"] = """SELECT * FROM finite WHERE ratio > 0.8
    AND TRIP_ID IN (SELECT TRIP_ID FROM turned_trips)"""
S["pollock"] = f"SELECT * FROM panel WHERE {P} > {C} + {H}"
_KEPT = columns([c for c in ZONED if c not in WEIGHTS])
_FILLED = f'{_KEPT}, {C} AS "100", {H} AS "110", {P} AS "170"'
_RAW = f'{_KEPT}, "100", "110", "170"'
S["directed"] = f"""SELECT {_RAW}, 'SPECIES OTHER THAN COD OR HADDOCK SOUGHT' AS COMMENT
    FROM other_species
    UNION ALL SELECT {_RAW}, 'ALL SETS COD DIRECTED' FROM all_cod
    UNION ALL SELECT {_FILLED}, 'LAST SETS COD DIRECTED' FROM last_cod
    UNION ALL SELECT {_FILLED}, 'POLLOCK DIRECTED' FROM pollock"""


def _keys_match() -> str:
    return " AND ".join(f'p."{c}" IS NOT DISTINCT FROM d."{c}"' for c in RECORD_KEYS)


S["sought"] = f"""SELECT {columns(ZONED)} FROM panel p WHERE NOT EXISTS (
    SELECT 1 FROM directed d WHERE {_keys_match()})"""
S["sought_by_record"] = f"""SELECT {columns(ZONED)} FROM flagged p WHERE
    NOT ({P} > {C} + {H})
    AND TRIP_ID NOT IN (SELECT TRIP_ID FROM all_cod_trips)
    AND NOT (TRIP_ID IN (SELECT TRIP_ID FROM turned_trips) AND isfinite(ratio) AND ratio > 0.8)
    AND NOT EXISTS (SELECT 1 FROM sought_sets s WHERE SPECSCD_ID NOT IN (10, 11)
        AND p.TRIP IS NOT DISTINCT FROM s.TRIP)"""


def coverage(keys: str) -> str:
    return f"""SELECT {keys}, count(TRIP) AS OBS, count(*) - count(TRIP) AS UNOBS,
    count(TRIP) / count(*) AS COVERAGE FROM sought GROUP BY {keys}"""


S["fleet_coverage"] = coverage("SECTOR")
S["stratum_coverage"] = coverage("SECTOR, ZONE, Q")
S["full_strata"] = "SELECT SECTOR, ZONE, Q FROM stratum_coverage WHERE UNOBS = 0 AND OBS >= 1"
S["quarter_kept"] = f"""SELECT * FROM sought s WHERE NOT EXISTS (
    SELECT 1 FROM full_strata f WHERE {matches("s", "f", STRATUM)})"""
S["quarter_removed"] = f"""SELECT *, 'QUARTER WITH 100% OBSERVER COVERAGE' AS COMMENT
    FROM sought s WHERE EXISTS (
    SELECT 1 FROM full_strata f WHERE {matches("s", "f", STRATUM)})"""
S["removed"] = " UNION ALL ".join(
    f"SELECT {columns([*ZONED, 'COMMENT'])} FROM {t}"
    for t in ("no_zone", "non_commercial", "no_panel", "directed", "quarter_removed")
)


def trips_of(table: str) -> str:
    return f"""SELECT {columns(TRIP_KEYS)}, coalesce(sum("100"), 0) AS COD,
    coalesce(sum("110"), 0) AS HAD, coalesce(sum("170"), 0) AS POL,
    CASE WHEN TRIP IS NULL THEN 'N' ELSE 'Y' END AS OBS FROM {table}
    GROUP BY {columns(TRIP_KEYS)}"""


# Trips, groups, multiplier.
S["trips"] = trips_of("sought")
S["strata"] = """SELECT *, CASE WHEN COVERAGE > 0.2 AND COVERAGE < 1 THEN 1
    WHEN COVERAGE < 0.2 THEN 2 END AS DGROUP FROM (SELECT SECTOR, ZONE, Q,
    count(*) - count(TRIP) AS UNOBS, count(TRIP) AS OBS, count(TRIP) / count(*) AS COVERAGE
    FROM trips GROUP BY ALL) WHERE COVERAGE <> 1"""
S["stratum_groups"] = """SELECT SECTOR, ZONE, Q, CASE WHEN SECTOR = 881 THEN 'excluded'
    WHEN SECTOR = 90 THEN 'G90' WHEN SECTOR = 89 THEN 'G89'
    WHEN SECTOR IN (311, 885) THEN 'MOBILE' WHEN SECTOR IN (884, 886) THEN 'FIXED' END AS "GROUP"
    FROM strata UNION ALL SELECT 884, 99, 1, 'FIXED'"""
S["with_group"] = f"""SELECT t.*, g."GROUP" FROM trips t LEFT JOIN stratum_groups g
    ON {matches("t", "g", STRATUM)}"""
_ROW_KEY = ", ".join(
    f"coalesce('=' || CAST({c} AS VARCHAR), '~')" for c in sorted(TRIP_KEYS)
)
S["grouped"] = f"""SELECT "GROUP", CASE WHEN COD = 0 THEN 0.001 ELSE COD END AS COD,
    CASE WHEN HAD = 0 THEN 0.001 ELSE HAD END AS HAD, OBS,
    md5(concat_ws('|', {_ROW_KEY})) AS ROW_KEY
    FROM with_group WHERE "GROUP" IS NOT NULL AND "GROUP" <> 'excluded'"""


def multiplier(table: str, keys: str = "") -> str:
    def part(w: str, f: str) -> str:
        return (
            f"CASE WHEN count(*) FILTER (OBS IS NULL OR (OBS = '{f}' AND {w} IS NULL)) = 0 "
            f"THEN coalesce(sum({w}) FILTER (OBS = '{f}'), 0) END AS {w}_{f}"
        )

    parts = ", ".join(part(w, f) for f in "YN" for w in ("COD", "HAD"))
    lead = f"{keys}, " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    ratios = f"{divide('COD_Y', 'HAD_Y')} AS o, {divide('COD_N', 'HAD_N')} AS u"
    return f"""SELECT {lead}{divide("o", "u")} AS MULTIPLIER FROM (
    SELECT *, {ratios} FROM (SELECT {lead}{parts} FROM {table} {by}))"""


# Bootstrap.
G = '"GROUP"'


def coefficients(*stream: str) -> str:
    """Of the stream whose name is the parts, each with its length."""
    parts = [f"length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR)" for p in stream]
    name = f"concat_ws('|', {', '.join(parts)})"
    return ", ".join(
        f"('0x' || substr(md5({name}), {1 + 8 * i}, 8))::BIGINT % {PRIME} AS a{i}" for i in range(4)
    )


def uniform(x: str) -> str:
    u = "a3"
    for a in ("a2", "a1", "a0"):
        u = f"(({u} * (({x}) % {PRIME}) + {a}) % {PRIME})"
    return f"CAST({u} AS DOUBLE)"


def index(x: str, n: str) -> str:
    return f"CAST(floor({uniform(x)} / {PRIME}::DOUBLE * CAST({n} AS DOUBLE)) AS BIGINT)"


S["indexed"] = """SELECT *, row_number() OVER (
    PARTITION BY "GROUP" ORDER BY ROW_KEY, COD, HAD, OBS) - 1 AS IDX,
    count(*) OVER (PARTITION BY "GROUP") AS N FROM grouped"""
S["group_sizes"] = """SELECT "GROUP", count(*) AS N FROM grouped GROUP BY ALL"""


def add_halving(ranges: str, halves: str, size: int) -> None:
    """Ranges of several blocks cut in two: the left half's draws are the least number whose binomial
    distribution function passes the split point's uniform number."""
    S[f"{halves}_cut"] = f"""SELECT *, ({uniform("2 * x")} + {uniform("2 * x + 1")} / {PRIME}::DOUBLE)
        / {PRIME}::DOUBLE AS u FROM (SELECT *, {coefficients(str(SEED), str(size), G, "REP", "'split'", "bunch")},
        middle % {STREAM_POINTS} AS x FROM (SELECT *, (low + high) // 2 AS middle,
        (low + high) // 2 // {STREAM_POINTS} AS bunch, ((low + high) // 2 - low) * {size} AS a,
        least(high * {size}, N) - low * {size} AS r FROM {ranges} WHERE high - low > 1))"""
    log_height = """lgamma(draws + 1) - lgamma(k + 1) - lgamma(draws - k + 1)
        + k * ln(a / r) + (draws - k) * ln((r - a) / r)"""
    reach = "10 * sqrt(draws * (a / r) * (1 - a / r)) + 25"
    S[f"{halves}_left"] = f"""SELECT "GROUP", REP, low, min(k) FILTER (cdf > u) AS lefts FROM (
        SELECT *, sum(exp({log_height})) OVER (PARTITION BY "GROUP", REP, low ORDER BY k) AS cdf
        FROM (SELECT *, unnest(range(greatest(0, floor(draws * a / r - {reach})::BIGINT),
            1 + least(draws, ceil(draws * a / r + {reach})::BIGINT))) AS k FROM {halves}_cut))
        GROUP BY "GROUP", REP, low"""
    both = f"""FROM {halves}_cut c JOIN {halves}_left l
        ON c."GROUP" = l."GROUP" AND c.REP = l.REP AND c.low = l.low"""
    S[halves] = f"""SELECT * FROM {ranges} WHERE high - low <= 1
        UNION ALL SELECT c."GROUP", c.REP, N, c.low, middle, lefts {both} WHERE lefts > 0
        UNION ALL SELECT c."GROUP", c.REP, N, middle, high, draws - lefts {both} WHERE lefts < draws"""


def add_draws(size: int, tag: str = "") -> None:
    """Steps of the resample with blocks of the given size."""
    S[f"blocks{tag}"] = f"""SELECT "GROUP", IDX // {size} AS BLOCK, count(*) AS SIZE FROM indexed
    GROUP BY ALL"""
    S[f"ranges{tag}_0"] = f"""SELECT "GROUP", CAST(rep AS INTEGER) AS REP, N, 0 AS low,
    (N + {size - 1}) // {size} AS high, N AS draws FROM group_sizes, range({NBOOT}) r(rep)"""
    for i in range(HALVINGS):
        add_halving(f"ranges{tag}_{i}", f"ranges{tag}_{i + 1}", size)
    S[f"block_counts{tag}"] = f"""SELECT "GROUP", REP, low AS BLOCK, draws AS DRAWS
    FROM ranges{tag}_{HALVINGS}"""
    S[f"block_streams{tag}"] = f"""SELECT c.*, b.SIZE,
    {coefficients(str(SEED), str(size), f"c.{G}", "REP", "c.BLOCK")} FROM block_counts{tag} c
    JOIN blocks{tag} b ON c."GROUP" = b."GROUP" AND c.BLOCK = b.BLOCK"""
    S[f"draws{tag}"] = f"""SELECT "GROUP", REP, BLOCK * {size} + {index("K", "SIZE")} AS IDX
    FROM (SELECT *, unnest(range(1, DRAWS + 1)) AS K FROM block_streams{tag})"""
    S[f"drawn{tag}"] = f"""SELECT d."GROUP", REP, COD, HAD, OBS FROM draws{tag} d JOIN indexed i
    ON d."GROUP" = i."GROUP" AND d.IDX = i.IDX"""
    ratios = multiplier(f"drawn{tag}", '"GROUP", REP')
    S[f"replicates{tag}"] = ratios.replace("AS MULTIPLIER", "AS MULT")


add_draws(BLOCK_SIZE)
add_draws(SMALL_BLOCK, "_small")
_NORMAL = [(k, normal_quantile(k / NBOOT)) for k in range(NBOOT + 1)]
S["normal"] = "SELECT * FROM (" + values(_NORMAL) + ") AS t(K, Z)"
S["ranks"] = f"""SELECT "GROUP", REP, MULT, CAST(row_number() OVER (PARTITION BY "GROUP"
    ORDER BY MULT NULLS LAST, REP) AS INTEGER) AS ID, CASE WHEN NOT isnan(MULT) THEN (SELECT count(*)
    FROM replicates o WHERE o."GROUP" = r."GROUP" AND o.MULT <= r.MULT) END AS AT_MOST
    FROM replicates r"""
S["scores"] = f"""SELECT *, CASE WHEN 2 * Z0 + ZALPHA > {SATURATION} THEN 'inf'::DOUBLE
    ELSE 2 * Z0 + ZALPHA END AS CORRECTED FROM (SELECT r.*, ID / {NBOOT} AS ALPHA,
    AT_MOST / {NBOOT} AS OMEGA, a.Z AS ZALPHA, o.Z AS Z0 FROM ranks r JOIN normal a ON a.K = ID
    LEFT JOIN normal o ON o.K = AT_MOST)"""
S["usable"] = """SELECT "GROUP", MULT, avg(MULT) OVER (PARTITION BY "GROUP") AS mean
    FROM replicates WHERE MULT >= 0 AND NOT isnan(MULT)"""
S["summary"] = """SELECT "GROUP", avg(MULT) AS MEANMULT, var_samp(MULT) AS VAR,
    avg(MULT - mean) AS BIAS FROM usable GROUP BY "GROUP" """
S["probs"] = f"SELECT * FROM ({values([(p,) for p in PROBABILITIES])}) AS t(prob)"


def quantiles(score: str) -> str:
    """Type 7: linear between the order statistics around (n - 1) p."""
    return f"""SELECT "GROUP", prob, CASE WHEN lo = hi THEN lo_x ELSE
    (1 - (h - lo)) * lo_x + (h - lo) * hi_x END AS q FROM (
    SELECT h.*, a.x AS lo_x, b.x AS hi_x FROM (
        SELECT "GROUP", prob, (n - 1) * prob AS h, floor((n - 1) * prob) AS lo,
            ceil((n - 1) * prob) AS hi
        FROM (SELECT "GROUP", count(*) AS n FROM scores WHERE NOT isnan({score})
            GROUP BY "GROUP"), probs) h
    JOIN (SELECT "GROUP", {score} AS x, row_number() OVER (PARTITION BY "GROUP" ORDER BY {score})
        - 1 AS i FROM scores WHERE NOT isnan({score})) a ON a."GROUP" = h."GROUP" AND a.i = lo
    JOIN (SELECT "GROUP", {score} AS x, row_number() OVER (PARTITION BY "GROUP" ORDER BY {score})
        - 1 AS i FROM scores WHERE NOT isnan({score})) b ON b."GROUP" = h."GROUP" AND b.i = hi)"""


S["plain"] = quantiles("ZALPHA")
S["biased"] = quantiles("CORRECTED")
S["curves"] = """SELECT p."GROUP" AS "group", p.prob, p.q AS perc, b.q AS bcperc, MEANMULT,
    p.q * MEANMULT AS perc2, b.q * MEANMULT AS bcperc2 FROM plain p
    LEFT JOIN biased b ON p."GROUP" = b."GROUP" AND p.prob = b.prob
    LEFT JOIN summary s ON s."GROUP" = p."GROUP" """

# Allocation.
S["full_groups"] = f"""SELECT t.* EXCLUDE (SECTOR, ZONE, Q), coalesce(t.SECTOR, g.SECTOR) AS SECTOR,
    coalesce(t.ZONE, g.ZONE) AS ZONE, coalesce(t.Q, g.Q) AS Q, g."GROUP"
    FROM trips t FULL JOIN stratum_groups g ON {matches("t", "g", STRATUM)}"""
S["results"] = """SELECT "GROUP", 'Y' AS SIGNIFICANT,
    sum(COD) * CASE WHEN "GROUP" = 'MOBILE' THEN 0.0 ELSE 0.0625 END AS SIGDISC
    FROM with_group WHERE "GROUP" IS NOT NULL AND "GROUP" <> 'excluded' GROUP BY "GROUP" """
_VESSEL = '"GROUP", SECTOR, ZONE, Q, VR_NUMBER_FISHING, VESSEL_NAME, LICENCE_ID'


def totals_of(table: str) -> str:
    return f"""SELECT {_VESSEL}, {na_sum("COD")} AS COD, {na_sum("HAD")} AS HAD FROM {table}
    WHERE "GROUP" IS NOT NULL AND "GROUP" <> 'excluded' GROUP BY {_VESSEL}"""


def shares_of(table: str) -> str:
    share = divide("HAD", "total")
    return f"""SELECT SECTOR, ZONE, Q, VR_NUMBER_FISHING, VESSEL_NAME, LICENCE_ID,
    {share} * SIGDISC AS DISCARDS FROM (SELECT *, CASE WHEN count(HAD) OVER w = count(*) OVER w
        THEN sum(HAD) OVER w END AS total FROM {table} WINDOW w AS (PARTITION BY "GROUP"))"""


S["totals"] = totals_of("full_groups")
S["significant"] = """SELECT t.*, SIGNIFICANT, SIGDISC FROM totals t LEFT JOIN results r
    ON t."GROUP" = r."GROUP" WHERE SIGDISC > 0"""
S["discards"] = shares_of("significant")
S["totals_known"] = totals_of("with_group")
S["significant_known"] = S["significant"].replace("totals t", "totals_known t")
S["discards_known"] = shares_of("significant_known")

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def statement(select: str) -> str:
    """A SELECT with the steps it needs, directly or through other steps."""
    order = list(STEPS)
    needed: set[str] = set()

    def visit(text: str, limit: int) -> None:
        for word in set(_WORD.findall(text)):
            if word in STEPS and word not in needed and order.index(word) < limit:
                needed.add(word)
                visit(STEPS[word], order.index(word))

    visit(select, len(order))
    steps = ",\n".join(f"{n} AS MATERIALIZED ({STEPS[n]})" for n in order if n in needed)
    return f"WITH {steps}\n{select}" if needed else select
