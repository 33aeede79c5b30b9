"""Explicit schemas of every input and intermediate table."""

from __future__ import annotations

# Landings database.
RECORDS = (
    "vr_number_fishing long, trip_id long, log_efrt_std_info_id long, landed_date date, "
    "date_fished date, gear_code int, latitude int, longitude int, licence_id long, "
    "species_code int, rnd_weight_kgs double, mon_doc_id long, nafo_unit_area_id int, "
    "lic_quota_id int"
)
VESSELS = "vr_number long, vessel_name string, gross_tonnage double, loa double"
AREAS = "area_id int, area string"
LIC_QUOTAS = "lic_quota_id int, sflt_quota_id int"
SFLT_QUOTAS = "sflt_quota_id int, sflt_desc_id int, fleet_quota_id int"
SFLT_DESCS = "sflt_desc_id int, desc_eng string"
FLEET_QUOTAS = "fleet_quota_id int"
DOC_ATTRIBUTES = "mon_doc_id long, column_defn_id int, data_value string"

# Observer database.
ISVESSELS = "vess_id long, cfv string, vessel_name string"
ISTRIPS = (
    "trip_id long, vess_id long, trip string, tripcd_id int, conf_number string, landing_date date"
)
ISFISHSETS = (
    "fishset_id long, trip_id long, gear_id long, set_no int, setcd_id int, specscd_id int, "
    "nafarea_id string"
)
ISSETPROFILE = "fishset_id long, pntcd_id int, setdate date, latitude double, longitude double"
ISGEARS = "gear_id long, gearcd_id int"
ISGEARFEATURES = "gear_id long, gearfcd_id int"

# Vessel positions, zone edges, caller-made groups and group results.
POSITIONS = "VR_NUMBER long, POSITION_UTC_DATE string, LATITUDE double, LONGITUDE double"
ZONE_EDGES = "zone_id int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"
GROUPS_CSV = (
    "X int, SECTOR int, ZONE int, Q int, UNOBS long, OBS long, COVERAGE double, DGROUP int, "
    "`GROUP` string"
)
GROUPS = "SECTOR int, ZONE int, Q int, `GROUP` string"
GROUP_RESULTS = "`GROUP` string, SIGNIFICANT string, SIGDISC double"

# Wide landings: identity columns, then one weight column per species code.
LANDING_KEYS = [
    "YEAR", "Q", "VR_NUMBER_FISHING", "VESSEL_NAME", "TC", "LC", "TRIP_ID", "LANDED_DATE",
    "LOG_EFRT_STD_INFO_ID", "DATE_FISHED", "GEAR_CODE", "AREA", "LON", "LAT", "LICENCE_ID",
    "SFLT_DESC_ID", "DESC_ENG", "TRIP",
]
WEIGHTS = ["100", "110", "170"]
LANDING = LANDING_KEYS + WEIGHTS
ZONED = LANDING + ["SECTOR", "ZONE"]
LANDINGS_WIDE = (
    "YEAR int, Q int, VR_NUMBER_FISHING long, VESSEL_NAME string, TC int, LC int, TRIP_ID long, "
    "LANDED_DATE date, LOG_EFRT_STD_INFO_ID long, DATE_FISHED date, GEAR_CODE int, AREA string, "
    "LON double, LAT double, LICENCE_ID long, SFLT_DESC_ID int, DESC_ENG string, TRIP string, "
    "`100` double, `110` double, `170` double"
)
OBSERVER_TRIPS = (
    "VR_NUMBER_FISHING long, VESSEL_NAME string, TRIP string, TRIPCD_ID int, CONF_NUMBER string, "
    "LANDED_DATE date, MINDATE date, MAXDATE date, GEARCD_ID int, SETCD_ID int, LAT double, "
    "LON double"
)
STRATUM = ["SECTOR", "ZONE", "Q"]
TRIP_KEYS = [
    "VR_NUMBER_FISHING", "VESSEL_NAME", "LICENCE_ID", "TC", "LC", "TRIP_ID", "LANDED_DATE",
    "GEAR_CODE", "Q", "TRIP", "ZONE", "SECTOR",
]
TRIPS = (
    "VR_NUMBER_FISHING long, VESSEL_NAME string, LICENCE_ID long, TC int, LC int, TRIP_ID long, "
    "LANDED_DATE date, GEAR_CODE int, Q int, TRIP string, ZONE int, SECTOR int, COD double, "
    "HAD double, POL double, OBS string"
)
