"""Small hand-made tables."""

import datetime as dt

from haulback import schemas

ZONED_SCHEMA = schemas.LANDINGS_WIDE + ", SECTOR int, ZONE int"
DAY = dt.date(2023, 5, 10)


def day(offset=0):
    return DAY + dt.timedelta(days=offset)


def _frame(spark, schema, rows, defaults):
    names = [f.strip().split(" ")[0].strip("`") for f in schema.split(",")]
    unknown = {k for r in rows for k in r} - set(names)
    assert not unknown, unknown
    data = [tuple(({**defaults, **r}).get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def landings(spark, *rows, schema=schemas.LANDINGS_WIDE):
    defaults = {
        "YEAR": 2023, "Q": 2, "VR_NUMBER_FISHING": 1, "VESSEL_NAME": "A", "TC": 1, "LC": 1,
        "TRIP_ID": 1, "LANDED_DATE": DAY, "LOG_EFRT_STD_INFO_ID": 1, "DATE_FISHED": DAY,
        "GEAR_CODE": 12, "AREA": "5ZE", "LON": -66.5, "LAT": 41.5, "LICENCE_ID": 7,
        "SFLT_DESC_ID": 90, "DESC_ENG": "x", "SECTOR": 90, "ZONE": 1,
    }
    return _frame(spark, schema, list(rows), defaults)


def zoned(spark, *rows):
    return landings(spark, *rows, schema=ZONED_SCHEMA)


def observers(spark, *rows):
    defaults = {
        "VR_NUMBER_FISHING": 1, "VESSEL_NAME": "A", "TRIPCD_ID": 7001, "CONF_NUMBER": "c",
        "LANDED_DATE": DAY, "MINDATE": DAY, "MAXDATE": DAY, "GEARCD_ID": 12, "SETCD_ID": 1,
        "LAT": 41.5, "LON": -66.5,
    }
    return _frame(spark, schemas.OBSERVER_TRIPS, list(rows), defaults)


def trips(spark, *rows):
    defaults = {
        "VR_NUMBER_FISHING": 1, "VESSEL_NAME": "A", "LICENCE_ID": 7, "TC": 1, "LC": 1,
        "TRIP_ID": 1, "LANDED_DATE": DAY, "GEAR_CODE": 12, "Q": 2, "ZONE": 1, "SECTOR": 90,
        "COD": 1.0, "HAD": 1.0, "POL": 0.0, "OBS": "N",
    }
    return _frame(spark, schemas.TRIPS, list(rows), defaults)


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
