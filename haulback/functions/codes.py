"""Fixed codes and classes of the landings data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Species codes of cod, haddock and pollock.
COD, HADDOCK, POLLOCK = 100, 110, 170
SPECIES = (COD, HADDOCK, POLLOCK)

# Fixed value: document attribute that holds the observer trip number.
TRIP_ATTRIBUTE = 741

# Lower bounds of tonnage and length classes.
TONNAGE_BOUNDS = {7: 2000, 6: 1000, 5: 500, 4: 150, 3: 50, 2: 25, 1: 1}
LENGTH_BOUNDS = {6: 125, 5: 100, 4: 65, 3: 45, 2: 35, 1: 1}

# Sub-fleet description codes of each sector.
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

# Gear and set codes of the observer data.
OTTER_TRAWL = 12
EXCLUDED_GEARS = (71, 62)
NO_PANEL_FEATURE, PANEL_FEATURE = 89, 90
NON_COMMERCIAL_SET = 7
TARGET_SPECIES_SOUGHT = (10, 11)


def _classify(value: Column, bounds: dict[int, int]) -> Column:
    """Label of the highest bound reached; 0 below all bounds and for a missing value."""
    reached = [F.when(value >= low, F.lit(label)) for label, low in bounds.items()]
    return F.coalesce(*reached, F.lit(0))


def tonnage_class(tonnage: Column) -> Column:
    return _classify(tonnage, TONNAGE_BOUNDS)


def length_class(length: Column) -> Column:
    return _classify(length, LENGTH_BOUNDS)


def decode_coordinate(packed: Column, sign: int = 1) -> Column:
    """Packed DDMMmm integer to decimal degrees, 5 places, null when not positive.

    Counted in whole hundred-thousandths of a degree, so the rounding is that of exact numbers.
    """
    degrees = F.floor(packed / 10000)
    minutes = packed.cast("long") - degrees * 10000
    units = degrees * 100000 + F.floor((minutes * 100000 + 3000) / 6000)
    return F.when(packed > 0, units / F.lit(sign * 100000.0))


def sector_table(spark: SparkSession, codes: dict[int, tuple[int, ...]] | None = None) -> DataFrame:
    rows = [(c, s) for s, members in (codes or SECTOR_CODES).items() for c in members]
    return spark.createDataFrame(rows, "SFLT_DESC_ID int, SECTOR int")
