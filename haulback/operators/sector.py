"""Fleet sector of a landing from its sub-fleet code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.functions.codes import sector_table


def assign_sector(df: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Add SECTOR; null for a code in no sector.  The default code table has 26 fixed rows."""
    if sectors is None:
        sectors = F.broadcast(sector_table(df.sparkSession))
    return df.join(sectors, "SFLT_DESC_ID", "left").select(*df.columns, "SECTOR")
