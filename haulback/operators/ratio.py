"""Landings multiplier: cod to haddock on observed trips over the same on unobserved trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.functions.missing import ieee_divide, na_sum

REQUIRED = ("COD", "HAD", "OBS")
PARTS = ("COD_Y", "HAD_Y", "COD_N", "HAD_N")


def ratio_sums() -> list[Column]:
    """The four conditional sums; null for a missing weight in a used row or any missing flag."""
    known_flags = F.count(F.when(F.col("OBS").isNull(), F.lit(1))) == 0
    out = []
    for flag in ("Y", "N"):
        for weight in ("COD", "HAD"):
            total = na_sum(weight, F.col("OBS") == flag)
            out.append(F.when(known_flags, total).alias(f"{weight}_{flag}"))
    return out


def multiplier() -> Column:
    """Ratio of ratios of the four sums; Inf and NaN are results like any other."""
    observed = ieee_divide(F.col("COD_Y"), F.col("HAD_Y"))
    unobserved = ieee_divide(F.col("COD_N"), F.col("HAD_N"))
    return ieee_divide(observed, unobserved)


def landings_multiplier(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MULTIPLIER over the whole table, or per value of ``by``."""
    lacking = [c for c in REQUIRED if c not in trips.columns]
    if lacking:
        raise ValueError(f"trips lack the columns {lacking}")
    return trips.groupBy(*by).agg(*ratio_sums()).select(*by, multiplier().alias("MULTIPLIER"))
