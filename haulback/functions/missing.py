"""Missing-value rules of the estimate, as column expressions.

Spark's aggregates skip nulls and its ANSI division raises on zero; the estimate needs sums that
become unknown when any input is unknown and quotients that follow IEEE rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_divide(a: Column, b: Column) -> Column:
    """a / b with x/0 = +-Inf and 0/0 = NaN; null when either side is null or unknown."""
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, F.try_divide(a.cast("double"), b.cast("double")))
        .when(F.isnan(a.cast("double")), F.lit(NAN))
        .when(a > 0, F.lit(INF))
        .when(a < 0, F.lit(-INF))
        .otherwise(F.lit(NAN))
    )


def na_sum(c: str | Column, where: Column | None = None) -> Column:
    """Sum that is null when any selected value is null, and 0 when nothing is selected."""
    c = as_col(c).cast("double")
    picked = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    unknown = F.count(F.when(picked & c.isNull(), F.lit(1)))
    total = F.coalesce(F.sum(F.when(picked, c)), F.lit(0.0))
    return F.when(unknown == 0, total)


def known_sum(c: str | Column) -> Column:
    """Sum over the known values; 0 when there are none."""
    return F.coalesce(F.sum(as_col(c).cast("double")), F.lit(0.0))


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def at_least(c: Column, bound: float) -> Column:
    """c >= bound with NaN treated as unknown (Spark sorts NaN above every number)."""
    return (c >= bound) & ~F.isnan(c)


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (c != INF) & (c != -INF)


def nulls_last(*cols: str) -> list[Column]:
    """Struct fields that make min(struct(...)) rank nulls after every value."""
    out: list[Column] = []
    for c in cols:
        out += [F.col(c).isNull().alias(f"_{c}_missing"), F.col(c).alias(c)]
    return out
