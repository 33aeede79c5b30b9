"""Joins in which a missing key matches a missing key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Split(NamedTuple):
    """Rows that stay and rows that leave, both lazy."""

    kept: DataFrame
    removed: DataFrame


KEY = "_key_{}"
SALT = "_salt"


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    hot_values: Sequence[str] = (),
    salts: int = 0,
) -> DataFrame:
    """Equi-join with null = null; the right side's key columns are dropped.

    Missing or blank trip numbers are the rule for unobserved trips, so one key can hold most of
    the left side.  With ``salts`` > 0 the left rows whose key is null or in ``hot_values`` are
    spread over that many sub-keys and only the matching right rows are repeated for each of them.
    """
    if salts > 0:
        left = deal_out(left, on, salts, hot_values)
        return join_dealt(left, right, on, how, dealt=on, salts=salts, hot_values=hot_values).drop(SALT)
    right, keys, cond = _met_by(right, on)
    return left.join(right, reduce(Column.__and__, cond), how).drop(*keys)


def _met_by(right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, list[str], list[Column]]:
    """The right side with its keys renamed, their names, and the conditions of the join."""
    keys = [KEY.format(i) for i in range(len(on))]
    right = right.withColumnsRenamed(dict(zip(on, keys)))
    return right, keys, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(on, keys)]


def deal_out(left: DataFrame, dealt: Sequence[str], salts: int, hot_values: Sequence[str] = ()) -> DataFrame:
    """The left side of ``join_dealt``: rows whose ``dealt`` keys are null or hot get one of the salts."""
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts))
    return left.withColumn(SALT, F.when(_is_hot(dealt, hot_values), spread).otherwise(F.lit(0)).cast("int"))


def join_dealt(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    dealt: Sequence[str],
    salts: int,
    hot_values: Sequence[str] = (),
) -> DataFrame:
    """``null_safe_join`` of a left side that ``deal_out`` has salted by ``dealt``, some of the keys.

    The salt stays on the left side, so that further joins whose keys hold ``dealt`` find the rows
    where this one has left them.
    """
    right, keys, cond = _met_by(right, on)
    hot = _is_hot([keys[on.index(c)] for c in dealt], hot_values)
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_" + SALT, F.explode(copies))
    cond.append(F.col(SALT) == F.col("_" + SALT))
    return left.join(right, reduce(Column.__and__, cond), how).drop(*keys, "_" + SALT)


def _is_hot(cols: Sequence[str], hot_values: Sequence[str]) -> Column:
    tests = [F.col(c).isNull() for c in cols]
    if hot_values:
        tests += [F.col(c).isin(*hot_values) for c in cols]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


TRIP_SALTS = 64


def join_on_trip(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Null-safe join on the observer trip number, with missing and blank numbers spread."""
    return null_safe_join(left, right, ["TRIP"], how, hot_values=("",), salts=TRIP_SALTS)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as many times as its integer column says; the column is dropped."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(times).cast("long")))).drop(
        "_copy", times
    )
