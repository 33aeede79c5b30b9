import math

import pytest
from pyspark.sql import functions as F

from haulback.functions.codes import (
    SECTOR_CODES,
    decode_coordinate,
    length_class,
    tonnage_class,
)
from haulback.functions.missing import at_least, ieee_divide, na_sum
from haulback.operators.ratio import landings_multiplier
from haulback.operators.sector import assign_sector
from tests.frames import landings, values


def test_division_follows_ieee(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None)]
    rows += [(math.nan, 0.0), (math.inf, 0.0), (math.nan, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double").coalesce(1)
    got = [r[0] for r in df.select(ieee_divide(F.col("a"), F.col("b"))).collect()]
    assert got[:3] == [0.5, math.inf, -math.inf]
    assert math.isnan(got[3]) and got[4] is None and got[5] is None
    assert math.isnan(got[6]) and got[7] == math.inf and math.isnan(got[8])


def test_sum_is_unknown_when_a_value_is(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 2.0)], "k int, x double")
    got = dict(values(df.groupBy("k").agg(na_sum("x").alias("s")), "k", "s"))
    assert got == {1: None, 2: 2.0}
    assert df.filter("k = 9").agg(na_sum("x")).first()[0] == 0.0


def test_nan_is_not_at_least_zero(spark):
    df = spark.createDataFrame([(math.nan,), (0.0,), (math.inf,), (-1.0,), (None,)], "x double")
    assert values(df.filter(at_least(F.col("x"), 0)), "x") == [(0.0,), (math.inf,)]


def test_class_bounds(spark):
    bounds = [None, 0.0, 0.9, 1.0, 24.9, 25.0, 49.9, 50.0, 150.0, 500.0, 1000.0, 1999.0, 2000.0]
    df = spark.createDataFrame([(b,) for b in bounds], "x double").coalesce(1)
    got = [r[0] for r in df.select(tonnage_class(F.col("x"))).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 4, 5, 6, 6, 7]
    feet = [None, 0.5, 1.0, 35.0, 45.0, 64.9, 65.0, 100.0, 125.0]
    df = spark.createDataFrame([(b,) for b in feet], "x double").coalesce(1)
    got = [r[0] for r in df.select(length_class(F.col("x"))).collect()]
    assert got == [0, 0, 1, 2, 3, 3, 4, 5, 6]


def test_packed_coordinates(spark):
    df = spark.createDataFrame([(413050,), (660001,), (0,), (-5,), (None,)], "v int").coalesce(1)
    got = [r[0] for r in df.select(decode_coordinate(F.col("v"), -1)).collect()]
    assert got == [-41.50833, -66.00017, None, None, None]


def test_every_sector_code(spark):
    codes = [c for members in SECTOR_CODES.values() for c in members] + [7001, None]
    df = landings(spark, *[{"SFLT_DESC_ID": c} for c in codes])
    got = dict(values(assign_sector(df), "SFLT_DESC_ID", "SECTOR"))
    expected = {c: s for s, members in SECTOR_CODES.items() for c in members}
    assert got == {**expected, 7001: None, None: None}


def ratio_rows(spark, rows):
    return spark.createDataFrame(rows, "COD double, HAD double, OBS string")


def test_multiplier_of_equal_trips_is_one(spark):
    df = ratio_rows(spark, [(1.0, 1.0, o) for o in "NNYY"])
    assert landings_multiplier(df).collect() == [(1.0,)]


def test_multiplier_without_unobserved_trips_is_undefined(spark):
    got = landings_multiplier(ratio_rows(spark, [(1.0, 1.0, "Y")])).first()[0]
    assert math.isnan(got)


def test_multiplier_is_unknown_with_a_missing_weight_or_flag(spark):
    base = [(1.0, 1.0, o) for o in "NNYY"]
    assert landings_multiplier(ratio_rows(spark, [*base, (None, 1.0, "Y")])).first()[0] is None
    assert landings_multiplier(ratio_rows(spark, [*base, (1.0, 1.0, None)])).first()[0] is None
    assert landings_multiplier(ratio_rows(spark, [*base, (None, 1.0, "Z")])).first()[0] == 1.0


def test_multiplier_does_not_change_with_scale(spark):
    df = ratio_rows(spark, [(2.0, 3.0, "Y"), (5.0, 7.0, "N"), (1.0, 4.0, "N")])
    scaled = df.withColumn("COD", F.col("COD") * 8)
    assert landings_multiplier(df).first()[0] == pytest.approx(landings_multiplier(scaled).first()[0])


def test_multiplier_names_missing_columns(spark):
    with pytest.raises(ValueError, match="OBS"):
        landings_multiplier(spark.createDataFrame([(1.0, 1.0)], "COD double, HAD double"))
