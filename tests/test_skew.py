"""A key holding a third of the rows is split, not sent to one task, and no row is lost."""

import pytest
from pyspark.sql import functions as F

from haulback import schemas, tune
from haulback.operators import reconcile as rec
from haulback.operators import splits
from haulback.operators.bootstrap import grouped_trips, number_rows, row_blocks
from tests.frames import observers, trips, zoned
from tests.test_plans import plan

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield tune(spark)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def many_landings(spark, n, vessel):
    """n landings spread over 12 tasks; a third of them of one vessel and day."""
    row = zoned(spark, {"TRIP": "T"}).drop("VR_NUMBER_FISHING", "TRIP_ID", "TRIP")
    ids = spark.range(0, n, 1, 12)
    hot = F.col("id") % 3 == 0
    return (
        ids.crossJoin(F.broadcast(row))
        .withColumn("VR_NUMBER_FISHING", F.when(hot, F.lit(vessel)).otherwise(F.col("id") + 10))
        .withColumn("TRIP_ID", F.col("id"))
        .withColumn("LOG_EFRT_STD_INFO_ID", F.col("id"))
        .withColumn("TRIP", F.when(~hot, F.concat(F.lit("T"), F.col("id").cast("string"))))
        .select(*schemas.ZONED)
    )


def test_hot_vessel_day_is_split(skewed):
    n = 30000
    land = many_landings(skewed, n, 1).select(*schemas.LANDING)
    obs = observers(skewed, {"TRIP": "T1"}, {"TRIP": "T9", "VR_NUMBER_FISHING": 2})
    labelled = rec.reconcile(land, obs)
    rows = labelled.groupBy("OUTCOME").agg(
        F.count("TRIP_ID").alias("n"), F.sum("TRIP_ID"), F.sum("LOG_EFRT_STD_INFO_ID")
    )
    got = {r["OUTCOME"]: r["n"] for r in rows.collect()}
    assert got == {rec.UNRESOLVED: n // 3, rec.NOT_IN_OBSERVER_DATA: n - n // 3}
    assert plan(rows).count("SortMergeJoin(skew=true)") >= 2


def test_missing_trip_number_spreads_over_partitions(skewed):
    n = 30000
    obs = observers(skewed, {"TRIP": "T1", "SETCD_ID": 7}, {"SETCD_ID": 7})
    got = splits.non_commercial(many_landings(skewed, n, 1), obs)
    assert got.kept.count() == n - n // 3 - 1
    assert got.removed.count() == n // 3 + 1
    skewed.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = splits.join_on_trip(
            many_landings(skewed, n, 1), obs.select("TRIP", F.lit(True).alias("m")).distinct()
        )
        parts = marked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        skewed.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 16 and max(r["count"] for r in parts) < n / 6


def test_one_group_with_all_trips_is_cut_into_blocks(skewed):
    row = trips(skewed, {}).drop("TRIP_ID")
    ids = skewed.range(0, 5000, 1, 8).withColumnRenamed("id", "TRIP_ID")
    data = ids.crossJoin(F.broadcast(row))
    groups = skewed.createDataFrame([(90, 1, 2, "A")], schemas.GROUPS)
    numbered = number_rows(grouped_trips(data, groups))
    assert numbered.agg(F.min("IDX"), F.max("IDX"), F.countDistinct("IDX")).first() == (0, 4999, 5000)
    sizes = [r[0] for r in row_blocks(numbered, 300).select(F.size("FLAGS")).collect()]
    assert sorted(sizes) == [200] + [300] * 16


def test_long_trip_is_folded_before_its_shuffle(skewed):
    """First and last set of a trip come from partial aggregates."""
    land = many_landings(skewed, 3000, 1).withColumns(
        {"TRIP_ID": F.lit(5).cast("long"), "100": F.col("TRIP_ID") / 3000, "110": F.lit(1.0)}
    )
    got = splits.cod_directed_trips(land)
    assert [(r.TRIP_ID, r.ALL_DIRECTED, r.TURNED_TO_COD) for r in got.collect()] == [
        (5, False, True)
    ]
    assert "partial_min" in plan(got) and "Window" not in plan(got)



def test_null_and_giant_trips_are_split_when_labelled(skewed):
    """A third of the landings without a trip id, a third of one trip: both are dealt out again."""
    n = 30000
    kind = F.col("TRIP_ID") % 3
    trip = F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit(7)).otherwise(F.col("TRIP_ID") + 10).cast("long")
    land = many_landings(skewed, n, 1).withColumns(
        {"TRIP_ID": trip, "100": F.lit(9.0), "110": F.lit(1.0), "VR_NUMBER_FISHING": F.col("TRIP_ID")}
    )
    none = skewed.createDataFrame([], "TRIP string, X int")
    evidence = splits.trip_evidence(
        observers(skewed, {"TRIP": "T1"}), none.withColumnRenamed("X", "GEARFCD_ID"), none.withColumnRenamed("X", "SPECSCD_ID")
    )
    labelled = splits.label_landings(land, evidence)
    rows = labelled.groupBy("ALL_COD", "TWIN").agg(F.count("*").alias("n"), F.sum("LOG_EFRT_STD_INFO_ID"))
    assert [(r.ALL_COD, r.TWIN, r.n) for r in rows.collect()] == [(True, True, n)]
    text = plan(rows)
    assert "Window" not in text and "SortMergeJoin(skew=true)" in text and "_salt" in text
