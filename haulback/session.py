"""Session settings the estimate relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Split a hot vessel-day, trip or cell at run time, even when that costs the next join on the
    # same keys its shared shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on several keys may meet where a join on some of them has left the rows.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
# Bytes of a file and of a shuffle that a task takes, at most: what it holds to sort or fold its rows
# follows from them, not from the size of the tables. A session that asks for less keeps its own.
AT_MOST = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 4 << 20,
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in AT_MOST.items():
        if in_bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, f"{most}b")
    return spark
