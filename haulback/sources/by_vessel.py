"""Tables laid out by vessel and landing date, so that what matches on both needs no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

VESSEL_DAY = ("VR_NUMBER_FISHING", "LANDED_DATE")
# Beside the table's files; readers of Parquet pass over names that begin like this.
LAYOUT = "_layout"


def write_by_vessel(df: DataFrame, path: str, buckets: int, columns: tuple[str, ...] = VESSEL_DAY) -> None:
    """Write Parquet in ``buckets`` buckets by the columns, and beside it a note of the layout.

    By vessel and day, so that a vessel with very many landings spreads over buckets.  Rows go to the
    bucket's own task first, so that a bucket is one file.
    """
    spark = df.sparkSession
    name = f"haulback_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *columns)
    dealt.write.bucketBy(buckets, *columns).option("path", path).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table's place was given
    note = spark.createDataFrame([(buckets, list(columns))], "buckets int, columns array<string>")
    note.coalesce(1).write.json(f"{path}/{LAYOUT}")


def read_by_vessel(spark: SparkSession, path: str) -> DataFrame:
    """The table with its layout, in any session: joins and groupings on its columns shuffle nothing."""
    note = spark.read.json(f"{path}/{LAYOUT}", schema="buckets int, columns array<string>").first()
    schema = spark.read.parquet(path).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in note.columns)
    name = f"haulback_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({keys}) INTO {note.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
