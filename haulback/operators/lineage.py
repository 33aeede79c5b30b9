"""Cut a long lineage with a table in the folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def work_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The folder given, else the session's ``spark.checkpoint.dir``: storage all executors share."""
    folder = folder or spark.conf.get(SETTING, None)
    if not folder:
        raise ValueError(f"no folder for intermediate tables: pass folder=, or set {SETTING}")
    return folder


def _own(spark: SparkSession, folder: str | None) -> str:
    """The folder of this application's tables: others may share the storage."""
    return f"{work_folder(spark, folder)}/haulback/{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the rows as Parquet and go on from there; readers prune columns and push filters."""
    path = f"{_own(df.sparkSession, folder)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession, folder: str | None = None) -> bool:
    """Delete the tables that ``cut_lineage`` has left in the folder for this application; true if
    there were any. Those of other applications stay.

    Frames that still read them fail from then on, so only their owner can tell when to do this.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark, folder))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
