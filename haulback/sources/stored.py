"""Tables at rest: Parquet with a stated schema, database tables with their own reader options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from haulback.sources.positions import parse_day_month_year


def stored_table(
    spark: SparkSession, path: str, schema: str, *, date_format: str | None = None
) -> DataFrame:
    """The columns of ``schema`` of a Parquet table; another type, or an absent column, is an error.

    With ``date_format`` a date may be stored as text, which is read in that form, its time of day
    left out; text that is no such date is null.
    """
    table = spark.read.parquet(path)
    stated = _parse_datatype_string(schema)
    assert isinstance(stated, StructType)
    found = {f.name: f.dataType.simpleString() for f in table.schema}
    columns, wrong = [], []
    for f in stated:
        wanted, have = f.dataType.simpleString(), found.get(f.name)
        if have == wanted:
            columns.append(F.col(f.name))
        elif date_format and wanted == "date" and have == "string":
            columns.append(parse_day_month_year(F.col(f.name), date_format).alias(f.name))
        else:
            wrong.append(f"{f.name} {have or 'is absent'}, not {wanted}" if have else f"no {f.name}")
    if wrong:
        raise TypeError(f"{path}: {'; '.join(wrong)}")
    return table.select(*columns)


def database_table(spark: SparkSession, table: str | dict[str, object], options: dict[str, object]) -> DataFrame:
    """A table of a database: its name, or reader options of its own beside those of all tables.

    Own options are, for one, ``dbtable``, ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, with which the table is read over several connections.
    """
    own = {"dbtable": table} if isinstance(table, str) else table
    return spark.read.format("jdbc").options(**(options | own)).load()
