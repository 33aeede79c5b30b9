"""Numbers for texts whose keys do not tell them apart."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.operators.lineage import cut_lineage


class Numbered(NamedTuple):
    rows: DataFrame
    #: Is ``doc`` a number in place of the key?
    anew: bool


def number_texts(docs: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> Numbered:
    """The rows (doc, text, ...) with ``_key``, their key, and a ``doc`` that names one text.

    As long as every key names one text, ``doc`` is the key itself. Where a key has several, all
    texts are numbered in the order of key and then of the text's 64-bit hash, so a smaller key is a
    smaller number, repeated rows share theirs, and the texts of a key have a fixed order. A null key
    stays null; null and empty text are one. No key's rows are gathered: keys are compared by two
    extremes, numbers come from a range sort of keys and hashes.
    """
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.filter("doc IS NOT NULL").select("doc", hashed.alias("_hash"))
    ends = named.groupBy("doc").agg(F.min("_hash").alias("low"), F.max("_hash").alias("high"))
    rows = docs.withColumn("_key", F.col("doc"))
    if ends.filter("low != high").isEmpty():
        return Numbered(rows, False)
    ordered = named.distinct().repartitionByRange("doc", "_hash").sortWithinPartitions("doc", "_hash")
    numbers = keep(ordered.select(F.col("doc").alias("_of"), "_hash", F.monotonically_increasing_id().alias("_number")))
    same = (F.col("_key") == F.col("_of")) & (hashed == F.col("_hash"))
    numbered = rows.join(numbers, same, "left").withColumn("doc", F.col("_number"))
    return Numbered(keep(numbered.select(*rows.columns)), True)
