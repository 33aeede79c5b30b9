"""Filter, deduplicate, decontaminate and encode the documents, one operator after another.

Every stage works on all that its predecessor kept. Rows are told apart by ``doc_id``: rows that
repeat one stay or go together, but for those that lose all their words as repeated passages, and a
row without one has nothing to be matched by, so only the quality rules can remove it. Columns beyond ``doc_id``, ``text``, ``lang`` and ``n_chars`` pass
through the filters as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback.llm import jaccard, pieces, quality, substrings, tiling
from haulback.operators.lineage import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; of rows that share an id, all if one is kept."""
    kept = quality.judge_quality(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies.

    Of rows that share an id, all stay if one of them has no copy under a smaller id.
    """
    found = jaccard.near_duplicates(docs).filter("component_id <=> doc_id")
    kept = found.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; those that had nothing else go.

    A document that loses words gets its other words, joined by spaces, and their ``n_chars``.
    """
    found = substrings.remove_passages(docs, carry=docs.columns)
    # The operator's own columns come first, then those of the documents.
    n, own = len(docs.columns), ["_key", "_n_words", "_n_removed", "_kept"]
    found = found.toDF(*own, *(f"c{i}" for i in range(n)))
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    less = F.col("_n_removed") > 0
    left = found.filter(~less | (F.col("_n_removed") < F.col("_n_words")))
    at["text"] = F.when(less, F.col("_kept")).otherwise(at["text"])
    at["n_chars"] = F.when(less, F.length("_kept").cast("long")).otherwise(at["n_chars"])
    return left.select(*(at[c].alias(c) for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = tiling.find_contaminated(docs, items).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(found, docs["doc_id"] == found["leak_id"], "left_anti")


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids) of the documents left."""
    return pieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_ids),
]

#: Exact tilings, sets of links and merges are beyond SQL; tests/llm holds them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
