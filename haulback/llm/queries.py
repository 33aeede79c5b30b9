"""The operators as queries over the supplied tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback.llm import (
    extract,
    filter_audit,
    infilling,
    jaccard,
    langid,
    oracle,
    packing,
    pieces,
    quality,
    scoring,
    substrings,
    suffixes,
    tiling,
    url_filter,
)
from haulback.llm.url_filter import ALLOW, BLOCK, Rule

URL_RULES = (
    Rule(ALLOW, "org"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """The fold of a key: crc32 of its decimal text, modulo ``n``."""
    return F.crc32(F.col(key).cast("string")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit_language_model(docs.filter(fold("doc_id", 4) != 2))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    found = langid.predict_language(docs, model)
    return found.select("doc_id", held_out, "lang_pred", "score")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return extract.extract_text(pages, extract.learn_weights(pages))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = scoring.score(docs, scoring.train(docs.filter(fold("doc_id", 10) != 0)))
    held_out = F.coalesce(fold("doc_id", 10) == 0, F.lit(False)).alias("held_out")
    return scored.select("*", held_out)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to."""
    decoded = pieces.decode(pieces.encode(_table(spark, sf_dir, "documents")))
    n_tokens = F.size("ids").cast("long").alias("n_tokens")
    return decoded.select("doc_id", n_tokens, "ids", F.sha2("text", 256).alias("text_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge_quality(_table(spark, sf_dir, "documents"))
    return found.drop("class_distance", "word_distance")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return tiling.find_contaminated(docs, items)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_strings(_table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.encode_pieces(_table(spark, sf_dir, "documents"))
    digest = F.crc32("ids").alias("ids_crc32")
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", digest))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infilling.restore_texts(infilling.fill_in_middle(_table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_html_extraction": op3_html_extraction,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_url_filters": op5_url_filters,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_filter_interaction_audit": op12_filter_interaction_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}


SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": oracle.components_sql(),
    "op5_url_filters": oracle.url_sql(URL_RULES),
    "op7_quality_rules": oracle.quality_sql(),
    "op8_substring_dedup": oracle.passages_sql(),
    "op10_suffix_array_dedup": oracle.strings_sql(),
    "op12_filter_interaction_audit": oracle.audit_sql(),
    "op13_fill_in_middle": oracle.infilling_sql(),
}
