"""URL filter: host rules first, then a weighted vocabulary found by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.llm.shipping import ship_package

ALLOW, BLOCK = "allow", "block"

# The terms that condemn a url alone, and those that do so together.
STRICT_TERMS = (
    "casino", "porn", "porno", "xxx", "sex", "escort", "escorts", "viagra", "cialis", "gambling",
    "poker", "slots", "jackpot", "roulette", "malware", "phishing", "warez", "torrent", "hentai",
    "milf", "camgirls", "payday",
)
SOFT_TERMS = (
    "free", "bet", "bets", "betting", "cheap", "pill", "pills", "pharma", "win", "winner", "ad",
    "ads", "track", "tracker", "tracking", "click", "clicks", "banner", "popup", "promo", "deal",
    "deals", "discount", "loan", "loans", "credit", "adult", "dating", "nude", "bonus", "lottery",
    "replica", "spam", "crypto", "bitcoin", "crack", "keygen", "hack", "proxy",
)


class Rule(NamedTuple):
    """A verdict for the urls of a host and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"


class UrlParts(NamedTuple):
    host: Column
    path: Column


def url_parts(url: Column) -> UrlParts:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda group: F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))
    return UrlParts(_ascii_lower(part(1)), part(2))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; of two as long the first; else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        value = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits & path.startswith(rule.path), value).otherwise(out)
    return out


def term_counts(
    df: DataFrame,
    url: str = "url",
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
) -> DataFrame:
    """Add ``n_strict`` and ``n_soft``: distinct terms that stand alone in the url.

    One pass of an automaton over the lower-cased url finds all terms; a hit counts if neither the
    character before nor the one after it is a letter or digit. A null url has no terms.
    """
    ship_package(df.sparkSession)
    kinds = {t.lower(): "soft" for t in soft} | {t.lower(): "strict" for t in strict}
    fields = [*df.drop("n_strict", "n_soft").schema.fields]
    schema = df.select(*(f.name for f in fields)).schema
    schema = schema.add("n_strict", "integer").add("n_soft", "integer")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, kind in kinds.items():
            automaton.add_word(term, (term, kind))
        automaton.make_automaton()

        def found(text: str | None) -> tuple[int, int]:
            text = (text or "").lower()
            hits = set()
            for last, (term, kind) in automaton.iter(text) if kinds else ():
                before, after = last - len(term), last + 1
                alone = before < 0 or not text[before].isalnum()
                if alone and (after == len(text) or not text[after].isalnum()):
                    hits.add((term, kind))
            strict_hits = sum(kind == "strict" for _, kind in hits)
            return strict_hits, len(hits) - strict_hits

        for batch in batches:
            at = batch.schema.get_field_index(url)
            pairs = [found(x) for x in batch.column(at).to_pylist()]
            columns = [*batch.columns, *(pa.array([p[i] for p in pairs], pa.int32()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "n_strict", "n_soft"])

    return df.select(*(f.name for f in fields)).mapInArrow(count, schema)


def judge_urls(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    key: str = "page_id",
    url: str = "url",
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    max_soft: int = 1,
) -> DataFrame:
    """Rows (key, host, path, rule, verdict, n_strict, n_soft), one for each input row.

    The longest fitting rule decides. Without one, a url is blocked by one strict term or by more
    than ``max_soft`` distinct soft ones. A null url, and one without ``://``, has an empty host and
    path, fits no rule and is judged by its terms (null: allowed). Repeated rows are judged each by
    itself, a null key is kept, an empty table gives no rows, and other columns are not read.
    """
    counted = term_counts(df.select(key, url), url, strict, soft)
    parts = url_parts(F.col(url))
    named = counted.select(
        key, parts.host.alias("host"), parts.path.alias("path"), "n_strict", "n_soft"
    )
    blocked = (F.col("n_strict") > 0) | (F.col("n_soft") > max_soft)
    ruled = named.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("fit.verdict", F.when(blocked, BLOCK).otherwise(ALLOW))
    return ruled.select(
        key, "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
        "n_strict", "n_soft",
    )
