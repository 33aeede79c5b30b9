"""Quality rules: divergence of a text's character classes and common words from its language's.

Built-in functions only: a text's counts come from its own row, and what is compared across rows is
one histogram for each language.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.operators.lineage import cut_lineage

# Frequent function words of English, French, German and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "for", "it", "with", "as", "was", "be", "on",
    "by", "this", "are", "or", "from", "an", "le", "la", "les", "de", "des", "du", "et", "un",
    "une", "que", "qui", "dans", "pour", "par", "sur", "est", "au", "der", "die", "das", "und",
    "den", "von", "zu", "mit", "sich", "auf", "ein", "eine", "nicht", "im", "dem", "el", "en",
    "los", "las", "y", "del", "se", "por", "con", "una", "para", "no",
)
SPACES = r"\x20\x09-\x0D"
#: Character classes; a last one, of all other characters, follows from the length.
CLASSES = {"upper": r"\p{Lu}", "lower": r"\p{Ll}", "digit": r"\p{Nd}", "stop": r".,;:'\"()\-", "space": SPACES}


class Limits(NamedTuple):
    """Bounds of the rules. Distances are Jensen-Shannon distances, from 0 (alike) to 1."""

    min_words: int = 50
    max_repeat_pct: int = 50
    #: Texts with more symbols than this share of their characters are left out of references.
    max_reference_symbols_pct: int = 1
    #: A language gives a reference from this many characters on.
    min_reference_chars: int = 10_000
    #: Common words are compared from this many words on.
    min_compared_words: int = 80
    #: A sample of n words lies about 1 / sqrt(n) off its source, so short texts get more room: that
    #: many times 1 / sqrt(n). Texts of several languages lie off each of them by their common words.
    max_class_distance: float = 0.17
    class_distance_room: float = 0.4
    max_word_distance: float = 0.30
    word_distance_room: float = 1.2


def _kept_chars(text: Column, members: str) -> Column:
    """How many characters of the text are in the class."""
    return F.length(F.regexp_replace(text, f"[^{members}]+", F.lit(""))).cast("long")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"[{SPACES}]+")).otherwise(
        F.array().cast("array<string>")
    )


def word_features(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (key, lang, chars, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes, common).

    ``classes`` and ``common`` count the characters of each class and the common words (then the
    other words). One row for each input row; a null text has no words, lines or characters.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), body.alias("body"))
    has_word = lambda line: F.length(F.btrim(line, F.lit(" \t\x0b\x0c\r"))) > 0
    counted = docs.select(
        "key",
        "lang",
        _words(F.col("body")).alias("words"),
        F.filter(F.split("body", "\n"), has_word).alias("lines"),
        F.length("body").cast("long").alias("chars"),
        _kept_chars(F.col("body"), r"#*$%&|<>").alias("n_symbols"),
        F.array(*(_kept_chars(F.col("body"), c) for c in CLASSES.values())).alias("classes"),
    )
    # The grams of a text, sorted with their places: equal ones stand side by side.
    third = F.size("words") - 2
    gram = lambda i: F.struct(
        F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("g"),
        i.alias("i"),
    )
    places = F.when(third > 0, F.sequence(F.lit(0), third - 1)).otherwise(F.array().cast("array<int>"))
    listed = set(COMMON_WORDS)
    counted = counted.select(
        "key", "lang", "chars", "n_symbols", "classes",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.filter(F.transform("words", F.lower), lambda w: w.isin(*listed)).alias("common"),
        F.sort_array(F.transform(places, gram)).alias("grams"),
    )
    same = lambda x, i: (
        F.coalesce(F.get("grams", i - 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get("grams", i + 1)["g"] == x["g"], F.lit(False))
    )
    counted = counted.withColumns(
        {
            "twice": F.sort_array(F.transform(F.filter("grams", same), lambda x: x["i"])),
            "common": F.concat(F.lit(" "), F.array_join("common", "  "), F.lit(" ")),
        }
    )
    step = lambda p, i: F.least(F.lit(3), F.coalesce(F.get("twice", i + 1) - p, F.lit(3)))
    covered = F.aggregate(F.transform("twice", step), F.lit(0), lambda a, b: a + b).cast("long")
    common = [
        (
            (F.length("common") - F.length(F.replace("common", F.lit(f" {w} "), F.lit(""))))
            / (len(w) + 2)
        ).cast("long")
        for w in COMMON_WORDS
    ]
    rest = F.col("chars") - F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)
    counted = counted.select(
        "key", "lang", "chars", "n_words", "n_symbols", "n_dup_lines",
        (F.col("chars") - F.element_at("classes", -1)).alias("word_chars"),
        covered.alias("n_repeat_words"),
        F.concat("classes", F.array(rest)).alias("classes"),
        F.array(*common).alias("common"),
    )
    others = F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, b: a + b)
    return counted.withColumn("common", F.concat("common", F.array(others)))


def base_fails(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_pct * F.col("n_words")
    )


def references(features: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each language: its histograms as shares, summed over all of its sound texts; and
    one of a null language, summed over all sound texts of the table.

    A sound text passes the base rules and holds few symbols, so that what is to be found does not
    blur what it is compared with. Languages of few characters give none.
    """
    sizes = {"classes": len(CLASSES) + 1, "common": len(COMMON_WORDS) + 1}
    names = [(name, i) for name, n in sizes.items() for i in range(n)]
    sums = [F.sum(F.get(F.col(name), F.lit(i))).alias(f"{name}{i}") for name, i in names]
    size = [F.sum("chars").alias("all_chars"), F.sum("n_words").alias("all_words")]
    sound = ~base_fails(limits)
    sound &= 100 * F.col("n_symbols") <= limits.max_reference_symbols_pct * F.col("chars")
    summed = cut_lineage(features.filter(sound).groupBy("lang").agg(*sums, *size))
    totals = [F.sum(c).alias(c) for c in summed.columns[1:]]
    pooled = summed.agg(*totals).select(F.lit(None).cast("string").alias("lang"), *summed.columns[1:])
    summed = summed.filter(F.col("lang").isNotNull()).unionByName(pooled)
    share = lambda name, of: F.array(
        *(F.col(f"{name}{i}") / F.col(of) for i in range(sizes[name]))
    )
    return summed.filter((F.col("all_chars") >= limits.min_reference_chars) & (F.col("all_words") > 0)).select(
        F.col("lang").alias("ref_lang"),
        share("classes", "all_chars").alias("ref_classes"),
        share("common", "all_words").alias("ref_common"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of shares; null if either is null."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    both = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(both, F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def judge_quality(
    docs: DataFrame,
    limits: Limits = Limits(),
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Rows (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept), one for each input row.

    A text fails with fewer than ``min_words`` words, with more than ``max_repeat_pct`` percent of
    its words in repeated three-word windows, or if its character classes or common words lie too
    far from those of all texts of its language. A null or empty text has no words and fails; a text
    whose language is null or has no reference is judged by the nearest of all languages' references
    (so a text of a language that has none must be near one that has), or where no language has one,
    by all sound texts together; without any reference texts are not compared. Short texts are not
    compared by their common words. Repeated rows and null keys are judged each by itself; an empty table gives
    no rows; other columns are not read.
    """
    features = cut_lineage(word_features(docs, key, text, lang))
    share = lambda name, of: F.when(F.col(of) > 0, F.transform(name, lambda v: v / F.col(of)))
    shares = features.withColumns(
        {"classes": share("classes", "chars"), "common": share("common", "n_words")}
    )
    found = cut_lineage(references(features, limits))
    histograms = F.struct("ref_classes", "ref_common")
    labelled = F.col("ref_lang").isNotNull()
    every = found.agg(
        F.collect_list(F.when(labelled, histograms)).alias("by_language"),
        F.collect_list(F.when(~labelled, histograms)).alias("pooled"),
    ).select(F.when(F.size("by_language") > 0, F.col("by_language")).otherwise(F.col("pooled")).alias("every"))
    # All references go along with those texts only that have none of their own.
    compared = shares.join(F.broadcast(found), F.col("lang") == F.col("ref_lang"), "left")
    compared = compared.join(F.broadcast(every), F.col("ref_lang").isNull(), "left")
    against = F.coalesce(F.col("every"), F.array(histograms))
    room = lambda most, per: most + per / F.sqrt(F.greatest("n_words", F.lit(1)))
    enough = F.col("n_words") >= limits.min_compared_words

    def measured(ref: Column) -> Column:
        """How far the text is beyond its limits, null if it has no characters; and both distances."""
        classes = js_distance(F.col("classes"), ref["ref_classes"])
        common = F.when(enough, js_distance(F.col("common"), ref["ref_common"]))
        beyond = F.greatest(
            classes - room(limits.max_class_distance, limits.class_distance_room),
            common - room(limits.max_word_distance, limits.word_distance_room),
        )
        return F.struct(beyond.alias("beyond"), classes.alias("class_distance"), common.alias("word_distance"))

    judged = compared.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_fails(limits).alias("base_failed"),
        F.array_min(F.transform(against, measured)).alias("nearest"),
    )
    far = F.coalesce(F.col("nearest.beyond") > 0, F.lit(False))
    return judged.select(
        *judged.columns[:-1], "nearest.class_distance", "nearest.word_distance", (~F.col("base_failed") & ~far).alias("kept")
    )
