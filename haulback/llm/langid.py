"""Language identification: sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.llm.arrays import text_blocks
from haulback.llm.shipping import ship_package

UNDETERMINED = "und"


class Settings(NamedTuple):
    """Of the features, the sample and the fit."""

    features: int = 1 << 13
    orders: tuple[int, ...] = (1, 2, 3)
    #: Texts of a language that are fitted on: about so many, picked by a hash of their key.
    sample_per_lang: int = 1500
    #: Of those, one in so many is kept for the temperature.
    calibration_fold: int = 5
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05


class LanguageModel(NamedTuple):
    """Weights by feature and language; the scores of a text are divided by the temperature."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    settings: Settings


@cache
def _letters() -> np.ndarray:
    """Every code point in lower case if it is a letter, else a space."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def gram_counts(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the hashed character n-grams of each row, and whether a row has a letter."""
    rows, size = len(offsets) - 1, settings.features
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    letters, cuts = _letters()[np.minimum(points, 0x10FFFF)].astype(np.uint64), before[offsets]
    row = np.repeat(np.arange(rows), np.diff(cuts))
    counts = np.zeros(rows * size, np.int64)
    for order in settings.orders:
        n = len(letters) - order + 1
        if n <= 0:
            continue
        code, some = np.zeros(n, np.uint64), np.zeros(n, bool)
        for k in range(order):
            code = code * np.uint64(0x110000) + letters[k : k + n]
            some |= letters[k : k + n] != 32
        some &= row[:n] == row[order - 1 :]
        code = (code + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = ((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
        at = row[:n][some] * size + (bucket[some] % np.uint64(size)).astype(np.int64)
        counts += np.bincount(at, minlength=rows * size)
    has_letter = np.bincount(row, weights=letters != 32, minlength=rows) > 0
    return counts.reshape(rows, size), has_letter


def _tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts).astype(np.float32) * idf.astype(np.float32)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _document_counts(docs: DataFrame, text: str, lang: str, settings: Settings) -> DataFrame:
    """Rows (lang, bucket, n): texts by language (bucket -1) and texts by feature (lang null)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, langs = np.zeros(settings.features, np.int64), {}
        for rows, data, offsets in text_blocks(batches, text, most_rows=512):
            counts, has_letter = gram_counts(data, offsets, settings)
            seen += (counts > 0).sum(0)
            names = rows.column(rows.schema.get_field_index(lang)).to_pylist()
            for name, some in zip(names, has_letter, strict=True):
                if some:
                    langs[name] = langs.get(name, 0) + 1
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*langs, *[None] * len(found)], pa.string()),
                pa.array([*[-1] * len(langs), *found], pa.int64()),
                pa.array([*langs.values(), *seen[found]], pa.int64()),
            ],
            names=["lang", "bucket", "n"],
        )

    counted = docs.select(text, lang).mapInArrow(count, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


Row = tuple[np.ndarray, np.ndarray]


def _sparse(x: np.ndarray) -> list[Row]:
    """Of each row, the features that it has and their values."""
    found = []
    for row in x:
        at = np.flatnonzero(row)
        found.append((at.astype(np.int32), row[at]))
    return found


def _ftrl(x: list[Row], y: np.ndarray, n_langs: int, s: Settings) -> np.ndarray:
    """Weights fitted by follow-the-regularised-leader with elastic-net penalties."""
    z, n = np.zeros((s.features, n_langs)), np.zeros((s.features, n_langs))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(len(x)):
            at, value = x[i]
            value, w = value.astype(float), weights(z[at], n[at])
            p = _softmax((value @ w)[None])[0]
            p[y[i]] -= 1
            g = value[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(z, n)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _best_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its log."""
    if not len(y):
        return 1.0
    rows = np.arange(len(y))
    loss = lambda t: -np.log(_softmax(scores / np.exp(t))[rows, y] + 1e-12).mean()
    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language_model(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()
) -> LanguageModel:
    """Learn the languages of the labelled texts.

    How many texts hold a feature is counted over all of them. The weights are fitted in one task on
    a sample of about ``sample_per_lang`` texts of each language, held as the features that each
    has, and the temperature on a fold of it. Rows without a language, and texts without a letter, teach nothing; without any other row
    the model has no language. Repeated rows count as often as they stand there.
    """
    ship_package(docs.sparkSession)
    labelled = docs.filter(F.col(lang).isNotNull()).select(key, text, lang)
    counted = _document_counts(labelled, text, lang, settings).collect()  # features and languages
    by_lang = {r.lang: r.n for r in counted if r.bucket == -1}
    seen = np.zeros(settings.features)
    for r in counted:
        if r.bucket >= 0:
            seen[r.bucket] = r.n
    langs = sorted(by_lang)
    idf = np.log((1 + sum(by_lang.values())) / (1 + seen)) + 1
    if not langs:
        return LanguageModel([], idf, np.zeros((settings.features, 0)), 1.0, settings)
    picked = F.lit(False)
    for name in langs:
        share = min(1.0, settings.sample_per_lang / by_lang[name])
        picked = picked | ((F.col(lang) == name) & (_draw(F.xxhash64(F.lit(name), key)) < share))
    spare = F.pmod(F.xxhash64(F.lit("calibration"), key), F.lit(settings.calibration_fold)) == 0

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, held = [], [], []
        for rows, data, offsets in text_blocks(batches, "text", most_rows=512):
            counts, has_letter = gram_counts(data, offsets, settings)
            x += _sparse(_tf_idf(counts, idf)[has_letter])
            names = np.array(rows.column(1).to_pylist(), object)[has_letter]
            y.append(np.searchsorted(langs, names.astype(str)) if len(names) else np.zeros(0, int))
            held.append(np.array(rows.column(2).to_pylist(), bool)[has_letter])
        if not x:
            return
        y, held = np.concatenate(y).astype(int), np.concatenate(held)
        weights = _ftrl([r for r, h in zip(x, held, strict=True) if not h], y[~held], len(langs), settings)
        scores = [value.astype(float) @ weights[at] for (at, value), h in zip(x, held, strict=True) if h]
        temperature = _best_temperature(np.array(scores).reshape(-1, len(langs)), y[held])
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype(np.float64).tobytes()]), pa.array([temperature])],
            names=["weights", "temperature"],
        )

    sample = labelled.filter(picked).select(F.col(text).alias("text"), F.col(lang).alias("lang"), spare.alias("spare"))
    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("text", "lang"))
    found = one.mapInArrow(fit, "weights binary, temperature double").collect()
    weights = np.frombuffer(found[0].weights).reshape(-1, len(langs)) if found else np.zeros((settings.features, len(langs)))
    return LanguageModel(langs, idf, weights, found[0].temperature if found else 1.0, settings)


def _draw(hashed: Column) -> Column:
    """A hash as a number from 0 to 1."""
    return F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)


def predict_language(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, lang_pred, score): the likeliest language of each text and its probability.

    A null text and one without a letter, and any text under a model without languages, is ``und``
    with a score of 0. Of equally likely languages the first by name wins. Whole texts are read;
    repeated rows and null keys are predicted each by itself; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    schema = docs.select(key).schema.add("lang_pred", "string").add("score", "double")
    names = np.array([*model.langs, UNDETERMINED], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, text, most_rows=512):
            best, score = np.full(rows.num_rows, len(model.langs)), np.zeros(rows.num_rows)
            if model.langs:
                counts, has_letter = gram_counts(data, offsets, model.settings)
                p = _softmax(_tf_idf(counts, model.idf) @ model.weights / model.temperature)
                best = np.where(has_letter, p.argmax(1), best)
                score = np.where(has_letter, p.max(1), 0.0)
            lang = pa.array(names[best], pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), lang, pa.array(score)], names=schema.names)

    return docs.select(key, text).mapInArrow(predict, schema)
