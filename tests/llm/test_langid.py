import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from haulback.llm import langid
from haulback.llm.arrays import text_bytes
from haulback.llm.langid import Settings, fit_language_model, predict_language

SOUNDS = {"aa": "bakudo", "bb": "ñexilu", "cc": "жзщыю "}


def text(lang, seed, n=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SOUNDS[lang], k=5)) for _ in range(n))


def test_held_out_accuracy_and_odd_rows(spark):
    rows = [(i, text(lang, i), lang, "x") for i, lang in enumerate(list(SOUNDS) * 40)]
    odd = [(500, None, "aa", ""), (501, "", "bb", ""), (502, "12 34 !?", "cc", ""), (503, text("bb", 9), None, "")]
    long = [(504, text("cc", 10, 50_000), "cc", ""), (None, text("aa", 11), "aa", ""), rows[0]]
    docs = spark.createDataFrame(rows + odd + long, "doc_id long, text string, lang string, score string")
    settings = Settings(sample_per_lang=30)
    model = fit_language_model(docs.filter("doc_id % 4 != 2"), settings=settings)
    assert model.langs == sorted(SOUNDS)
    assert (model.weights == 0).any() and model.temperature > 0
    got = predict_language(docs, model).collect()
    assert len(got) == docs.count()
    found = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert all(found[i][0] == lang and found[i][1] > 0.5 for i, _, lang, _ in rows)
    assert all(found[i] == ("und", 0.0) for i in (500, 501, 502))
    assert found[503][0] == "bb" and found[504][0] == "cc" and found[None][0] == "aa"
    assert all(0 <= s <= 1 for _, s in found.values())


def test_no_language_to_learn(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    model = fit_language_model(docs)
    assert [tuple(r) for r in predict_language(docs, model).collect()] == [(1, "und", 0.0)]
    assert predict_language(docs.limit(0), model).count() == 0


SMALL = Settings(features=64, epochs=2, alpha=0.3, beta=0.7, l1=0.05, l2=0.1)


def features(texts, settings=SMALL):
    counts, _ = langid.gram_counts(*text_bytes(pa.array(texts)), settings)
    return counts


def test_document_frequencies_and_weights_of_features(spark):
    texts = ["abc abd", "abd", "xyz", None, "", "12", "abc"]
    rows = [(i, t, "aa" if i % 2 else "bb") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = fit_language_model(docs, settings=SMALL)
    counts = features([t or "" for t in texts])
    with_letters = 4  # the others have no letter, so no feature either
    for b in range(SMALL.features):
        holding = sum(c[b] > 0 for c in counts)
        assert model.idf[b] == pytest.approx(math.log((1 + with_letters) / (1 + holding)) + 1)
    row = langid._tf_idf(counts, model.idf)[0]
    raw = [math.log(1 + int(c)) * w for c, w in zip(counts[0], model.idf, strict=True)]
    norm = math.sqrt(sum(x * x for x in raw))
    assert row.tolist() == pytest.approx([x / norm for x in raw], abs=1e-6)


def test_grams_do_not_cross_texts_or_case():
    one, two, both = features(["ab", "CD", "ab CD"])
    assert (features(["AB"])[0] == one).all() and (features(["cd"])[0] == two).all()
    assert both.sum() > one.sum() + two.sum() and (both >= one + two - 2).all()


def test_fit_step_by_step():
    """Each weight by its own scalar update, in the order in which the rows are drawn."""
    draw = np.random.default_rng(3)
    x = draw.random((12, 64)).astype(np.float32) * (draw.random((12, 64)) < 0.2)
    y, k, s = draw.integers(0, 3, 12), 3, SMALL
    z, n = [[[0.0] * k for _ in range(64)] for _ in range(2)]

    def weight(f, c):
        if abs(z[f][c]) <= s.l1:
            return 0.0
        sign = math.copysign(1, z[f][c])
        return -(z[f][c] - sign * s.l1) / ((s.beta + math.sqrt(n[f][c])) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(12):
            held = [f for f in range(64) if x[i, f]]
            w = {(f, c): weight(f, c) for f in held for c in range(k)}
            e = [math.exp(sum(float(x[i, f]) * w[f, c] for f in held)) for c in range(k)]
            for f in held:
                for c in range(k):
                    g = float(x[i, f]) * (e[c] / sum(e) - (c == y[i]))
                    sigma = (math.sqrt(n[f][c] + g * g) - math.sqrt(n[f][c])) / s.alpha
                    z[f][c] += g - sigma * w[f, c]
                    n[f][c] += g * g
    got = langid._ftrl(langid._sparse(x), y, k, s)
    expected = [[weight(f, c) for c in range(k)] for f in range(64)]
    assert got == pytest.approx(np.array(expected), abs=1e-9)
    assert (got == 0).any() and (got != 0).any()


def test_temperature_against_a_fine_grid():
    draw = np.random.default_rng(5)
    scores = draw.normal(size=(200, 4)) * 6
    y = np.where(draw.random(200) < 0.7, scores.argmax(1), draw.integers(0, 4, 200))

    def loss(t):
        return -sum(s[c] / t - math.log(sum(math.exp(v / t) for v in s)) for s, c in zip(scores.tolist(), y, strict=True))

    best = min((math.exp(i / 200) for i in range(-600, 600)), key=loss)
    assert langid._best_temperature(scores, y) == pytest.approx(best, rel=0.01)
    assert langid._best_temperature(scores[:0], y[:0]) == 1.0


def test_predictions_follow_from_the_weights(spark):
    texts = ["bakudo", "ñexilu ab", "жзщ", "b", "zz"]
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(list(SOUNDS) * 10)]
    settings = Settings(features=256, sample_per_lang=10)
    model = fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), settings=settings)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in predict_language(docs, model).collect():
        count = Counter({b: int(c) for b, c in enumerate(features([texts[r.doc_id]], settings)[0]) if c})
        raw = {b: math.log(1 + c) * model.idf[b] for b, c in count.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        scores = [sum(v / norm * model.weights[b, c] for b, v in raw.items()) / model.temperature for c in range(3)]
        shares = [math.exp(v) / sum(map(math.exp, scores)) for v in scores]
        assert r.lang_pred == model.langs[int(np.argmax(shares))]
        assert r.score == pytest.approx(max(shares), abs=1e-5)
