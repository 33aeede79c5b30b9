import math
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from haulback.llm import pieces
from haulback.llm.quality import COMMON_WORDS, Limits
from tests.llm import test_jaccard, test_quality, test_repeats, test_tiling

sentencepiece = pytest.importorskip("sentencepiece")
LIMITS = Limits()


def histograms(text):
    words = test_quality.WORD.findall(text)
    common = Counter(w.lower() for w in words)
    counts = [common[w] for w in COMMON_WORDS]
    kinds = Counter()
    for c in text:
        if c.isupper():
            kinds["upper"] += 1
        elif c.islower():
            kinds["lower"] += 1
        elif c.isdigit():
            kinds["digit"] += 1
        elif c in ".,;:'\"()-":
            kinds["stop"] += 1
        elif c in " \t\n\x0b\x0c\r":
            kinds["space"] += 1
        else:
            kinds["other"] += 1
    classes = [kinds[k] for k in ("upper", "lower", "digit", "stop", "space", "other")]
    return classes, [*counts, len(words) - sum(counts)]


def distance(p, q):
    p, q = ([x / sum(h) for x in h] for h in (p, q))
    part = lambda x, y: x * math.log2(2 * x / (x + y)) if x else 0.0
    return math.sqrt(max(0, sum(part(x, y) + part(y, x) for x, y in zip(p, q, strict=True)) / 2))


def brute_quality(docs):
    sums = {}
    for _, text, lang in docs:
        n, _, symbols, _, repeat = test_quality.counts(text)
        sound = n >= LIMITS.min_words and 100 * repeat <= LIMITS.max_repeat_pct * n
        if lang is not None and sound and 100 * symbols <= LIMITS.max_reference_symbols_pct * len(text):
            have = sums.setdefault(lang, [[0] * 6, [0] * (len(COMMON_WORDS) + 1)])
            for total, new in zip(have, histograms(text or ""), strict=True):
                total[:] = [a + b for a, b in zip(total, new, strict=True)]
    out = []
    for key, text, lang in docs:
        n, _, _, _, repeat = test_quality.counts(text)
        fails = n < LIMITS.min_words or 100 * repeat > LIMITS.max_repeat_pct * n
        if not fails and lang in sums and sum(sums[lang][0]) >= LIMITS.min_reference_chars:
            classes, common = histograms(text)
            most = LIMITS.max_class_distance + LIMITS.class_distance_room / math.sqrt(n)
            fails = distance(classes, sums[lang][0]) > most
            if n >= LIMITS.min_compared_words:
                most = LIMITS.max_word_distance + LIMITS.word_distance_room / math.sqrt(n)
                fails |= distance(common, sums[lang][1]) > most
        if not fails:
            out.append((key, text, lang))
    return out


def brute_run(docs, items, library):
    docs = brute_quality(docs)
    label, _ = test_jaccard.brute({k: test_jaccard.shingles(t) for k, t, _ in docs})
    docs = [d for d in docs if label[d[0]] == d[0]]
    split = {k: re.findall(r"[^\x20\x09-\x0D]+", t) for k, t, _ in docs}
    gone = test_repeats.brute(split.items(), 20)
    left = []
    for key, text, _ in docs:
        out = gone.get(key, set())
        if len(out) < len(split[key]):
            left.append((key, " ".join(w for i, w in enumerate(split[key]) if i not in out) if out else text))
    found = {}
    for key, text in left:
        leak = False
        for _, body in items:
            a, b = test_tiling.words(text), test_tiling.words(body)
            leak |= bool(b) and sum(n for *_, n in test_tiling.brute(a, b, 3)) >= 0.5 * len(b) > 0
        if not leak:
            found[key] = library.encode(text)
    return found


def test_run_against_brute_force(spark, tmp_path):
    draw = random.Random(8)
    text = lambda seed, n: test_quality.clean(seed, n)
    items = [(i, text(900 + i, 18)) for i in range(3)]
    passage = text(800, 40)
    docs = [(i, text(i, draw.randint(60, 160)), "en") for i in range(24)]
    for i in range(24, 30):  # near copies
        parts = docs[i - 24][1].split()
        parts[3] = "edited"
        docs.append((i, " ".join(parts), "en"))
    docs += [(i, f"{text(i, 70)}\n{passage} {text(i + 50, 30)}", "en") for i in range(30, 34)]
    docs += [(34, passage + " " + passage + " " + text(34, 60), "en")]
    for i in range(35, 38):
        body = items[i - 35][1].split()
        docs.append((i, f"{text(i, 60)} {' '.join(body[9:] + body[:9])} {text(i + 50, 30)}", None))
    docs += [(38, "too short", "en"), (39, None, "en"), (40, "spam " * 200, "en"), (41, "", None)]
    docs += [(42, " ".join(w + "&&&" for w in text(42, 100).split()), "en"), (43, text(43, 3000), "fr")]
    rows = [(k, t, lang, "src", None if t is None else len(t), *["clash"] * 3) for k, t, lang in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += "component_id string, kept_text string, other_id string"
    folder = str(tmp_path)
    spark.createDataFrame([*rows, rows[2]], schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    expected = brute_run(docs, items, library)
    assert {r.doc_id: r.ids for r in got} == expected
    assert all(r.n_tokens == len(r.ids) for r in got) and len(got) == len(expected) + 1
    kept = set(expected)
    assert set(range(24)) <= kept and not kept & {*range(24, 30), *range(35, 43)}
    stage = spark.read.parquet(f"{folder}/documents.parquet")
    given = stage.dtypes
    for _, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, folder)
        assert stage.dtypes == given


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
