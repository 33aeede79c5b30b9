import random
import re
from collections import defaultdict

import numpy as np
import pytest

from haulback.llm import repeats, substrings, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    """Removed symbols of each (key, symbols), by every window's first place."""
    first, places = {}, defaultdict(list)
    for key, symbols in sorted(texts):
        for i in range(len(symbols) - window + 1):
            w = tuple(symbols[i : i + window])
            if w in first:
                places[key].append(i)
            else:
                first[w] = (key, i)
    return {key: {i + k for i in at for k in range(window)} for key, at in places.items()}


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdé", k=draw.randint(1, 5))) for _ in range(40)]
    passage = lambda k: [draw.choice(words) for _ in range(k)]
    shared = [passage(draw.randint(5, 60)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = passage(draw.randint(0, 30))
        for _ in range(draw.randint(0, 3)):
            parts += draw.choice(shared) + passage(draw.randint(0, 12))
        if draw.random() < 0.3 and texts:
            parts = draw.choice(texts).split()
            if parts and draw.random() < 0.6:
                parts[draw.randrange(len(parts))] = "edit"
        texts.append(draw.choice([" ", "\n", "  "]).join(parts))
    texts += [None, "", " \n", "a " * 300, "x" * 500, "x" * 250 + "y" * 250, texts[0], " ".join(passage(4000))]
    texts.append(texts[-1])
    return texts


@pytest.fixture(params=[1, 2])
def docs(spark, request):
    rows = [(i * 3 % 101, t, "x") for i, t in enumerate(corpus(request.param))]
    rows += [rows[5], rows[5], (None, rows[4][1], "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, marks string").repartition(4)
    return rows, frame


def test_words(docs):
    rows, frame = docs
    got = substrings.remove_passages(frame, 8).collect()
    texts = {k: WORD.findall(t or "") for k, t, _ in rows if k is not None}
    gone = brute(texts.items(), 8)
    assert len(got) == len(rows)
    for r in got:
        words = texts[r.doc_id] if r.doc_id is not None else WORD.findall(rows[4][1] or "")
        out = gone.get(r.doc_id, set())
        kept = " ".join(w for i, w in enumerate(words) if i not in out)
        assert (r.n_words, r.n_removed, r.kept) == (len(words), len(out), kept), r.doc_id


@pytest.mark.parametrize("many", [10_000, 3])
def test_bytes(docs, many, monkeypatch):
    rows, frame = docs
    scheme = repeats.Scheme
    monkeypatch.setattr(suffixes, "Scheme", lambda *a: scheme(*a, many=many))
    monkeypatch.setattr(suffixes, "SORTED_TOGETHER", 50)
    got = suffixes.remove_strings(frame, 25).collect()
    texts = {k: (t or "").encode() for k, t, _ in rows if k is not None}
    gone = brute(texts.items(), 25)
    assert len(got) == len(rows)
    for r in got:
        body = texts[r.doc_id] if r.doc_id is not None else (rows[4][1] or "").encode()
        out = gone.get(r.doc_id, set())
        spans = sum(i - 1 not in out for i in out)
        kept = bytes(b for i, b in enumerate(body) if i not in out)
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(body), len(out), spans, kept)


def test_multikey_sort():
    draw = np.random.default_rng(1)
    tokens = [draw.integers(0, 3, 200).astype(np.uint64) for _ in range(4)]
    order, run = suffixes.multikey_sort(tokens)
    rows = list(zip(*(t.tolist() for t in tokens), strict=True))
    assert [rows[i] for i in order] == sorted(rows)
    assert len(set(run.tolist())) == len(set(rows))


@pytest.mark.parametrize("remove", [substrings.remove_passages, suffixes.remove_strings])
def test_empty_table(spark, remove):
    assert remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


A = " ".join(f"a{i}" for i in range(60)) + " " + " ".join(f"s{i}" for i in range(30))
B = " ".join(f"s{i}" for i in range(30)) + " " + " ".join(f"b{i}" for i in range(60))


@pytest.mark.parametrize("rows", [
    [(1, A), (1, B)],
    [(1, B), (1, A)],
    [(2, B), (1, A), (1, B), (None, A), (1, None)],
    [(1, A), (1, A), (1, B), (1, B), (3, A + " c " + B), (-4, "short"), (-4, "other")],
    [(5, A), (5, B), (5, A + " " + B), (7, B + " " + A), (7, B)],
])
@pytest.mark.parametrize("parts", [1, 5])
def test_texts_that_share_a_key(spark, rows, parts):
    """Texts of a key are judged as texts of their own: what occurs once in all of them stays."""
    frame = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, i int")
    frame = frame.repartition(parts, "i") if parts > 1 else frame.coalesce(1)
    hashes = {t: frame.sparkSession.range(1).selectExpr(f"xxhash64('{t or ''}') h").first().h for _, t in rows}
    known = [(k, hashes[t], t) for k, t in rows if k is not None]
    for remove, symbols, out, window in (
        (substrings.remove_passages, lambda t: WORD.findall(t or ""), lambda w: " ".join(w), 8),
        (suffixes.remove_strings, lambda t: list((t or "").encode()), bytes, 25),
    ):
        gone = brute({((k, h), tuple(symbols(t))) for k, h, t in known}, window)
        expected = []
        for k, t in rows:
            left = gone.get((k, hashes[t]), set()) if k is not None else set()
            expected.append((repr(k), out([x for i, x in enumerate(symbols(t)) if i not in left])))
        got = remove(frame, window).collect()
        kept = [(repr(r.doc_id), bytes(r.kept) if window == 25 else r.kept) for r in got]
        assert sorted(kept) == sorted(expected)


def test_carried_columns_stay_with_their_text(spark):
    frame = spark.createDataFrame([(1, A, "x"), (1, B, "y"), (1, None, "z")], "doc_id long, text string, marks string")
    got = substrings.remove_passages(frame, 8, carry=["text", "marks", "doc_id"]).collect()
    assert sorted((r[5], r[0], r[6]) for r in got) == [("x", 1, 1), ("y", 1, 1), ("z", 1, 1)]
    assert {r[4] for r in got} == {A, B, None}
