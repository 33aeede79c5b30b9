import random
import re
import time

import numpy as np
import pytest

from haulback.llm.tiling import Settings, _joined, find_contaminated, seed_runs, tile

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def brute(doc, item, least):
    """Greedy string tiling by its definition: over all pairs of places, the longest free match."""
    used_doc, used_item, out = [False] * len(doc), [False] * len(item), []
    while True:
        best, found = least, []
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while (
                    p + n < len(doc)
                    and q + n < len(item)
                    and doc[p + n] == item[q + n]
                    and not used_doc[p + n]
                    and not used_item[q + n]
                ):
                    n += 1
                if n > best:
                    best, found = n, [(p, q)]
                elif n == best:
                    found.append((p, q))
        if not found:
            return out
        for p, q in found:
            if not any(used_doc[p : p + best]) and not any(used_item[q : q + best]):
                used_doc[p : p + best] = used_item[q : q + best] = [True] * best
                out.append((p, q, best))


def test_tile_as_defined():
    draw = random.Random(4)
    for _ in range(150):
        doc, item = (np.array(draw.choices(range(4), k=draw.randint(0, 30))) for _ in range(2))
        starts = [
            (p, q)
            for p in range(len(doc) - 2)
            for q in range(len(item) - 2)
            if (doc[p : p + 3] == item[q : q + 3]).all()
        ]
        place, there = np.array(starts, np.int64).reshape(-1, 2).T
        runs = seed_runs(place, there, 3)
        assert tile(len(doc), len(item), runs, 3) == brute(list(doc), list(item), 3)
        # Runs found for parts of the document are the same.
        cut = draw.randint(0, len(doc))
        parts = [seed_runs(place[own], there[own], 3) for own in (place < cut, place >= cut)]
        joined = _joined(parts, 3)
        assert sorted(zip(*(x.tolist() for x in joined))) == sorted(zip(*(x.tolist() for x in runs)))


def test_equal_words_without_end(spark):
    """20,000 equal words against 200 of them, and two words that alternate."""
    docs = [(1, "spam " * 20_000), (2, "a b " * 10_000), (3, "spam " * 150 + "other"), (4, "ham " * 20_000)]
    items = [(1, "spam " * 200), (2, "a b " * 100), (3, "b a x y " + "a b " * 20)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in (
        (docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    began = time.time()
    got = sorted(tuple(r) for r in find_contaminated(*frames).collect())
    assert got == [(1, 1, 200, 200, 200), (2, 2, 200, 200, 200), (2, 3, 44, 40, 40), (3, 1, 200, 150, 150)]
    assert time.time() - began < 60


@pytest.mark.parametrize("item_chars", [4 << 20, 300])
def test_against_brute_force(spark, item_chars):
    draw = random.Random(6)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = lambda n: draw.choices(vocabulary, k=n)
    items = [(i, " ".join(passage(draw.randint(2, 30)))) for i in range(20)]
    docs = []
    for i in range(60):
        body = passage(draw.randint(0, 60))
        if i % 3 == 0:
            parts = draw.choice(items)[1].split()
            at = draw.randint(0, len(parts))
            body = body + parts[at:] + passage(5) + parts[:at]  # reordered
        docs.append((i, " ".join(body).upper() if i % 2 else " ".join(body), "x"))
    odd = [(100, None, ""), (101, "", ""), (102, " ".join(passage(20_000)) + " " + items[0][1], ""), docs[0]]
    odd += [(None, items[1][1], "")]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string, item_id string").repartition(3)
    asked = spark.createDataFrame([*items, items[3], (None, items[2][1]), (50, None)], "item_id long, text string")
    settings = Settings(item_chars=item_chars)
    got = [tuple(r) for r in find_contaminated(frame, asked, settings=settings).collect()]
    assert len(got) == len(set(got))
    expected = set()
    for key, text, _ in docs:
        for item, body in items:
            tiles = brute(words(text), words(body), 3)
            covered = sum(n for *_, n in tiles)
            if tiles and covered >= 0.5 * len(words(body)):
                expected.add((key, item, len(words(body)), covered, max(n for *_, n in tiles)))
    assert {r for r in got if r[0] < 100} == expected and len(expected) >= 15
    assert any(r[:2] == (102, 0) for r in got) and not any(r[0] in (100, 101) for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert find_contaminated(docs.limit(0), items).count() == 0
    assert find_contaminated(docs, items.limit(0)).count() == 0
    assert find_contaminated(docs, items).count() == 1
