import random
import re
from itertools import combinations

import pytest

from haulback.llm.components import connected_components
from haulback.llm.jaccard import Settings, least_distance, near_duplicates, shingle_sets, _signatures
from haulback.llm.arrays import text_bytes

import pyarrow as pa

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SETTINGS = Settings(counters=1 << 10)


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(sets):
    label = {k: k for k in sets}
    links = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label, links


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = draw.choices(vocabulary, k=12)
    texts = []
    for _ in range(25):
        base = draw.choices(vocabulary, k=draw.randint(1, 120))
        if draw.random() < 0.7:
            base += line
        texts.append(" ".join(base))
        # A chain of copies, each edited once more, so that its ends no longer link.
        for _ in range(draw.choice([0, 1, 8])):
            base = list(base)
            base[draw.randrange(len(base))] = f"e{draw.randrange(10**6)}"
            texts.append(" ".join(base).upper() if draw.random() < 0.2 else " ".join(base))
        if draw.random() < 0.5:
            texts.append(texts[-1])
    texts += [None, "", " \n ", "a b", "A  b", "a b c d", "x " * 300, "x " * 20, "long " + " ".join(draw.choices(vocabulary, k=5000))]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_against_all_pairs(spark, seed, broadcast):
    rows = [(i * 7 % 1009, t, "x") for i, t in enumerate(corpus(seed))]
    extra = [rows[3], (None, rows[4][1], "y")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, component_id string").repartition(5)
    got = near_duplicates(docs, settings=SETTINGS._replace(broadcast_docs=broadcast)).collect()
    sets = {k: shingles(t) for k, t, _ in rows}
    label, links = brute(sets)
    assert len(links) > 40 and len(got) == len(rows) + len(extra)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.n_shingles == len(shingles(rows[4][1]))
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), label[r.doc_id]), r.doc_id


@pytest.mark.parametrize("order", [1, -1])
def test_texts_that_share_a_key(spark, order):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, one), (1, two), (2, two + " end"), (3, one + " end"), (3, one), (4, None), (4, "c d"), (None, one), (5, "c d")]
    docs = spark.createDataFrame(rows[::order], "doc_id long, text string").repartition(3)
    got = sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in near_duplicates(docs, settings=SETTINGS).collect())
    expected = [(1, 36, 1), (1, 36, 1), (2, 37, 1), (3, 37, 1), (3, 36, 1), (4, 0, 4), (4, 1, 4), (None, 36, None), (5, 1, 4)]
    assert got == sorted((repr(k), n, repr(c)) for k, n, c in expected)


def test_signatures_bound_distances():
    draw = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(draw.sample(base, draw.randint(1, 200))) for _ in range(12)]
    texts += [t + " " + texts[0] for t in texts[:6]]
    data, offsets = text_bytes(pa.array(texts))
    ids, sizes = shingle_sets(data, offsets, 5)
    bits = _signatures(ids, sizes)
    for a, b in combinations(range(len(texts)), 2):
        x, y = shingles(texts[a]), shingles(texts[b])
        true = 1 - len(x & y) / len(x | y)
        assert least_distance(len(x), bits[a], len(y), bits[b]) <= true + 1e-12


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string"), settings=SETTINGS).count() == 0


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == label and len(got) == len(label)
