import math
import random
import re
from collections import Counter, defaultdict

import pytest

from haulback.llm.scoring import Settings, score, train

SETTINGS = Settings(order=3, floor=1e-9, head_share=0.02, slice=16)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), None]


def symbols(text, order):
    return ["<"] * (order - 1) + list((text or "").translate(LOW).encode()) + [">"]


class Brute:
    """The same smoothing by its recursion, with no automaton."""

    def __init__(self, texts, order, least):
        self.order, self.least = order, least
        self.n, self.followers = Counter(), defaultdict(Counter)
        for t in texts:
            s = symbols(t, order)
            for i in range(order - 1, len(s)):
                for m in range(order):
                    self.followers[tuple(s[i - m : i])][s[i]] += 1

    def kept(self, context, symbol):
        n = self.followers[context][symbol]
        return not context or (n and (len(context) < 2 or n >= self.least))

    def mixed(self, context, symbol):
        seen = self.followers[context]
        lower = 1 / 257 if not context else self.p(context[1:], symbol)
        return (seen[symbol] + len(+seen) * lower) / (sum(seen.values()) + len(+seen)) if seen else lower

    def p(self, context, symbol):
        if self.kept(context, symbol):
            return self.mixed(context, symbol)
        kept = [x for x in list(self.followers[context]) if self.kept(context, x)]
        if not kept:
            return self.p(context[1:], symbol)
        left = 1 - sum(self.mixed(context, x) for x in kept)
        return left / (1 - sum(self.p(context[1:], x) for x in kept)) * self.p(context[1:], symbol)

    def score(self, text):
        s = symbols(text, self.order)
        return sum(math.log10(self.p(tuple(s[i - self.order + 1 : i]), s[i])) for i in range(self.order - 1, len(s)))


@pytest.mark.parametrize("floor", [1e-9, 0.004])
def test_against_brute_force(spark, floor):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcd", k=draw.randint(1, 4))) for _ in range(60)]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 40))) for _ in range(50)]
    texts += [None, "", " \t\n", "Ab AB ab é\x0bx", "zz zz q", texts[0], "abc " * 3000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "ab cd", "y"), (3, texts[3], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    learned = [r for r in rows if r[0] is not None and r[0] % 10 != 0]
    settings = SETTINGS._replace(floor=floor)
    model = train(docs.filter("doc_id % 10 != 0"), settings=settings)
    counts = Counter(w for _, t, _ in learned for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    grams = sum(len((t or "").encode()) + 1 for _, t, _ in learned)
    brute = Brute([t for _, t, _ in learned], 3, max(1.0, floor * grams))
    got = score(docs, model).collect()
    assert len(got) == len(rows)
    by_id = dict(((i, t) for i, t, _ in rows))
    for r in got:
        own = tokens(by_id[r.doc_id])
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base)
        assert r.score == pytest.approx(brute.score(by_id[r.doc_id]), rel=1e-9)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = train(docs.limit(0), settings=SETTINGS)
    row = score(docs, model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == pytest.approx(4 * math.log10(1 / 257))
    assert score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("arc_share", [0.5, 0.01, Settings().arc_share])
def test_rare_grams_count_at_any_size(spark, arc_share):
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("abcdef", k=4)) for _ in range(30)) for _ in range(20)]
    learned = ["zy " * 400_000, *texts[:15]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    corpus = spark.createDataFrame(list(enumerate(learned)), "doc_id long, text string")
    model = train(corpus, settings=Settings(order=3, arc_share=arc_share))
    brute = Brute(learned, 3, 1)
    for r in score(docs, model).collect():
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]), rel=1e-9)
