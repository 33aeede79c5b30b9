import random
import re
from collections import Counter

from haulback.llm.quality import Limits, judge_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    twice = [i for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1]
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len({i + k for i in twice for k in range(3)}),
    )


def clean(i, n=200):
    draw = random.Random(i)
    common = ["the", "of", "and", "to", "in", "is"]
    return " ".join(
        draw.choice(common) if draw.random() < 0.4 else "".join(draw.choices("abcdelmnot", k=5))
        for _ in range(n)
    )


def test_counts_and_verdicts(spark):
    texts = {i: clean(i) for i in range(20)}
    texts |= {
        20: None,
        21: "",
        22: " \t\n\x0b ",
        23: "one two",
        24: " x y z\u0085" * 30,
        25: "spam " * 400,
        26: " ".join(f"{w}&&& ###" for w in clean(26).split()),
        27: "a b c\n\na b c\n \n \nd\x0ba b c",
        28: " ".join(f"zq{j}" for j in range(400)),
        29: "long " + clean(29, 60_000),
    }
    rows = [(i, t, "en" if i != 24 else None, "clash") for i, t in texts.items()]
    docs = spark.createDataFrame(rows + [rows[0], (None, texts[1], "xx", "")], "doc_id long, text string, lang string, words string")
    got = judge_quality(docs, Limits(min_reference_chars=100)).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        expected = counts(texts[r.doc_id if r.doc_id is not None else 1])
        assert tuple(r[1:6]) == expected, r.doc_id
        assert r.base_failed == (expected[0] < 50 or 2 * expected[4] > expected[0])
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(20)) and kept[None]
    assert not any(kept[i] for i in (20, 21, 22, 23, 25, 26, 27, 28))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert judge_quality(docs).count() == 0


def test_junk_without_a_reference_of_its_own(spark):
    soup = " ".join(f"{w}&&& ###" for w in clean(50).split())
    shuffled = " ".join(f"zq{j}" for j in range(400))
    odd = [(100, soup, None), (101, shuffled, None), (102, soup, "xx"), (103, clean(51), None), (104, clean(52), "xx")]
    schema = "doc_id long, text string, lang string"
    texts = [(i, clean(i), "en") for i in range(20)] + [(30 + i, clean(i).upper(), "up") for i in range(20)]
    limits = Limits(min_reference_chars=10_000)
    for rows in (texts, [(i, t, None) for i, t, _ in texts[:20]]):
        kept = {r.doc_id: r.kept for r in judge_quality(spark.createDataFrame(rows + odd, schema), limits).collect()}
        assert [kept[i] for i in range(100, 105)] == [False, False, False, True, True]
