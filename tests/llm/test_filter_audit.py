import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from haulback.llm import filter_audit, oracle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(text):
    words = WORD.findall(text)
    tests = [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        any(c in "#$%&*|" for c in text),
    ]
    return {f for f, t in zip("ABCD", tests, strict=True) if t}


def audit(docs, labels):
    """Every order applied to the documents, one filter after the other."""
    fails = []
    for key, text, lang in docs:
        mask = failed(text or "")
        if key is not None and any(k is not None and k < key and (t or "") == (text or "") for k, t, _ in docs):
            mask.add("E")
        good = any(k == key and q == 1 for k, q, _ in labels if key is not None)
        toxic = any(k == key and x == 1 for k, _, x in labels if key is not None)
        fails.append((lang or "", mask, good, toxic))
    out = {}
    for part in {lang for lang, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f in x[1] for x in own) - len(gone),
                    sum(x[1] == {f} for x in own),
                    sum(x[2] for x in gone),
                    sum(x[3] for x in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def documents():
    draw = random.Random(4)
    long = lambda n, k: " ".join(f"w{draw.randrange(k)}" for _ in range(n))
    texts = [None, "", " \n\t", "ABC", "a#b", "é" * 9 + "A", "é" * 10 + "AA", long(99, 900), long(100, 9000)]
    texts += [long(draw.randint(90, 400), draw.choice([50, 9000])) + draw.choice(["", " $", " ABCDEFGHI" * 40]) for _ in range(40)]
    texts += [" ".join(f"x{i}" for i in range(80)) + " x1" * 20, " ".join(f"x{i}" for i in range(79)) + " x1" * 21]
    docs = [(i, t, draw.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    docs += [(100 + i, draw.choice(texts), draw.choice(["en", "xx"])) for i in range(60)]
    docs += [docs[3], docs[3], (3, "other text, same id", "de"), (None, texts[20], "en"), (-5, texts[21], "en")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 160, 2)]
    return docs, labels + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]


SCHEMAS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def test_against_every_order(spark):
    docs, labels = documents()
    frames = [spark.createDataFrame(*x) for x in zip((docs, labels), SCHEMAS, strict=True)]
    clash = frames[0].selectExpr("*", "'x' AS mask", "1 AS key", "2 AS part", "3 AS quality").repartition(7)
    got = filter_audit.audit_filters(clash, frames[1]).collect()
    assert {tuple(r[:3]): list(r[3:]) for r in got} == audit(docs, labels)
    assert len(got) == 600 * len({lang or "" for *_, lang in docs})


def test_statement(spark, tmp_path):
    docs, labels = documents()
    con = duckdb.connect()
    for name, rows, schema in zip(("documents", "labels"), (docs, labels), SCHEMAS, strict=True):
        con.execute(f"CREATE TABLE {name} ({schema.replace('string', 'VARCHAR').replace('long', 'BIGINT')})")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", rows)
    relation = con.sql(oracle.audit_sql())
    order = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = relation.project(", ".join(order)).fetchall()
    assert {r[:3]: list(r[3:]) for r in rows} == audit(docs, labels)


@pytest.mark.parametrize("n", [1, 3, 6])
def test_walk_against_each_set(n):
    cells = np.random.default_rng(n).integers(0, 9, (2, 1 << n))
    stored = filter_audit.survivors_of_all_sets(cells)
    for active in range(1 << n):
        for i in range(2):
            assert stored[i, active] == sum(cells[i, m] for m in range(1 << n) if not m & active)


def test_long_texts_in_slices(monkeypatch):
    text = " ".join(f"w{i % 300}" for i in range(3000)).encode()
    whole = filter_audit.text_failures(text)
    monkeypatch.setattr(filter_audit.slices, "__defaults__", (50,))
    assert filter_audit.text_failures(text) == whole == 0b0010


def test_empty_table(spark):
    docs, labels = (spark.createDataFrame([], s) for s in SCHEMAS)
    assert filter_audit.audit_filters(docs, labels).count() == 0
