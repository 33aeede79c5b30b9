import random
import re
from hashlib import sha256

import duckdb
import pytest

from haulback.llm import infilling, oracle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows():
    draw = random.Random(6)
    texts = [None, "", " ", "a", " a ", "<P>", "a <M> b", "<p>", "< P>", "<", "P>", "<<", ">", "\n\x0b\x0c x\r", "a\u0085b c"]
    texts += ["word " * 5000, "é中\U0001f600 " * 40, "x" * 300_000]
    texts += ["".join(draw.choices("ab <>PSMé\n\t中", k=draw.randint(1, 80))) for _ in range(300)]
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [out[4], out[4], (4, "other"), (None, "no key at all"), (-7, "a b c d e f"), (2**62, "g h i")]


def test_texts_and_round_trip(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").selectExpr("*", "'x' AS output", "1 AS n", "2 AS form").repartition(4)
    got = infilling.restore_texts(infilling.fill_in_middle(docs)).collect()
    plain = lambda k, r: (repr(k), *map(repr, r))
    assert sorted(plain(r.doc_id, r[1:6]) for r in got) == sorted(plain(k, expected(k, t)) for k, t in rows())
    restored = sorted((repr(r.doc_id), r.restored) for r in got)
    assert restored == sorted((repr(k), t or "") for k, t in rows())
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_statement():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows())
    found = con.sql(oracle.infilling_sql()).project("doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256")
    digest = lambda t: sha256((t or "").encode()).hexdigest()
    want = [(k, *expected(k, t)[:4], digest(expected(k, t)[4]), digest(t)) for k, t in rows()]
    assert sorted(map(repr, found.fetchall())) == sorted(map(repr, want))


@pytest.mark.parametrize("form", ["psm", "spm"])
@pytest.mark.parametrize("stride", [1, 3, 1 << 16])
def test_every_cut(form, stride, monkeypatch):
    monkeypatch.setattr(infilling, "_STRIDE", stride)
    text = b"ab<c P>d"
    for first in range(len(text) + 1):
        for second in range(first, len(text) + 1):
            p, m, s = text[:first], text[first:second], text[second:]
            out = infilling.transform(text, first, second, form)
            assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
            assert infilling.restore(bytes(out), form) == text


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = infilling.restore_texts(infilling.fill_in_middle(docs))
    assert found.count() == 0
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
