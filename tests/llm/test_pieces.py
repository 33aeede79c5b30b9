import random

import numpy as np
import pyarrow as pa
import pytest

from haulback.llm import pieces
from haulback.llm.arrays import text_bytes

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def texts(seed=1):
    draw = random.Random(seed)
    out = ["", "  a  b\n c\t", " ", " " * 70 + "x  y", "é中\U0001f600 ok", "\x00 a", "a" * 200, "ab" * 90]
    out += ["the" * 60, "1234567890" * 9, "x\n\n\ny", "▁▁x", " leading and trailing "]
    for letters in (" abethinrs'.,▁é\n中ng", "ethinrsao", " the of and"):
        out += ["".join(draw.choices(letters, k=draw.randint(1, 250))) for _ in range(60)]
    return out


def test_words_as_the_library(library):
    encoder = pieces.Encoder(pieces.load_vocabulary())
    rows = texts()
    ids, counts = encoder.encode(*pieces._code_rows(*text_bytes(pa.array(rows))))
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [library.encode(x) for x in rows]


@pytest.mark.parametrize("size", [5, 23, 400])
def test_chunks_as_the_library(library, size):
    v = pieces.load_vocabulary()
    encoder = pieces.Encoder(v)
    for text in texts(2)[1:]:
        chunks = pieces.cut_document(text, v.longest, size)
        matrices = [pieces.transfer(encoder, c) for c in chunks]
        states = pieces.boundary_states(matrices)
        found = pieces.trace_chunks(encoder, list(zip(chunks, states, states[1:], strict=False)))
        assert np.concatenate(found).tolist() == library.encode(text), text
        # Products may be taken in any grouping.
        while len(matrices) > 1:
            i = len(matrices) // 2 - 1
            matrices[i : i + 2] = [pieces.multiply(matrices[i], matrices[i + 1])]
        assert len(matrices[0]) == 1


def test_round_trip(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*texts(3), None, "word " * 3000, "z" * 3000])]
    rows += [(None, "no key", "y"), rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    encoded = pieces.encode(docs, chunk=1000)
    got = {r.doc_id: r for r in pieces.decode(encoded).collect()}
    assert encoded.count() == len(rows)
    for key, text, _ in rows:
        assert got[key].ids == library.encode(text or ""), key
        assert got[key].text == (text or "").replace("▁", " "), key


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(docs)).count() == 0
