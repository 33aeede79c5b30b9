import random
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import numpy as np
import pytest

from haulback.llm import packing

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(packing.default_tokenizer())


def unrolled(layers):
    """Sequence and offset of every (length, rank)."""
    places = {}
    for length, first, number, sequence, each, offset in zip(*(x.tolist() for x in layers), strict=True):
        for k in range(number):
            places[length, first + k] = (sequence + k // each, offset + k % each * length)
    return places


def check_gapless(placed, capacity):
    """(sequence, offset, length) triples fill sequences from 0 without a gap."""
    by_sequence = defaultdict(list)
    for sequence, offset, length in placed:
        by_sequence[sequence].append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def fewest(sizes, capacity):
    """The optimum, by trying every set of pieces as the next sequence."""

    @cache
    def need(left):
        if not left:
            return 0
        first, best = left[0], len(left)
        rest = left[1:]
        for mask in range(1 << len(rest)):
            chosen = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(chosen) <= capacity:
                best = min(best, 1 + need(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
        return best

    return need(tuple(sorted(sizes, reverse=True)))


def best_fit_one_by_one(sizes, capacity):
    rooms = []
    for x in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= x]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_plans_against_all_packings(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 12, 20])
    low = draw.choice([1, 2, capacity // 3])
    sizes = [draw.randint(low, capacity) for _ in range(draw.randint(1, 9))]
    counts = Counter(sizes)
    layers = packing.plan_packing(counts, capacity)
    places = unrolled(layers)
    assert sorted(places) == sorted((s, k) for s, n in counts.items() for k in range(n))
    used = check_gapless([(*p, s) for (s, _), p in places.items()], capacity)
    assert used == packing.sequences(layers)
    best = fewest(sizes, capacity)
    assert packing.lower_bound(counts, capacity) <= best <= used <= best_fit_one_by_one(sizes, capacity)


@pytest.mark.parametrize("seed", range(150))
def test_fixed_sets_cost_nothing(seed):
    draw = random.Random(1000 + seed)
    capacity = draw.choice([10, 15])
    sizes = [draw.randint(draw.choice([1, 3]), capacity) for _ in range(draw.randint(2, 8))]
    left = np.bincount(sizes, minlength=capacity + 1)
    for length in sorted(set(sizes)):
        found = packing.dominating_set(left, length)
        if found is None:
            continue
        rest = Counter(sizes)
        rest.subtract(found)
        assert min(rest.values()) >= 0 and sum(found) <= capacity and length in found
        assert 1 + fewest(list(rest.elements()), capacity) == fewest(sizes, capacity)


def test_remainder_is_best_fit():
    draw = random.Random(5)
    for _ in range(100):
        capacity = draw.choice([30, 100])
        sizes = [draw.randint(1, capacity) for _ in range(draw.randint(1, 60))]
        plan = packing._Plan()
        packing._best_fit(np.bincount(sizes, minlength=capacity + 1), plan)
        assert plan.sequences == best_fit_one_by_one(sizes, capacity)


def test_a_plan_does_not_grow_with_the_table():
    draw = random.Random(3)
    counts = Counter(draw.randint(1, 4096) for _ in range(20_000))
    small = packing.plan_packing(counts)
    large = packing.plan_packing({s: n * 10**9 for s, n in counts.items()})
    assert len(large.length) < 16 * 4096
    assert packing.sequences(large) <= 1.001 * packing.lower_bound({s: n * 10**9 for s, n in counts.items()})
    assert packing.sequences(small) <= 1 + 1.001 * packing.lower_bound(counts)


def texts():
    draw = random.Random(2)
    odd = ["", None, " \n ", "a", "don't I'LL x's", "x" * 700, "é é ΑΣ ﬁ İ ǅ", "a b　c\u0085d\x1ce\x1f f"]
    odd += ["中文字符 かな 한국어 \U0001f600‍", "a<|endoftext|>b <|startoftext|>", "1234 5,6 $%^ _x_", "\x00 \x0b \x0c"]
    odd += [" ́a b̈ ̧", "ﬁn ½ ①", "word " * 300, "tab\tline\r\nend\v."]
    letters = " \n\tabethinrs'.,é1中́ ​Σ"
    odd += ["".join(chr(c) for c in range(0x21, 0x180)), " ".join(chr(c) + "." for c in range(0x21, 0x180))]
    odd += ["Große ÀÉÎ, ÿß! naïve... façade?! Æther x×y a÷b ªº µm İstanbul ŒUVRE ěščř"]
    odd += ["Word WORD word. word., a.b A.. I'm. ?! .x don't, it's: rock'n'roll; U.S. x1. <|EndOfText|> <|endoftext|>."]
    return odd + ["".join(draw.choices(letters, k=draw.randint(1, 300))) for _ in range(60)]


@pytest.mark.parametrize("size, run, remembered", [(40, 9, 20), (1 << 20, 1 << 14, 1 << 19), (300, 1 << 14, 5)])
def test_ids_as_the_library(library, size, run, remembered, monkeypatch):
    for name, value in (("_SLICE", size), ("_RUN", run), ("_REMEMBERED", remembered)):
        monkeypatch.setattr(packing, name, value)
    monkeypatch.setattr(packing.slices, "__defaults__", (size,))
    words = packing._Words(Path(packing.default_tokenizer()).read_text(encoding="utf-8"))
    expected = []
    for key, text in enumerate(texts() * 2):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected += [(key, i // 16, i, len(ids[i : i + 16]), ids[i : i + 16]) for i in range(0, len(ids), 16)]
    keyed = ((key, (text or "").encode()) for key, text in enumerate(texts() * 2))
    got = packing.text_pieces(keyed, words, 16, 1)
    assert [(*p[:4], np.frombuffer(p[4], "<u4").tolist()) for p in got] == expected


def test_only_a_fitting_vocabulary_is_taken_plainly(library):
    letters = packing._plain_letters(library)
    assert letters[ord("A")] == "a" and letters[ord("É")] == "Ã©"
    decomposes = tokenizers.Tokenizer.from_str(library.to_str())
    decomposes.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    assert packing._plain_letters(decomposes) is None  # marks are not set apart
    holds_a_word = tokenizers.Tokenizer.from_str(library.to_str())
    holds_a_word.add_tokens(["abc"])
    assert packing._plain_letters(holds_a_word) is None
    words = packing._Words(holds_a_word.to_str())
    assert words.letters is None
    expected = holds_a_word.encode("Some Words. here", add_special_tokens=False).ids
    assert words.ids([b"Some Words. here"])[0].tolist() == expected


def test_documents(spark, library):
    rows = [(i, t, "x", 5) for i, t in enumerate(texts())]
    rows += [rows[4], rows[4], (4, "another text under one id", "y", 1), (None, "no key", "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, offset int").repartition(5)
    got = packing.pack_documents(docs, 16).collect()
    check_gapless([(r.sequence_id, r.offset, r.length) for r in got], 16)
    found = Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got)
    expected = Counter()
    for key, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected.update((key, i // 16, i, tuple(ids[i : i + 16])) for i in range(0, len(ids), 16))
    assert found == expected
    assert all(r.length == len(r.ids) // 4 for r in got)


def test_lengths_and_empty_tables(spark):
    items = spark.createDataFrame([(i, 1 + i * 7 % 10, "keep") for i in range(2000)], "a int, length long, sequence_id string")
    got = packing.pack(items, capacity=10).collect()
    assert sorted((r.a, r.length) for r in got) == [(i, 1 + i * 7 % 10) for i in range(2000)]
    assert check_gapless([(r.sequence_id, r.offset, r.length) for r in got], 10) == 1100
    for wrong in (None, 0, 11):
        with pytest.raises(ValueError, match="1 rows"):
            packing.pack(spark.createDataFrame([(wrong,), (3,)], "length int"), capacity=10)
    none = packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert none.count() == 0 and none.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
