"""Language-model scores: a weighted backoff automaton over bytes, beside a smoothed word base."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.llm.arrays import LOWER, row_of, signed, text_blocks, word_bounds, word_hashes
from haulback.llm.shipping import ship_package
from haulback.operators.lineage import cut_lineage

#: What a row counts or asks for; a text's own row asks for nothing.
WORD, GRAM, OWN = 0, 1, 2
#: Bits of a symbol in a gram's code, whose lowest symbol is the last one; the symbols after bytes.
BITS, END, START = 9, 256, 257
SYMBOLS = 257
#: The word key of the end that closes every text.
END_WORD = -1
_MERGE = 1 << 20


class Settings(NamedTuple):
    """Of the model, and of the arcs and word counts that go along with every task."""

    order: int = 6
    #: Grams of three and more symbols are left out of the model below this share of all; 0 keeps
    #: every gram, so that the model grows with the corpus.
    floor: float = 0.0
    #: Grams that make up this share of all are arcs of the automaton that goes along with a task, at
    #: most 1 / arc_share of each order; the texts' other grams are joined with the written model.
    arc_share: float = 2.0**-22
    #: Words that make up this share of all tokens are looked up in place; the others are joined.
    #: So at most 1 / head_share words go along with a task, at any size of the corpus.
    head_share: float = 2.0**-22
    #: Texts are read in slices side by side.
    slice: int = 512


class _Tally:
    """Counts of 64-bit codes, merged as they come; what is taken out sums up to the same."""

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0
        self.merged = 0

    def add(self, codes: np.ndarray) -> None:
        found, n = np.unique(codes, return_counts=True)
        self.codes.append(found)
        self.counts.append(n.astype(np.int64))
        self.size += len(found)
        # Only when as much has come as there was, so that no code is merged again and again.
        if self.size > _MERGE and self.size >= 2 * self.merged:
            self.merge()

    def merge(self) -> None:
        codes, counts = np.concatenate(self.codes), np.concatenate(self.counts)
        order = np.argsort(codes, kind="stable")  # the parts are sorted, so they are only merged
        codes, counts = codes[order], counts[order]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = codes[1:] != codes[:-1]
        if len(codes):
            counts = np.add.reduceat(counts, np.flatnonzero(fresh))
        self.codes, self.counts = [codes[fresh]], [counts]
        self.size = self.merged = len(self.codes[0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.merge()
        out = self.codes[0].view(np.int64), self.counts[0]
        self.codes, self.counts, self.size, self.merged = [], [], 0, 0
        return out


def _with_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased symbols of the rows, each closed by an end; and the offsets of the rows."""
    rows = len(offsets) - 1
    out = np.full(len(data) + rows, END, np.int64)
    out[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))] = LOWER[data]
    return out, offsets + np.arange(rows + 1)


def _gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Of every symbol, the code of the gram of ``order`` symbols that it ends; starts pad texts."""
    symbols, cuts = _with_ends(data, offsets)
    at = np.arange(len(symbols)) - np.repeat(cuts[:-1], np.diff(cuts))
    codes = symbols.copy()
    for back in range(1, order):
        before = np.full(len(symbols), START, np.int64)
        before[back:] = symbols[:-back]
        codes |= np.where(at >= back, before, START) << (BITS * back)
    return codes


def count_corpus(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Rows (kind, code, n): how often each word and each gram of bytes occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, ends = {WORD: _Tally(), GRAM: _Tally()}, 0

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            codes, n = tallies[kind].take()
            for i in range(0, len(codes), 1 << 16):
                part = [codes[i : i + (1 << 16)], n[i : i + (1 << 16)]]
                kinds = pa.array(np.full(len(part[0]), kind, np.int32))
                yield pa.RecordBatch.from_arrays([kinds, *map(pa.array, part)], names=["kind", "code", "n"])

        for _, data, offsets in text_blocks(batches, text):
            data = LOWER[data]
            starts, stops = word_bounds(data, offsets)
            tallies[WORD].add(word_hashes(data, starts, stops))
            tallies[GRAM].add(_gram_codes(data, offsets, settings.order).view(np.uint64))
            ends += len(offsets) - 1
            for kind, tally in tallies.items():
                if tally.merged > _MERGE:
                    yield from out(kind)
        yield from out(WORD)
        yield from out(GRAM)
        last = [np.array([WORD], np.int32), np.array([END_WORD]), np.array([ends])]
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in last], names=["kind", "code", "n"])

    counted = docs.select(text).mapInArrow(count, "kind int, code long, n long")
    return counted.groupBy("kind", "code").agg(F.sum("n").alias("n"))


class Automaton(NamedTuple):
    """States are contexts. An arc (state, symbol) has a log10 probability and a next state; where a
    state has no such arc, its failure arc leads to a shorter context.

    It has the frequent grams only. Arcs from ``full`` on end a gram of the whole order, whose
    probability is the model's own; the others and the failure arcs lead to the next state, and what
    a text reads by them is looked up in the model's tables.
    """

    keys: np.ndarray
    slots: np.ndarray
    logp: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    full: int
    start: int


class GramModel(NamedTuple):
    """Written tables: of each order the grams (code, n, p), and the failure arcs (m, context, weight)."""

    grams: dict[int, DataFrame]
    failures: DataFrame
    total: int


def _low(code: str, m: int) -> Column:
    """The code of the last ``m`` symbols."""
    return F.col(code).bitwiseAND(F.lit((1 << BITS * m) - 1).cast("long"))


def gram_model(counts: DataFrame, settings: Settings = Settings()) -> GramModel:
    """Witten-Bell smoothed grams of all texts; without texts all symbols are alike.

    A kept gram's probability mixes its share with that of the gram one symbol shorter; the failure
    weight of a context hands on what its arcs leave, so every state's probabilities sum up to 1.
    """
    orders = range(1, settings.order + 1)
    parts = [F.struct(F.lit(m).alias("m"), _low("code", m).alias("code")) for m in orders]
    every = (
        counts.select(F.explode(F.array(*parts)).alias("g"), "n")
        .groupBy("g.m", "g.code")
        .agg(F.sum("n").alias("n"))
        .withColumn("context", F.shiftright("code", BITS))
    )
    every = cut_lineage(every)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    contexts = every.groupBy("m", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    kept = every.filter((F.col("m") <= 2) | (F.col("n") >= max(1.0, settings.floor * total)))
    kept = cut_lineage(kept.join(contexts, ["m", "context"]))
    # Every symbol is a gram of order 1, seen or not.
    first = {r.code: r for r in kept.filter("m = 1").collect()}
    rows = []
    for symbol in range(SYMBOLS):
        seen, p = first.get(symbol), 1 / SYMBOLS
        if first:
            types, of = (next(iter(first.values()))[c] for c in ("types", "total"))
            p = ((seen.n if seen else 0) + types / SYMBOLS) / (of + types)
        rows.append((symbol, seen.n if seen else 0, p))
    grams = {1: counts.sparkSession.createDataFrame(rows, "code long, n long, p double")}
    weights = []
    for m in orders[1:]:
        lower = grams[m - 1].select(F.col("code").alias("suffix"), F.col("p").alias("lower"))
        mixed = (F.col("n") + F.col("types") * F.col("lower")) / (F.col("total") + F.col("types"))
        own = kept.filter(F.col("m") == m).withColumn("suffix", _low("code", m - 1)).join(lower, "suffix")
        grams[m] = cut_lineage(own.select("code", "n", "context", "total", "types", "lower", mixed.alias("p")))
        taken = grams[m].groupBy("context").agg(
            F.sum("p").alias("taken"),
            F.sum("lower").alias("lower"),
            F.count("*").alias("arcs"),
            F.max("total").alias("total"),
            F.max("types").alias("types"),
        )
        # What all of a context's grams leave is known without a difference of nearly equal sums.
        left = F.greatest(1 - F.col("taken"), F.lit(1e-12)) / F.greatest(1 - F.col("lower"), F.lit(1e-12))
        whole = F.col("types") / (F.col("total") + F.col("types"))
        weight = F.when(F.col("arcs") == F.col("types"), whole).otherwise(left)
        weights.append(taken.select(F.lit(m).alias("m"), "context", weight.alias("weight")))
    return GramModel(grams, cut_lineage(reduce(DataFrame.unionAll, weights)), total)


def build_automaton(model: GramModel, settings: Settings = Settings()) -> Automaton:
    """The model's frequent grams as an automaton; those of one and two symbols are all in it."""
    codes, probability = {}, {}
    for m, grams in model.grams.items():
        often = F.lit(True) if m <= 2 else F.col("n") >= settings.arc_share * model.total
        rows = grams.filter(often).select("code", "p").toArrow()
        order = np.argsort(rows.column("code").to_numpy())
        codes[m], probability[m] = (rows.column(c).to_numpy()[order] for c in ("code", "p"))
    # States by length of context, the empty one first.
    states, first = {0: np.zeros(1, np.int64)}, {0: 0}
    for m in range(2, settings.order + 1):
        states[m - 1] = np.unique(codes[m] >> BITS)
        first[m - 1] = first[m - 2] + len(states[m - 2])
    n_states = first[settings.order - 1] + len(states[settings.order - 1])

    def longest(code: np.ndarray, length: int) -> np.ndarray:
        """The state of the longest suffix, of ``length`` symbols at most, that is a state."""
        out = np.zeros(len(code), np.int64)
        for k in range(1, length + 1):
            part = code & ((1 << BITS * k) - 1)
            at = np.minimum(np.searchsorted(states[k], part), max(len(states[k]) - 1, 0))
            found = states[k][at] == part if len(states[k]) else np.zeros(len(code), bool)
            out[found] = first[k] + at[found]
        return out

    fail = np.zeros(n_states, np.int64)
    keys, logp, target = [], [], []
    for m in range(1, settings.order + 1):
        own = first[m - 1] + np.searchsorted(states[m - 1], codes[m] >> BITS)
        keys.append((own << BITS) | (codes[m] & ((1 << BITS) - 1)))
        logp.append(np.log10(probability[m]))
        target.append(longest(codes[m], min(m, settings.order - 1)))
        if m > 1:
            fail[first[m - 1] : first[m - 1] + len(states[m - 1])] = longest(states[m - 1], m - 2)
    full = sum(map(len, keys[:-1]))
    keys, logp, target = map(np.concatenate, (keys, logp, target))
    start = int(longest(np.array([sum(START << BITS * i for i in range(settings.order - 1))]), settings.order - 1)[0])
    return Automaton(keys, _slots(keys), logp, target.astype(np.int32), fail.astype(np.int32), full, start)


def _hash(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).view(np.int64) & (size - 1)


def _slots(keys: np.ndarray) -> np.ndarray:
    """An open hash table of the arcs: the arc in each slot, -1 where there is none."""
    size = 1 << int(len(keys) * 4).bit_length()
    slots, at = np.full(size, -1, np.int32), _hash(keys, size)
    left = np.arange(len(keys), dtype=np.int32)
    while len(left):
        free = slots[at[left]] < 0
        slots[at[left[free]]] = left[free]  # of several one stays; the others try the next slot
        left = left[slots[at[left]] != left]
        at[left] = (at[left] + 1) & (size - 1)
    return slots


def _find(a: Automaton, keys: np.ndarray) -> np.ndarray:
    """The arc of each key, or -1."""
    size = len(a.slots)
    at = _hash(keys, size)
    out = a.slots[at]
    left = np.flatnonzero((out >= 0) & (a.keys[out] != keys))
    while len(left):
        at[left] = (at[left] + 1) & (size - 1)
        out[left] = a.slots[at[left]]
        left = left[(out[left] >= 0) & (a.keys[out[left]] != keys[left])]
    return out


def score_texts(
    a: Automaton, data: np.ndarray, offsets: np.ndarray, order: int, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In one traversal of each row from its start to its end, the log10 probability of the symbols
    that full arcs read; and of all others row, gram and how often it occurs there.

    Rows are cut into slices that are read side by side, a symbol at a time. As the state depends on
    the last ``order - 1`` symbols alone, a slice first reads those before it, unscored.
    """
    symbols, cuts = _with_ends(data, offsets)
    lengths = np.diff(cuts)
    pieces = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = cuts[row] + number * size
    stop = np.minimum(begin + size, cuts[row + 1])
    at = np.where(number > 0, np.maximum(begin - (order - 1), cuts[row]), begin)
    lanes = np.argsort(at - stop, kind="stable")  # the longest first, so that those at work lead
    begin, stop, at = begin[lanes], stop[lanes], at[lanes]
    steps = stop - at
    state = np.where(number[lanes] > 0, 0, a.start)
    # A slice that reaches back to its text's start begins as the text does.
    state[at == cuts[row[lanes]]] = a.start
    total, missed = np.zeros(len(lanes)), [np.zeros(0, np.int64)]
    for t in range(int(steps.max(initial=0))):
        n = int(np.searchsorted(-steps, -t, side="left"))
        symbol, now = symbols[at[:n] + t], state[:n]
        arc = _find(a, (now << BITS) | symbol)
        left = np.flatnonzero(arc < 0)
        now = now.copy()
        while len(left):
            now[left] = a.fail[now[left]]
            arc[left] = _find(a, (now[left] << BITS) | symbol[left])
            left = left[arc[left] < 0]
        state[:n] = a.target[arc]
        scored, known = at[:n] + t >= begin[:n], arc >= a.full
        total[:n] += np.where(scored & known, a.logp[arc], 0)
        missed.append(at[:n][scored & ~known] + t)
    places = np.sort(np.concatenate(missed))
    rows = row_of(places, cuts)
    codes = np.zeros(len(places), np.int64)
    for back in range(order):
        before = places - back
        codes |= np.where(before >= cuts[rows], symbols[before], START) << (BITS * back)
    by_code = np.lexsort((codes, rows))
    rows, codes = rows[by_code], codes[by_code]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])
    times = np.diff(np.append(np.flatnonzero(fresh), len(rows)))
    return np.bincount(row[lanes], weights=total, minlength=len(lengths)), rows[fresh], codes[fresh], times


class LanguageModel(NamedTuple):
    """What the training texts give: word counts and grams as tables, and the automaton."""

    words: DataFrame
    train_tokens: int
    distinct: int
    grams: GramModel
    automaton: Automaton
    settings: Settings


def train(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> LanguageModel:
    """Count all texts; a null text is empty and counts as its end alone."""
    ship_package(docs.sparkSession)
    counted = cut_lineage(count_corpus(docs, text, settings))
    words = counted.filter(F.col("kind") == WORD).select(F.col("code").alias("word"), "n")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    grams = gram_model(counted.filter(F.col("kind") == GRAM).select("code", "n"), settings)
    return LanguageModel(words, sums.n, sums.v, grams, build_automaton(grams, settings), settings)


def unseen_grams(codes: DataFrame, model: GramModel) -> DataFrame:
    """Rows (code, p) of grams that the model does not hold: failure arcs lead to one that it does.

    ``codes`` has distinct codes of the whole order. Grams of one and two symbols, and their contexts,
    are 66,563 rows at most, as there are 258 symbols: they go to the codes. Longer ones are joined.
    """
    orders = sorted(model.grams)
    short, long = orders[:2], orders[2:]
    parts = [
        F.struct(
            F.lit(m).alias("m"), _low("code", m).alias("gram"), F.shiftright(_low("code", m), BITS).alias("context")
        )
        for m in long
    ]
    levels = codes
    if long:
        asked = codes.select("code", F.inline(F.array(*parts)))
        held = [model.grams[m].select(F.lit(m).alias("m"), F.col("code").alias("gram"), "p") for m in long]
        found = asked.join(reduce(DataFrame.unionAll, held), ["m", "gram"], "left")
        found = found.join(model.failures.filter(F.col("m") > 2), ["m", "context"], "left")
        at = lambda c, m: F.max(F.when(F.col("m") == m, F.col(c))).alias(f"{c}{m}")
        levels = found.groupBy("code").agg(*(at(c, m) for m in long for c in ("p", "weight")))
    for m in short:
        grams = model.grams[m].select(F.col("code").alias("gram"), F.col("p").alias(f"p{m}"))
        levels = levels.join(F.broadcast(grams), _low("code", m) == F.col("gram"), "left").drop("gram")
        if m > 1:
            failed = model.failures.filter(F.col("m") == m).select("context", F.col("weight").alias(f"weight{m}"))
            context = F.shiftright(_low("code", m), BITS)
            levels = levels.join(F.broadcast(failed), context == F.col("context"), "left").drop("context")
    p = F.col("p1")
    for m in orders[1:]:
        p = F.coalesce(F.col(f"p{m}"), F.coalesce(F.col(f"weight{m}"), F.lit(1.0)) * p)
    return levels.select("code", p.alias("p"))


def score(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_tokens, n_known, train_tokens, base_score, score), one for each input row.

    ``score`` is the model's log10 probability of the whole text's bytes (A-Z lower-cased) and its
    end; ``base_score`` that of its words and end under add-0.1 smoothed word counts. A null
    text is empty. Repeated rows and null keys are scored each by itself; an empty table gives no
    rows; other columns are not read.

    Counts of the frequent words and the automaton of the frequent grams go along with the task; the
    other words and grams of all texts are joined with the written tables, and no one of them is
    frequent enough among the training texts to make a join uneven.
    """
    spark, s = docs.sparkSession, model.settings
    ship_package(spark)
    head = model.words.filter(F.col("n") >= max(1.0, s.head_share * model.train_tokens)).toArrow()
    order = np.argsort(head.column("word").to_numpy())
    frequent = [head.column(c).to_numpy()[order] for c in ("word", "n")]
    parts = spark.sparkContext.broadcast((*frequent, model.automaton))
    most = model.train_tokens + 0.1 * (model.distinct + 1)
    schema = docs.select(key).schema.add("row", "long").add("kind", "integer").add("code", "long")
    schema = schema.add("times", "long").add("n_tokens", "long")
    schema = schema.add("n_known", "long").add("base", "double").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, automaton = parts.value
        seen = TaskContext.get().partitionId() << 33
        for rows, data, offsets in text_blocks(batches, text, 2 << 20):
            n = rows.num_rows
            low = LOWER[data]
            starts, stops = word_bounds(low, offsets)
            hashes, row = signed(word_hashes(low, starts, stops)), row_of(starts, offsets)
            hashes = np.concatenate([hashes, np.full(n, END_WORD)])
            row = np.concatenate([row, np.arange(n)])
            at = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
            known = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
            gain = np.log10((counts[at[known]] + 0.1) / most) if known.any() else np.zeros(0)
            ids = np.arange(seen, seen + n)
            seen += n
            scores, holder, grams, times = score_texts(automaton, data, offsets, s.order, s.slice)
            rest = ~known
            take = np.concatenate([np.arange(n), row[rest], holder])
            none = np.zeros(len(take), bool)
            none[n:] = True
            first = lambda x: pa.array(np.concatenate([x, np.zeros(len(take) - n, x.dtype)]), mask=none)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(take)),
                    pa.array(ids[take]),
                    pa.array(np.repeat(np.array([OWN, WORD, GRAM], np.int32), [n, rest.sum(), len(grams)])),
                    # A text's own row asks for nothing; its id spreads it over the join.
                    pa.array(np.concatenate([ids, hashes[rest], grams])),
                    pa.array(np.concatenate([np.ones(n + rest.sum(), np.int64), times])),
                    first(np.bincount(row, minlength=n).astype(np.int64)),
                    first(np.bincount(row[known], minlength=n).astype(np.int64)),
                    first(np.bincount(row[known], weights=gain, minlength=n).astype(float)),
                    first(scores),
                ],
                names=schema.names,
            )

    found = cut_lineage(docs.select(key, text).mapInArrow(run, schema))
    held = model.grams.grams[s.order].select("code", "p")
    asked = found.filter(F.col("kind") == GRAM).select("code").distinct()
    unseen = unseen_grams(cut_lineage(asked.join(held, "code", "left_anti")), model.grams)
    answers = model.words.select(F.lit(WORD).alias("kind"), F.col("word").alias("code"), F.col("n").cast("double").alias("c"))
    for grams in (held, unseen):
        answers = answers.unionAll(grams.select(F.lit(GRAM), "code", "p"))
    joined = found.join(answers, ["kind", "code"], "left").withColumn("c", F.coalesce("c", F.lit(0.0)))
    word, gram = F.col("kind") == WORD, F.col("kind") == GRAM
    return joined.groupBy("row", key).agg(
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(word & (F.col("c") > 0), 1).otherwise(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.max("base") + F.sum(F.when(word, F.log10((F.col("c") + 0.1) / most)).otherwise(0.0))).alias("base_score"),
        (F.max("score") + F.sum(F.when(gram, F.col("times") * F.log10("c")).otherwise(0.0))).alias("score"),
    ).drop("row")
