"""Benchmark decontamination: greedy string tiling of documents by benchmark items."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.llm.arrays import LOWER, gram_hashes, text_blocks, word_bounds, word_hashes
from haulback.llm.shipping import ship_package


class Settings(NamedTuple):
    #: Words of a seed, which is also the shortest match.
    seed: int = 3
    #: A document holds an item if its matches cover this share of the item's words.
    coverage: float = 0.5
    #: Characters of the items that are compared at a time, which bounds what tasks are sent.
    item_chars: int = 4 << 20


class Items(NamedTuple):
    """Items of a block: keys, words one item after the other, and their seeds sorted by hash."""

    keys: list
    words: np.ndarray
    cuts: np.ndarray
    seeds: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    sieve: np.ndarray


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _within(cuts: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of ``k`` words that lie within one row, and the row of each."""
    row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))[: max(n - k + 1, 0)]
    inside = np.flatnonzero(np.arange(len(row)) + k <= cuts[1:][row]) if len(row) else row
    return inside, row[inside]


_SIEVE = 1 << 22


def _sieve(seeds: np.ndarray) -> np.ndarray:
    return (seeds >> np.uint64(42)).astype(np.int64)


def index_items(keys: list, texts: pa.Array, seed: int) -> Items:
    from haulback.llm.arrays import text_bytes

    words, cuts = _words(*text_bytes(texts))
    inside, owner = _within(cuts, len(words), seed)
    seeds = gram_hashes(words, seed)[inside]
    order = np.argsort(seeds, kind="stable")
    sieve = np.zeros(_SIEVE, bool)
    sieve[_sieve(seeds)] = True
    return Items(keys, words, cuts, seeds[order], owner[order], (inside - cuts[owner])[order], sieve)


class Runs(NamedTuple):
    """Maximal runs of shared seeds along a diagonal: document place, item place, words."""

    place: np.ndarray
    there: np.ndarray
    size: np.ndarray


def seed_runs(place: np.ndarray, there: np.ndarray, seed: int) -> Runs:
    """The runs that shared seeds form which follow each other in the document and in the item."""
    order = np.lexsort((place, place - there))
    place, there = place[order], there[order]
    opens = np.ones(len(place), bool)
    opens[1:] = (place[1:] != place[:-1] + 1) | (there[1:] != there[:-1] + 1)
    heads = np.flatnonzero(opens)
    return Runs(place[heads], there[heads], np.diff(np.append(heads, len(place))) + seed - 1)


def _joined(parts: list[Runs], seed: int) -> Runs:
    """Runs that were cut where one part of a document ended, put together again."""
    place, there, size = map(np.concatenate, zip(*parts, strict=True))
    order = np.lexsort((place, place - there))
    place, there, size = place[order], there[order], size[order]
    seeds = size - seed + 1
    opens = np.ones(len(place), bool)
    opens[1:] = (place[1:] - there[1:] != place[:-1] - there[:-1]) | (place[1:] != place[:-1] + seeds[:-1])
    heads = np.flatnonzero(opens)
    return Runs(place[heads], there[heads], np.add.reduceat(seeds, heads) + seed - 1 if len(heads) else size)


def tile(doc_words: int, item_words: int, runs: Runs, least: int) -> list[tuple[int, int, int]]:
    """Matches (document place, item place, words) of a greedy string tiling.

    The longest run whose words are all free is marked, of several the one at the earlier place. A
    run that has lost words is divided into the stretches still free, which wait for their turn by
    their own length, until none of ``least`` words is left. So each run is looked at as often as a
    match cuts into it, and not again in every round.
    """
    used_doc, used_item = np.zeros(doc_words, bool), np.zeros(item_words, bool)
    open_item = np.zeros(item_words + 1, np.int64)
    np.add.at(open_item, runs.there, 1)
    np.add.at(open_item, runs.there + runs.size, -1)
    open_item = np.cumsum(open_item)[:-1] > 0
    tiles: list[tuple[int, int, int]] = []
    order = np.lexsort((runs.there, runs.place, -runs.size))
    whole = zip((-runs.size[order]).tolist(), runs.place[order].tolist(), runs.there[order].tolist(), strict=True)
    waiting: list[tuple[int, int, int]] = []
    head = next(whole, None)
    while head or waiting:
        if head and (not waiting or head < waiting[0]):
            (size, p, q), head = head, next(whole, None)
        else:
            size, p, q = heappop(waiting)
        free = ~(used_doc[p : p - size] | used_item[q : q - size])
        if free.all():
            used_doc[p : p - size] = used_item[q : q - size] = True
            tiles.append((p, q, -size))
            if not (open_item & ~used_item).any():
                break
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= least:
                heappush(waiting, (a - b, p + a, q + a))
    return tiles


def _block_matches(
    words: np.ndarray, cuts: np.ndarray, items: Items, s: Settings
) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, words of the item, words covered, longest match) of the rows that hold an item."""
    grams = gram_hashes(words, s.seed)
    inside, row = _within(cuts, len(words), s.seed)
    hit = np.flatnonzero(items.sieve[_sieve(grams[inside])])
    hashes, at, row = grams[inside[hit]], inside[hit], row[hit]
    low = np.searchsorted(items.seeds, hashes, side="left")
    count = np.searchsorted(items.seeds, hashes, side="right") - low
    some = count > 0
    hashes, at, row, low, count = (x[some] for x in (hashes, at, row, low, count))
    # All matches lie under shared seeds, so what those cover bounds a tiling from above. A seed that
    # a document repeats counts once for it.
    order = np.lexsort((hashes, row))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    first = order[fresh]
    seeds = _spread(low[first], count[first])
    sizes = np.diff(items.cuts)
    pair = np.repeat(row[first].astype(np.int64), count[first]) * len(sizes) + items.owner[seeds]
    under = np.unique(np.concatenate([pair * (1 << 32) + items.place[seeds] + k for k in range(s.seed)]))
    pairs, covered = np.unique(under >> 32, return_counts=True)
    likely = pairs[covered >= s.coverage * sizes[pairs % len(sizes)]]
    for key in likely.tolist():
        r, i = divmod(key, len(sizes))
        mine = slice(*np.searchsorted(row, [r, r + 1]).tolist())
        n_doc, n_item = int(cuts[r + 1] - cuts[r]), int(sizes[i])
        runs = _runs_with(items, i, at[mine] - cuts[r], low[mine], count[mine], s.seed)
        tiles = tile(n_doc, n_item, runs, s.seed)
        covered = sum(n for _, _, n in tiles)
        if covered >= s.coverage * n_item:
            yield r, i, n_item, covered, max(n for _, _, n in tiles)


def _spread(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The seeds of some stretches of an index, one after the other."""
    return np.arange(int(count.sum())) + np.repeat(low - np.cumsum(count) + count, count)


#: Pairs of a document's and an item's places that are held at a time.
_PAIRS = 1 << 20


def _runs_with(items: Items, item: int, place: np.ndarray, low: np.ndarray, count: np.ndarray, seed: int) -> Runs:
    """The runs of a document's seeds with those of one item, found for some places at a time."""
    parts = [seed_runs(place[:0], place[:0], seed)]
    total = np.cumsum(count)
    start = 0
    while start < len(place):
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + _PAIRS, side="right")))
        seeds = _spread(low[start:end], count[start:end])
        own = items.owner[seeds] == item
        parts.append(seed_runs(np.repeat(place[start:end], count[start:end])[own], items.place[seeds][own], seed))
        start = end
    return _joined(parts, seed)


def find_contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Rows (key, item_key, item_words, covered, longest): the documents that hold an item's words.

    A greedy string tiling of the whole document by the item covers at least ``coverage`` of the
    item's words (A-Z lower-cased) with matches of ``seed`` words or more, whatever their order in
    the document. Items of fewer words cannot be matched. Long texts that repeat a few words meet an
    item that does so along their diagonals, some places at a time. Rows without a document key or an item
    key, and null texts, match nothing; repeated rows give one result. Other columns are not read.

    Items are a query set: they are compared with all documents in blocks of ``item_chars``, so what
    a task is sent does not grow with their number.
    """
    s = settings
    ship_package(docs.sparkSession)
    named = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).filter("doc IS NOT NULL AND text IS NOT NULL")
    asked = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("body")).filter(
        "item IS NOT NULL AND body IS NOT NULL"
    )
    total = asked.agg(F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-total // s.item_chars))
    fields = named.schema["doc"].dataType.simpleString(), asked.schema["item"].dataType.simpleString()
    schema = f"doc {fields[0]}, item {fields[1]}, item_words long, covered long, longest long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block).orderBy("item").toArrow()
        indexed = index_items(own.column("item").to_pylist(), own.column("body").combine_chunks(), s.seed)
        sent = docs.sparkSession.sparkContext.broadcast(indexed)

        def match(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for rows, data, offsets in text_blocks(batches, "text"):
                found = list(_block_matches(*_words(data, offsets), sent.value, s))
                if found:
                    r, i, *rest = zip(*found, strict=True)
                    columns = [
                        rows.column(0).take(pa.array(r)),
                        pa.array([sent.value.keys[x] for x in i]),
                        *(pa.array(x, pa.int64()) for x in rest),
                    ]
                    names = ["doc", "item", "item_words", "covered", "longest"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        if len(own):
            out = out.unionByName(named.mapInArrow(match, schema))
    return out.distinct().withColumnsRenamed({"doc": key, "item": item_key})
