"""Windows of a fixed length that occur earlier in the corpus, found exactly from a sample of places.

A window is ``window`` consecutive symbols of one text: words or bytes. Of the grams in a window the
one of least hash is its anchor, so equal windows have equal anchors at equal places, and about one
symbol in ``(window - gram) / 2`` is an anchor of some windows: those it *owns*, a contiguous range.
The string that the owned windows cover is the anchor's context. So three cases exhaust all windows:

* a context that occurs earlier: all of the anchor's windows do, too;
* a context that occurs for the first time, whose gram occurs in no other context: none of them do;
* a first context whose gram stands in other contexts as well: its windows are compared one by one.

The first two are decided by one aggregation over the anchors; the third concerns the edges of
repeated passages. Symbols, grams, contexts and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from haulback.llm.arrays import _BASE, _mixed, gram_hashes, signed, sliding_min, text_blocks
from haulback.llm.numbering import number_texts
from haulback.llm.shipping import ship_package
from haulback.operators.lineage import cut_lineage

#: Symbols of a block of texts, as 64-bit values, and the bounds of the texts in them.
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_MERGE = 1 << 21
#: A first context is compared, and is so by the way for grams of very many contexts.
COMPARE, MANY = 1, 2
BITS = 2


class Scheme(NamedTuple):
    symbols: Symbols
    window: int
    gram: int
    block_bytes: int = 1 << 20
    #: From this many contexts on, a gram's windows are compared by an aggregation over the cluster.
    many: int = 10_000


class Anchors(NamedTuple):
    """By anchor: its row, its place, its first window and their number; hashes of gram and context."""

    row: np.ndarray
    place: np.ndarray
    start: np.ndarray
    count: np.ndarray
    gram: np.ndarray
    context: np.ndarray


@lru_cache(2)
def _powers(inverse: bool, size: int) -> np.ndarray:
    out = np.full(size, _INVERSE if inverse else _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def find_anchors(
    values: np.ndarray, cuts: np.ndarray, scheme: Scheme, contexts: bool = True
) -> Anchors:
    """The anchors of a block; places and starts are counted from the block's first symbol.

    Without ``contexts`` these are left out, for a reader who has their marks.
    """
    n, w = len(values) - scheme.window + 1, scheme.window - scheme.gram + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, none, none)
    grams = gram_hashes(values, scheme.gram)
    keys = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
    row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))[:n]
    starts = np.flatnonzero(np.arange(n) + scheme.window <= cuts[1:][row])
    place = (sliding_min(keys, w)[starts] & _LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
    count = np.diff(np.append(first, len(place)))
    place, start = place[first], starts[first]
    if not contexts:
        none = np.zeros(0, np.int64)
        return Anchors(row[start], place, start, count, none, none)
    size = 1 << max(16, int(len(values)).bit_length())
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(False, size)[: len(values)], out=sums[1:])
    covered = sums[start + count - 1 + scheme.window] - sums[start]
    inverse = _powers(True, size)
    shape = (place - start).astype(np.uint64) * np.uint64(1 << 20) + count.astype(np.uint64)
    context = _mixed(covered * inverse[start] + _mixed(shape))
    return Anchors(row[start], place, start, count, signed(grams[place]), signed(context))


class _Firsts:
    """The first place of each context among those seen, handed out when there are many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(self._merged([columns]))
        self.size += len(self.parts[-1][0])

    @staticmethod
    def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        gram, context, doc, place = map(np.concatenate, zip(*parts, strict=True))
        order = np.lexsort((place, doc, context))
        fresh = np.ones(len(order), bool)
        fresh[1:] = context[order][1:] != context[order][:-1]
        order = order[fresh]
        return gram[order], context[order], doc[order], place[order]

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            columns = self._merged(self.parts)
            for i in range(0, len(columns[0]), 1 << 16):
                arrays = [pa.array(c[i : i + (1 << 16)]) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "context", "doc", "place"])
        self.parts, self.size = [], 0


def first_contexts(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """Rows (doc, marks): of each text of ``docs`` (doc, text) the anchors whose context is a first.

    A mark is an anchor's place, counted in the text, above two bits that say how to compare it.
    Copies meet in the tasks that read them, so a context is sent once from each.
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = _Firsts()
        for rows, data, offsets in text_blocks(batches, "text", scheme.block_bytes):
            values, cuts = scheme.symbols(data, offsets)
            found = find_anchors(values, cuts, scheme)
            doc = rows.column(0).to_numpy(zero_copy_only=False)[found.row]
            firsts.add(found.gram, found.context, doc, (found.place - cuts[found.row]).astype(np.int64))
            if firsts.size > _MERGE:
                yield from firsts.take()
        yield from firsts.take()

    found = docs.filter("doc IS NOT NULL").mapInArrow(anchors, "gram long, context long, doc long, place long")
    firsts = (
        found.repartition("gram")
        .groupBy("gram", "context")
        .agg(F.min("doc").alias("doc"), F.min_by("place", "doc").alias("place"))
    )
    alike = F.count("*").over(Window.partitionBy("gram"))
    how = F.when(alike >= scheme.many, COMPARE + MANY).when(alike > 1, COMPARE).otherwise(0)
    mark = F.shiftleft("place", BITS).bitwiseOR(how)
    return firsts.select("doc", mark.alias("mark")).groupBy("doc").agg(F.collect_list("mark").alias("marks"))


def marked_anchors(
    data: np.ndarray, offsets: np.ndarray, marks: pa.Array, scheme: Scheme
) -> tuple[np.ndarray, np.ndarray, Anchors, np.ndarray]:
    """A block's symbols, bounds, anchors, and the mark bits of each anchor; -1 where it has none."""
    values, cuts = scheme.symbols(data, offsets)
    found = find_anchors(values, cuts, scheme, contexts=False)
    counts = np.nan_to_num(pa.compute.list_value_length(marks).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = marks.flatten().to_numpy()
    owner = np.repeat(np.arange(len(counts)), counts)
    places = cuts[owner] + (flat >> BITS)
    order = np.argsort(places, kind="stable")
    places, bits = places[order], (flat & ((1 << BITS) - 1))[order]
    at = np.minimum(np.searchsorted(places, found.place), max(len(places) - 1, 0))
    hit = places[at] == found.place if len(places) else np.zeros(len(found.place), bool)
    out = np.full(len(found.place), -1, np.int64)
    out[hit] = bits[at[hit]]
    return values, cuts, found, out


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The windows of some anchors, one after the other."""
    return np.arange(int(counts.sum())) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def own_windows(
    values: np.ndarray, cuts: np.ndarray, found: Anchors, own: np.ndarray, docs: pa.Array, scheme: Scheme
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of some of a block's anchors: hash, text and start in the text."""
    starts = _spread(found.start[own], found.count[own])
    row = np.repeat(found.row[own], found.count[own])
    hashes = signed(gram_hashes(values, scheme.window)[starts])
    return hashes, docs.to_numpy(zero_copy_only=False)[row], starts - cuts[row]


def window_rows(marked: DataFrame, scheme: Scheme, bits: tuple[int, ...]) -> DataFrame:
    """Rows (hash, doc, start) of the windows of the anchors with one of these marks."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text", scheme.block_bytes):
            marks = rows.column(2)
            values, cuts, found, how = marked_anchors(data, offsets, marks, scheme)
            own = np.isin(how, bits)
            if not own.any():
                continue
            arrays = map(pa.array, own_windows(values, cuts, found, own, rows.column(0), scheme))
            yield pa.RecordBatch.from_arrays(list(arrays), names=["hash", "doc", "start"])

    return marked.mapInArrow(windows, "hash long, doc long, start long")


def later_windows(windows: DataFrame) -> DataFrame:
    """Rows (doc, start, count) of all windows but the first of each hash.

    The firsts are aggregated before they are sent; the join back splits a hash of very many windows.
    """
    firsts = windows.groupBy("hash").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")
    )
    # A window that stands alone has nothing to be compared with.
    some = firsts.filter("n > 1").select("hash", "first")
    later = windows.join(some, "hash").filter(F.struct("doc", "start") != F.col("first"))
    return later.select("doc", "start", F.lit(1).cast("long").alias("count"))


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The texts with the marks of their anchors; a text without any has none."""
    joined = docs.join(marks.withColumnRenamed("doc", "of"), F.col("doc") == F.col("of"), "left")
    return joined.select("doc", "text", "marks")


Resolve = Callable[[DataFrame, Scheme], DataFrame]


def removed_symbols(
    values_count: int, cuts: np.ndarray, found: Anchors, how: np.ndarray, later: pa.Array, scheme: Scheme
) -> np.ndarray:
    """Which symbols of a block are covered by a window that occurs earlier."""
    steps = np.zeros(values_count + 1, np.int64)
    repeated = how < 0
    starts, counts = found.start[repeated], found.count[repeated]
    lengths = np.nan_to_num(pa.compute.list_value_length(later).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = later.flatten()
    more = flat.field("start").to_numpy() + cuts[np.repeat(np.arange(len(lengths)), lengths)]
    starts = np.concatenate([starts, more])
    counts = np.concatenate([counts, flat.field("count").to_numpy()])
    ends = np.minimum(starts + counts - 1 + scheme.window, values_count)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    scheme: Scheme,
    resolve: Resolve,
    output: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[pa.Array]],
    schema: str,
    key: str,
    text: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows (key, *schema, *carry): what ``output`` makes of each text and of its symbols to be removed.

    ``output`` gets a block's bytes, their offsets, the removed symbols and the texts' bounds in
    them. A text without a key takes no part in the comparison and keeps all. Several texts of one
    key are texts of their own, in the order of ``number_texts``. Columns of ``carry`` go along
    unchanged.
    """
    ship_package(docs.sparkSession)
    carried = [docs[c].alias(f"_{i}") for i, c in enumerate(carry)]
    whole = docs.select(docs[key].cast("long").alias("doc"), docs[text].alias("text"), *carried)
    whole = number_texts(whole).rows
    docs = whole.select("doc", "text")
    marks = cut_lineage(first_contexts(docs, scheme))
    later = cut_lineage(resolve(with_marks(docs.filter("doc IS NOT NULL"), marks), scheme))
    by_doc = later.groupBy("doc").agg(F.collect_list(F.struct("start", "count")).alias("later"))
    notes = marks.join(by_doc, "doc", "left")
    joined = whole.join(notes.withColumnRenamed("doc", "of"), F.col("doc") == F.col("of"), "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text", scheme.block_bytes):
            values, cuts, found, how = marked_anchors(data, offsets, rows.column(2), scheme)
            how[rows.column(0).is_null().to_numpy(zero_copy_only=False)[found.row]] = 0
            gone = removed_symbols(len(values), cuts, found, how, rows.column(3), scheme)
            arrays = [rows.column(4), *output(data, offsets, gone, cuts), *rows.columns[5:]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    own = ["doc", *(part.split()[0] for part in schema.split(", "))]
    kept = [f"_{i}" for i in range(len(carry))]
    names = [*own, *kept]
    out_schema = StructType([*_parse_datatype_string(f"doc long, {schema}"), *whole.select(*kept).schema])
    found = joined.select("doc", "text", "marks", "later", "_key", *kept).mapInArrow(finish, out_schema)
    return found.toDF(key, *own[1:], *carry)


