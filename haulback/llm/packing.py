"""Best-fit packing of token sequences after a dominance reduction.

Lengths are whole numbers up to the capacity, so an instance of any size is a histogram of at most
``capacity`` numbers, and a plan for it is made of lengths and of how often, never of single pieces:

1. *Reduction* (Martello and Toth). A set of pieces that holds one piece and fills a sequence
   dominates another such set if the other's pieces can be shared out among its pieces, each at
   least as long as what it stands for. A set that dominates every feasible set of its first piece
   belongs to some best packing and is fixed for good; sets of at most three pieces are tried. As
   pieces only go, what dominates once goes on to do so, and is fixed as often as its pieces last.
   The instance shrinks until no piece has such a set.
2. *Best fit* for the remainder, longest pieces first: each goes to the fullest sequence that takes it.

Both work on runs of equal sequences: a layer of the plan says that the pieces of one length from a
rank on go, so many each, to consecutive sequences at one offset. A length's pieces split at most one
run of each kind, so the layers are bounded by the capacity, whatever the table. Spark ranks the
pieces of a length by counts of each stored partition and looks every piece's layer up.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from haulback.llm.arrays import word_bounds, word_hashes
from haulback.llm.shipping import ship_package
from haulback.operators.lineage import cut_lineage

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 4096
END = 1
#: Bytes of a text that are encoded at a time; words whose ids a task remembers, those of a run.
_SLICE = 1 << 21
_REMEMBERED = 1 << 19
_RUN = 1 << 15
_LONG_WORD = 256
_SPACES = b" \t\n\x0b\x0c\r"
_LETTERS = "".join(c for c in map(chr, [*range(0x41, 0x7B), *range(0xC0, 0x100)]) if c.isalpha())
_MARKS = ".,;:!?"
_PLAIN = re.compile(f"([{_LETTERS}]+)([{_MARKS}]{{0,2}})")
_ROW, _PART, _RANK = "_row", "_part", "_rank"
_RANK_BITS = 48


class Layers(NamedTuple):
    """Runs of pieces: their length, first rank and number; first sequence, pieces in each, offset."""

    length: np.ndarray
    first: np.ndarray
    number: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray


class _Plan:
    """Layers as they are laid; ranks of a length and sequences are handed out in order."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.used: dict[int, int] = defaultdict(int)
        self.sequences = 0

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def lay(self, length: int, each: int, sequence: int, n: int, offset: int) -> None:
        self.rows.append((length, self.used[length], n * each, sequence, each, offset))
        self.used[length] += n * each

    def layers(self) -> Layers:
        table = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        return Layers(*table.T)


def dominating_set(left: np.ndarray, length: int) -> tuple[int, ...] | None:
    """Lengths of a set with a piece of ``length`` that dominates all others it is in, if one is found.

    ``left`` counts the pieces by length, up to the capacity; the piece itself is among them.
    """
    room = len(left) - 1 - length
    left = left[: room + 1].copy()
    if length <= room:
        left[length] -= 1
    fits = np.flatnonzero(left)
    if not len(fits):
        return (length,)
    top = int(fits[-1])
    if top == room:  # whatever else goes along is no longer than this one piece
        return length, top
    small = np.repeat(fits[:3], np.minimum(left[fits[:3]], 3))[:3].cumsum()
    if len(small) < 2 or small[1] > room:  # one other piece at most
        return length, top
    if len(small) == 3 and small[2] <= room:
        return None
    # Two others at most: the longest piece that goes along with each.
    below = np.zeros(room + 1, np.int64)
    below[fits] = fits
    below = np.maximum.accumulate(below)
    other = below[room - fits]
    other = np.where((other == fits) & (left[fits] < 2), below[fits - 1], other)
    paired = other > 0
    if not paired.any() or top >= int((fits + other)[paired].max()):
        return length, top
    # The longest piece that is the shorter one of some pair: with ``top`` it outdoes every pair.
    above = np.append(fits[1:], room + 1)
    partner = np.where(left[fits] > 1, fits, above)
    second = int(fits[fits + partner <= room].max())
    if top + second <= room and (top != second or left[top] > 1):
        return length, top, second
    return None


def _reduce(left: np.ndarray, plan: _Plan) -> None:
    """Fix dominating sets until there is none; ``left`` keeps the pieces that remain."""
    changed = True
    while changed:
        changed = False
        for length in np.flatnonzero(left)[::-1].tolist():
            while left[length] and (found := dominating_set(left, length)):
                each = {x: found.count(x) for x in found}
                times = min(int(left[x]) // n for x, n in each.items())
                sequence, offset = plan.open(times), 0
                for x, n in each.items():
                    plan.lay(x, n, sequence, times, offset)
                    left[x] -= n * times
                    offset += x * n
                changed = True


def _best_fit(left: np.ndarray, plan: _Plan) -> None:
    """The remaining pieces, longest first, each to the fullest sequence that takes it."""
    capacity = len(left) - 1
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room: first sequence, how many
    some = np.zeros(capacity + 1, bool)

    def keep(room: int, sequence: int, n: int) -> None:
        if n and room:
            runs[room].append((sequence, n))
            some[room] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        pieces = int(left[length])
        while pieces:
            fitting = np.flatnonzero(some[length:])
            if len(fitting):
                room = length + int(fitting[0])
                sequence, n = runs[room].pop()
                some[room] = bool(runs[room])
            else:
                room, n = capacity, -(-pieces // (capacity // length))
                sequence = plan.open(n)
            each = room // length
            full = min(n, pieces // each)
            if full:
                plan.lay(length, each, sequence, full, capacity - room)
                keep(room - each * length, sequence, full)
            pieces -= full * each
            if full < n and pieces:
                plan.lay(length, pieces, sequence + full, 1, capacity - room)
                keep(room - pieces * length, sequence + full, 1)
                pieces, full = 0, full + 1
            keep(room, sequence + full, n - full)
        left[length] = 0


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Layers:
    """The layers for so many pieces of each length, ordered by length and rank."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = _Plan()
    _reduce(left, plan)
    _best_fit(left, plan)
    return plan.layers()


def sequences(layers: Layers) -> int:
    """How many sequences a plan has."""
    return int((layers.sequence + layers.number // layers.each).max(initial=0))


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing has fewer sequences: the bound L2 of Martello and Toth.

    For a length t, pieces over capacity - t are alone but for pieces under t, those over half stand
    apart from each other, and what of the pieces from t on does not fit beside the latter needs more.
    """
    n = np.zeros(capacity + 1, np.int64)
    for length, k in counts.items():
        n[length] = k
    many, total = np.append(0, n.cumsum()), np.append(0, (n * np.arange(capacity + 1)).cumsum())
    between = lambda sums, a, b: int(sums[b + 1] - sums[a])
    best, half = 0, capacity // 2
    for t in range(half + 1):
        alone, apart = between(many, capacity - t + 1, capacity), between(many, half + 1, capacity - t)
        room = apart * capacity - between(total, half + 1, capacity - t)
        best = max(best, alone + apart + max(0, -(-(between(total, t, half) - room) // capacity)))
    return best


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The rows with sequence_id and offset (both long), packed into few sequences of ``capacity``.

    Offsets in a sequence start at 0 and leave no gap. Rows of equal length are ranked as they lie in
    the written table. Every row is a piece of its own, repeated rows and rows of nulls included. A
    length that is null, below 1 or above the capacity is an error. An empty table gives no rows; a
    column ``sequence_id`` or ``offset`` is replaced, and columns ``_row``, ``_part``, ``_n``, ``_before``,
    ``_own`` and ``_rank`` are the operator's own. Columns go along, so leave out long ones and join
    them by a key. The plan that goes to all tasks is bounded by the capacity.
    """
    ship_package(items.sparkSession)
    items = items.drop("sequence_id", "offset")
    columns = items.columns
    stored = cut_lineage(items.withColumn(_ROW, F.monotonically_increasing_id()))
    stored = stored.withColumn(_PART, F.shiftright(_ROW, 33))
    valid = F.when(F.col(length).between(1, capacity), F.col(length).cast("int")).otherwise(0)
    found = stored.groupBy(valid.alias("length")).agg(F.count("*").alias("n")).collect()
    counts = {r.length: r.n for r in found}
    if 0 in counts:
        raise ValueError(f"{counts[0]} rows have a length outside 1 to {capacity}")
    layers = plan_packing(counts, capacity)
    before = Window.partitionBy(length).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(length, _PART)
        .agg(F.count("*").alias("_n"))
        .select(length, _PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(length, _PART).orderBy(_ROW)
    ranked = stored.withColumn("_own", F.row_number().over(inside)).join(starts, [length, _PART])
    ranked = ranked.select(*columns, (F.col("_before") + F.col("_own") - 1).alias(_RANK))
    return _placed(ranked, layers, length, columns)


def _placed(ranked: DataFrame, layers: Layers, length: str, columns: list[str]) -> DataFrame:
    keys = (layers.length << _RANK_BITS) + layers.first
    own = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    schema = StructType([*ranked.select(*columns).schema, *own])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            column = lambda name: rows.column(rows.schema.get_field_index(name)).to_numpy().astype(np.int64)
            size, rank = column(length), column(_RANK)
            at = np.searchsorted(keys, (size << _RANK_BITS) + rank, side="right") - 1
            beside = rank - layers.first[at]
            sequence = layers.sequence[at] + beside // layers.each[at]
            offset = layers.offset[at] + beside % layers.each[at] * size
            arrays = [*(rows.column(i) for i in range(len(columns))), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return ranked.mapInArrow(place, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class _Words:
    """Ids of words. A vocabulary that drops white space takes words one by one.

    Equal words of some texts are found by 64-bit hashes and looked up once. Words not met lately are
    encoded together, a run at a time. Where the vocabulary takes letters one by one and sets marks
    apart (``_plain_letters``), a word of letters goes to its merges directly, whatever the marks
    after it. Two generations are remembered: when the newer is full, the older goes, so words in use
    stay and the memory is bounded.
    """

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        self.tokenizer = Tokenizer.from_str(model)
        self.letters = _plain_letters(self.tokenizer)
        self.marks: dict[str, bytes] = {}
        self.fresh: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        body = b"".join(texts)
        data, offsets = np.frombuffer(body, np.uint8), np.cumsum([0, *map(len, texts)])
        starts, ends = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        values, place, word = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._known(values.tolist(), body, starts[place].tolist(), ends[place].tolist())
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = (np.cumsum(lengths) - lengths)[word]
        lengths = lengths[word]
        total = np.cumsum(np.append(0, lengths))
        at = np.arange(total[-1]) + np.repeat(first - total[:-1], lengths)
        ids = np.frombuffer(b"".join(known), "<u4")[at]
        cuts = total[np.searchsorted(starts, offsets)].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _known(self, keys: list[int], body: bytes, starts: list[int], ends: list[int]) -> list[bytes]:
        """The ids of distinct words, given by their hash and a place where each stands."""
        known = list(map(self.fresh.get, keys))
        plain: list[tuple[int, str, str]] = []
        others: list[tuple[int, str]] = []
        for i, ids in enumerate(known):
            if ids is not None:
                continue
            if (ids := self.older.get(keys[i])) is not None:
                known[i] = self.fresh[keys[i]] = ids
                continue
            word = body[starts[i] : ends[i]].decode()
            if self.letters and (parts := _PLAIN.fullmatch(word)):
                plain.append((i, parts[1].translate(self.letters), parts[2]))
            else:
                others.append((i, word))
        stems: dict[str, bytes] = {}
        tokenize = self.tokenizer.model.tokenize
        for i, stem, marks in plain:
            if (ids := stems.get(stem)) is None:
                ids = stems[stem] = array("I", [token.id for token in tokenize(stem)]).tobytes()
            known[i] = ids + self._marks(marks) if marks else ids
        for (i, _), ids in zip(others, self._encoded([word for _, word in others]), strict=True):
            known[i] = ids
        for i in [*(i for i, _, _ in plain), *(i for i, _ in others)]:
            if ends[i] - starts[i] <= _LONG_WORD:
                self.fresh[keys[i]] = known[i]
        if len(self.fresh) >= _REMEMBERED:
            self.older, self.fresh = self.fresh, {}
        return known

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word, from runs of words between spaces."""
        start = size = 0
        for i, word in enumerate(words):
            size += len(word)
            if size < _RUN and i + 1 < len(words):
                continue
            run = words[start : i + 1]
            encoded = self.tokenizer.encode(" ".join(run), add_special_tokens=False)
            at = np.fromiter((a for a, _ in encoded.offsets), np.int64)
            cuts = (4 * np.searchsorted(at, np.cumsum([0, *(len(word) + 1 for word in run)]))).tolist()
            ids = np.array(encoded.ids, "<u4").tobytes()
            yield from (ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
            start, size = i + 1, 0

    def _marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            ids = self.tokenizer.encode(marks, add_special_tokens=False).ids
            self.marks[marks] = np.array(ids, "<u4").tobytes()
        return self.marks[marks]


def _plain_letters(tokenizer: Tokenizer) -> dict[int, str] | None:
    """What a vocabulary's merges get for each Latin letter, if it turns words into that letter by
    letter, sets marks apart, and has no added token of letters and marks; else nothing."""
    normal, split = tokenizer.normalizer, tokenizer.pre_tokenizer
    if normal is None or split is None:
        return None
    cut = lambda text: [part for part, _ in split.pre_tokenize_str(normal.normalize_str(text))]
    letters = {ord(c): "".join(cut(c)) for c in _LETTERS}
    added = tokenizer.get_added_tokens_decoder().values()
    plain = cut(_LETTERS + _MARKS) == ["".join(letters.values()), _MARKS]
    return letters if plain and not any(set(token.content) <= set(_LETTERS + _MARKS) for token in added) else None


@lru_cache(1)
def _words(model: str) -> _Words:
    return _Words(model)


def slices(body: bytes, size: int = _SLICE) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes, cut where white space stands, so in no word."""
    start = 0
    while len(body) - start > size:
        end = start + size
        cut = max(body.rfind(s, start, end) for s in (_SPACES[i : i + 1] for i in range(len(_SPACES))))
        if cut <= start:  # a word longer than a slice
            later = [p for i in range(len(_SPACES)) if (p := body.find(_SPACES[i : i + 1], end)) >= 0]
            cut = min(later, default=len(body))
        yield body[start:cut]
        start = cut
    yield body[start:]


Piece = tuple[object, int, int, int, bytes]


def text_pieces(texts: Iterable[tuple[object, bytes]], words: _Words, capacity: int, end: int) -> Iterator[Piece]:
    """Of each keyed text, its ids and ``end`` in pieces of ``capacity`` ids, the last of which may be
    shorter: key, number, ids before, length, ids."""
    last = np.array([end], "<u4")
    piece, held = 0, last[:0]
    for key, ids, ended in _encoded(texts, words):
        held = np.concatenate([held, ids, last] if ended else [held, ids])
        whole = len(held) if ended else len(held) - len(held) % capacity
        for i in range(0, whole, capacity):
            part = held[i : i + capacity]
            yield key, piece, piece * capacity, len(part), part.tobytes()
            piece += 1
        piece, held = (0, last[:0]) if ended else (piece, held[whole:])


def _encoded(texts: Iterable[tuple[object, bytes]], words: _Words) -> Iterator[tuple[object, np.ndarray, bool]]:
    """Keys and ids of slices in order, and whether each is its text's last; many are encoded at once."""
    held: list[tuple[object, bytes, bool]] = []
    size = 0
    for key, body in texts:
        parts = list(slices(body))
        for i, part in enumerate(parts):
            held.append((key, part, i + 1 == len(parts)))
            size += len(part)
            if size >= _SLICE:
                yield from _flush(held, words)
                held, size = [], 0
    yield from _flush(held, words)


def _flush(held: list[tuple[object, bytes, bool]], words: _Words) -> Iterator[tuple[object, np.ndarray, bool]]:
    for (key, _, ended), ids in zip(held, words.ids([part for _, part, _ in held]), strict=True):
        yield key, ids, ended


def encode_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    end: int = END,
) -> DataFrame:
    """Rows (key, piece int, start long, length long, ids binary): each text's ids, then ``end``, cut
    into pieces of at most ``capacity``; ``start`` counts the text's ids before the piece.

    ``ids`` are little-endian unsigned 32-bit. The vocabulary is a file of the ``tokenizers`` library
    that drops white space, so that words can be encoded one by one; the library does that, with no
    special tokens added. A null or empty text has the one id ``end``. Texts are encoded a slice at a
    time, however long; a single word is one slice. Rows that repeat another are documents of their
    own; a null key is kept. An empty table gives no rows, and other columns are not read.
    """
    ship_package(docs.sparkSession)
    model = Path(tokenizer or default_tokenizer()).read_text(encoding="utf-8")
    fields = "piece int, start long, length long, ids binary"
    docs = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    names = ["key", "piece", "start", "length", "ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(model)
        for rows in batches:
            out: list[Piece] = []
            size = 0
            bodies = (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in rows.column(1))
            for found in text_pieces(zip(rows.column(0).to_pylist(), bodies, strict=True), words, capacity, end):
                out.append(found)
                size += len(found[-1])
                if size >= _SLICE:
                    yield _batch(out, rows.schema.field(0).type, names)
                    out, size = [], 0
            if out:
                yield _batch(out, rows.schema.field(0).type, names)

    return docs.mapInArrow(encode, f"key {kind}, {fields}").withColumnRenamed("key", key)


def _batch(out: list[Piece], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [key, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **encoding: str) -> DataFrame:
    """Rows (key, piece, start, length, ids, sequence_id, offset): the pieces of ``encode_pieces``,
    each with its place. A sequence's ids are those of its pieces in the order of their offsets."""
    return pack(encode_pieces(docs, capacity, **encoding), "length", capacity)
