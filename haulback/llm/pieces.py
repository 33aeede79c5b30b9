"""SentencePiece encoding and decoding, as best paths found by a max-plus scan.

A vocabulary of merges joins the best-scored adjacent pair first, wherever it stands; that is no path
problem as it is. But a segmentation is the merges' result exactly if every two neighbouring pieces
stay apart when merged on their own. So the arcs between two pieces get the weight 0 where they stay
apart and minus infinity where they do not, and the path of weight 0, of which there is one, is the
result. Being a path, it can be scanned in parallel: a giant document is cut into chunks anywhere,
each chunk gives a matrix from the pieces that can lie across its first cut to those across its
second, and with the pieces at its cuts known each chunk traces its own part back. Matrices multiply
associatively, a maximum of sums (``multiply``); here a document's are walked in order, in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from haulback.llm.arrays import _BASE, list_array, text_blocks
from haulback.llm.shipping import ship_package
from haulback.operators.lineage import cut_lineage

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of a chunk of a giant document.
CHUNK = 1 << 15
_SHORT = 48
_NEVER = np.int64(1) << np.int64(60)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MEMO = 1 << 20
#: Bytes of text encoded at a time, which bounds a task's memory.
_BLOCK = 1 << 19
_CACHED_WORDS = 1 << 19
#: Ids decoded at a time.
_DECODED = 1 << 18


class Vocabulary(NamedTuple):
    """Pieces by id, and how each grew: its spines are the parts that its first or last character
    went through, with the rank of the merge that made each."""

    ids: dict[str, int]
    keys: np.ndarray
    key_ids: np.ndarray
    slots: np.ndarray
    hashes: np.ndarray
    lengths: np.ndarray
    ranks: np.ndarray
    stable: np.ndarray
    right: np.ndarray
    right_times: np.ndarray
    left: np.ndarray
    left_times: np.ndarray
    byte_ids: np.ndarray
    bytes: np.ndarray
    byte_offsets: np.ndarray
    longest: int

    @property
    def unknown(self) -> int:
        return len(self.ranks)

    @property
    def start(self) -> int:
        return len(self.ranks) + 1


def _code_hash(text: str) -> np.uint64:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    powers = np.cumprod(np.full(len(codes), _BASE, np.uint64))
    return np.sum(codes * powers, dtype=np.uint64)


def _merge_tree(text: str, ranks: dict[str, int]) -> list[tuple[str, str, int]]:
    """The merges of a text in order: left part, right part, rank. The best pair goes first, then
    the leftmost."""
    parts, out = list(text), []
    while True:
        pairs = [(ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        best = min(pairs, default=(_NEVER, 0))
        if best[0] == _NEVER:
            return out
        rank, i = best
        out.append((parts[i], parts[i + 1], rank))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


_SLOT_BITS = 20
_NONE, _SHARED = -1, -2


def _slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _slots(keys: np.ndarray) -> np.ndarray:
    """Which key is in each slot; some slots are shared by several."""
    out = np.full(1 << _SLOT_BITS, _NONE, np.int32)
    at = _slot(keys)
    out[at] = np.arange(len(keys))
    out[np.flatnonzero(np.bincount(at, minlength=len(out)) > 1)] = _SHARED
    return out


def find_pieces(v: Vocabulary, hashes: np.ndarray) -> np.ndarray:
    """The id of the piece with each hash, or -1."""
    at = v.slots[_slot(hashes)]
    shared = np.flatnonzero(at == _SHARED)
    if len(shared):
        at[shared] = np.minimum(np.searchsorted(v.keys, hashes[shared]), len(v.keys) - 1)
    some = np.flatnonzero(at >= 0)
    out = np.full(len(hashes), -1, np.int64)
    some = some[v.keys[at[some]] == hashes[some]]
    out[some] = v.key_ids[at[some]]
    return out


@cache
def load_vocabulary(model: str = MODEL) -> Vocabulary:
    """The pieces of a SentencePiece model of merges, read where the driver runs."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model)
    n = m.get_piece_size()
    special = lambda i: m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)
    ids = {m.id_to_piece(i): i for i in range(n) if not special(i)}
    if any(SPACE in p.lstrip(SPACE) for p in ids):
        raise ValueError("a piece holds a space after another character")
    order = {s: r for r, s in enumerate(sorted({m.get_score(i) for i in ids.values()}, reverse=True))}
    ranks = {p: order[m.get_score(i)] for p, i in ids.items()}
    split: dict[str, tuple[str, str]] = {}
    stable = np.zeros(n, bool)
    for p, i in ids.items():
        merges = _merge_tree(p, ranks) if len(p) > 1 else []
        stable[i] = len(p) == 1 or bool(merges) and merges[-1][0] + merges[-1][1] == p
        if len(p) > 1 and stable[i]:
            split[p] = merges[-1][:2]
    times: dict[str, int] = {}

    def time(p: str) -> int:
        if p not in times:
            times[p] = max(ranks[p], *map(time, split[p])) if p in split else -1
        return times[p]

    def spine(p: str, side: int) -> list[str]:
        out = [p]
        while out[-1] in split:
            out.append(split[out[-1]][side])
        return out[::-1]

    longest = max(map(len, ids))
    spines = {side: np.full((n, longest + 1), -1, np.int32) for side in (0, 1)}
    at = {side: np.full((n, longest + 1), _NEVER, np.int64) for side in (0, 1)}
    for p, i in ids.items():
        if stable[i]:
            for side in (0, 1):
                parts = spine(p, side)
                spines[side][i, : len(parts)] = [ids.get(x, -1) for x in parts]
                at[side][i, : len(parts)] = [time(x) for x in parts]
    hashes, lengths, rank = np.zeros(n, np.uint64), np.ones(n + 2, np.int64), np.full(n, _NEVER)
    surface = [b""] * n
    byte_ids = np.full(256, -1, np.int64)
    for p, i in ids.items():
        hashes[i], lengths[i], rank[i] = _code_hash(p), len(p), ranks[p]
        surface[i] = p.replace(SPACE, " ").encode()
    for i in range(n):
        if m.is_byte(i):
            value = int(m.id_to_piece(i)[3:5], 16)
            byte_ids[value], surface[i] = i, bytes([value])
    named = np.array(sorted(ids.values()))
    named = named[np.argsort(hashes[named])]
    return Vocabulary(
        ids, hashes[named], named, _slots(hashes[named]), hashes, lengths, rank, stable,
        spines[1], at[1], spines[0], at[0], byte_ids,
        np.frombuffer(b"".join(surface), np.uint8), np.cumsum([0, *map(len, surface)]), longest,
    )


def stay_apart(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Do the pieces of each pair (a, b) stay apart when their characters are merged?

    Their parts at the boundary grow in the order of their merges; the pair stays apart if no join
    across the boundary is ever due before the next merge on either side. Of merges alike the
    leftmost goes first. After an unknown character, or at the start, a piece need only be stable.
    """
    out = np.zeros(len(a), bool)
    edge = a >= v.unknown
    out[edge] = v.stable[b[edge]]
    live = np.flatnonzero(~edge & v.stable[np.minimum(a, v.unknown - 1)] & v.stable[b])
    i, j = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
    while len(live):
        x, y = v.right[a[live], i], v.left[b[live], j]
        next_x, next_y = v.right_times[a[live], i + 1], v.left_times[b[live], j + 1]
        joined = v.hashes[x] + v.hashes[y] * _power(v.lengths[x])
        piece = find_pieces(v, joined)
        due = np.where(piece >= 0, v.ranks[piece], _NEVER)
        clash = (due < next_x) & (due <= next_y)
        done = ~clash & (next_x == _NEVER) & (next_y == _NEVER)
        out[live[done]] = True
        left_first = next_x <= next_y
        i, j = i + left_first, j + ~left_first
        go = ~clash & ~done
        live, i, j = live[go], i[go], j[go]
    return out


@lru_cache(4)
def _powers(n: int, inverse: bool = False) -> np.ndarray:
    out = np.full(n + 1, _INVERSE if inverse else _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_SMALL_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(64, _BASE, np.uint64)]))


def _power(n: np.ndarray) -> np.ndarray:
    return _SMALL_POWERS[n]


class Encoder:
    """Encodes words, and keeps what it has found of pairs and of words."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.memo_keys = np.full(_MEMO, -1, np.int64)
        self.memo = np.zeros(_MEMO, bool)
        self.known_chars = np.zeros(0x110000, bool)
        self.known_chars[[ord(p) for p in v.ids if len(p) == 1]] = True
        self.pair_cache: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.words = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * np.int64(1 << 20) + b
        at = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        new = np.flatnonzero(self.memo_keys[at] != keys)
        out = self.memo[at]
        if len(new):
            found, back = np.unique(keys[new], return_inverse=True)
            fresh = stay_apart(self.v, found >> 20, found & ((1 << 20) - 1))[back]
            self.memo_keys[at[new]] = keys[new]
            self.memo[at[new]] = fresh
            # Of several keys on one place the last is kept, so both must be set from one key.
            last = self.memo_keys[at[new]] == keys[new]
            self.memo[at[new][last]] = fresh[last]
            out[new] = fresh
        return out

    def one_apart(self, a: int, b: int) -> bool:
        key = (a, b)
        if key not in self.pair_cache:
            if len(self.pair_cache) > 1 << 20:
                self.pair_cache.clear()
            self.pair_cache[key] = bool(stay_apart(self.v, np.array([a]), np.array([b]))[0])
        return self.pair_cache[key]

    def chain(self, text: str) -> tuple[list[int], list[int]]:
        """By end position, the last piece of the text up to there, and the first piece of it."""
        v, get = self.v, self.v.ids.get
        last, first = [v.start], [v.start]
        for end in range(1, len(text) + 1):
            found = -1
            if text[end - 1] not in v.ids:
                found, size = v.unknown, 1
            else:
                for size in range(1, min(end, v.longest) + 1):
                    piece = get(text[end - size : end])
                    if piece is not None and last[end - size] >= 0 and self.one_apart(last[end - size], piece):
                        found = piece
                        break
            last.append(found)
            first.append(found if end == size else first[end - size] if found >= 0 else -1)
        return last, first

    def path(self, text: str, last: list[int], end: int) -> list[tuple[int, int]]:
        """The pieces of the path that ends there, in order: (start, id)."""
        out = []
        while end > 0:
            piece = last[end]
            end -= int(self.v.lengths[piece])
            out.append((end, piece))
        return out[::-1]

    def ids_of(self, text: str, path: list[tuple[int, int]]) -> list[int]:
        """Ids of a path; an unknown character is spelt by its bytes."""
        out = []
        for at, piece in path:
            if piece == self.v.unknown:
                out += self.v.byte_ids[list(text[at].encode())].tolist()
            else:
                out.append(piece)
        return out

    def _short_words(
        self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sums: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of similar lengths, side by side, and how many each word has."""
        v, n, most = self.v, len(starts), int(lengths.max())
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        last = np.full((n, most + 1), -1, np.int64)
        last[:, 0] = v.start
        inverse = _powers(1 << max(10, int(len(codes)).bit_length()), True)
        for end in range(1, most + 1):
            lanes = int(np.searchsorted(-lengths, -end, side="right"))
            for size in range(1, min(end, v.longest) + 1):
                at = starts[:lanes] + end - size
                part = (sums[at + size] - sums[at]) * inverse[at]
                piece = find_pieces(v, part)
                hit = np.flatnonzero((piece >= 0) & (last[:lanes, end - size] >= 0))
                if len(hit):
                    piece = piece[hit]
                    ok = self.apart(last[hit, end - size], piece)
                    last[hit[ok], end] = piece[ok]
        alone = np.flatnonzero((lengths == 1) & (last[:, 1] < 0))
        last[alone, 1] = v.unknown
        ends = np.zeros((n, most + 1), bool)
        lane, at = np.arange(n), lengths.copy()
        while len(lane):
            ends[lane, at] = True
            at = at - v.lengths[last[lane, at]]
            lane, at = lane[at > 0], at[at > 0]
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        last, ends = last[back], ends[back]
        return last[ends], ends.sum(1)

    def _new_words(
        self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sums: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        parts, owners = [], []
        for low, high in ((0, 4), (4, 8), (8, 16), (16, _SHORT)):
            own = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(own):
                pieces, counts = self._short_words(codes, starts[own], lengths[own], sums)
                parts.append(pieces)
                owners.append(np.repeat(own, counts))
        for i in np.flatnonzero(lengths > _SHORT).tolist():
            text = codes[starts[i] : starts[i] + lengths[i]].astype(np.uint32).tobytes().decode("utf-32-le")
            path = self.path(text, self.chain(text)[0], len(text))
            parts.append(np.array([p for _, p in path], np.int64))
            owners.append(np.full(len(path), i))
        ids, owner = np.concatenate(parts), np.concatenate(owners)
        strange = np.flatnonzero(ids == self.v.unknown)
        if len(strange):  # a word of its own: one character
            chars = [chr(c).encode() for c in codes[starts[owner[strange]]].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[strange] = list(map(len, chars))
            ids, owner = np.repeat(ids, counts), np.repeat(owner, counts)
            ids[ids == self.v.unknown] = self.v.byte_ids[list(b"".join(chars))]
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owner, minlength=len(starts))

    def encode(self, codes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of code points (spaces as pieces write them), and how many each row has.

        Pieces never span a space after another character, nor an unknown character, so rows fall
        into words that are encoded by themselves, each distinct one once.
        """
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(cuts) - 1, np.int64)
        space, strange = codes == ord(SPACE), ~self.known_chars[codes]
        first = strange.copy()
        first[1:] |= strange[:-1] | (space[1:] & ~space[:-1])
        first[cuts[:-1][cuts[:-1] < len(codes)]] = True
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(codes)))
        size = 1 << max(10, int(len(codes)).bit_length())
        values = (codes.astype(np.uint64) + np.uint64(1)) * _powers(size)[1 : len(codes) + 1]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values)])
        # Starts are hashed as if at the front; lengths tell words that end in the least character.
        names = (sums[starts + lengths] - sums[starts]) * _powers(size, True)[starts]
        found, example, back = np.unique(names, return_index=True, return_inverse=True)
        if len(self.words) > _CACHED_WORDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.words, found), max(len(self.words) - 1, 0))
        new = self.words[at] != found if len(self.words) else np.ones(len(found), bool)
        if new.any():
            ids, counts = self._new_words(codes, starts[example[new]], lengths[example[new]], sums)
            first_new = len(self.store) + np.cumsum(counts) - counts
            self.store = np.concatenate([self.store, ids])
            words = np.concatenate([self.words, found[new]])
            order = np.argsort(words)
            self.words = words[order]
            self.first = np.concatenate([self.first, first_new])[order]
            self.count = np.concatenate([self.count, counts])[order]
        at = np.searchsorted(self.words, found)[back]
        count = self.count[at]
        total = int(count.sum())
        take = np.arange(total) + np.repeat(self.first[at] - np.cumsum(count) + count, count)
        per_word = np.concatenate([[0], np.cumsum(count)])
        return self.store[take], np.diff(per_word[np.searchsorted(starts, cuts)])


def _code_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the rows as pieces write them: a space first, unless a row is empty."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    codes = np.where(codes == 32, np.uint32(ord(SPACE)), codes)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    cuts = before[offsets]
    some = np.diff(cuts) > 0
    return np.insert(codes, cuts[:-1][some], ord(SPACE)), cuts + np.concatenate([[0], np.cumsum(some)])


def _written(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


class State(NamedTuple):
    """A piece across a cut: where it starts and ends, counted from the cut, and its id."""

    start: int
    end: int
    piece: int


def cut_states(v: Vocabulary, text: str, at: int) -> list[State]:
    """The pieces that can lie across a cut, or start there."""
    out = []
    for start in range(max(0, at - v.longest + 1), at + 1):
        for end in range(at + 1, min(len(text), start + v.longest) + 1):
            piece = v.ids.get(text[start:end])
            if piece is not None:
                out.append(State(start - at, end - at, piece))
    if text[at] not in v.ids:
        out.append(State(0, 1, v.unknown))
    return out


class Chunk(NamedTuple):
    """A stretch of a document with what surrounds it: ``begin`` and ``end`` bound it in ``text``."""

    text: str
    begin: int
    end: int
    opens: bool
    closes: bool


def _breaks(v: Vocabulary, c: Chunk) -> tuple[int, int] | None:
    """The first and last place in a chunk where a word must start; None without any."""
    places = (
        i
        for i in range(c.begin + 1, c.end + 1)
        if i < len(c.text) and (
            (c.text[i] == SPACE and c.text[i - 1] != SPACE) or c.text[i] not in v.ids or c.text[i - 1] not in v.ids
        )
    )
    first = next(places, None)
    if first is None:
        return None
    for i in range(min(c.end, len(c.text) - 1), first, -1):
        if (c.text[i] == SPACE and c.text[i - 1] != SPACE) or c.text[i] not in v.ids or c.text[i - 1] not in v.ids:
            return first, i
    return first, first


_EDGE = State(0, 0, -1)


def _ways_in(c: Chunk, v: Vocabulary) -> list[State]:
    return [_EDGE] if c.opens else cut_states(v, c.text, c.begin)


def _ways_out(c: Chunk, v: Vocabulary) -> list[State]:
    return [_EDGE] if c.closes else cut_states(v, c.text, c.end)


def transfer(e: Encoder, c: Chunk) -> list[tuple[State, State]]:
    """The chunk's matrix: the pairs of states at its cuts that a path of weight 0 connects."""
    out = []
    ways_out = _ways_out(c, e.v)
    broken = _breaks(e.v, c)
    if broken:
        # Words between two breaks are on every path, so the matrix is one column times one row.
        ends = []
        last, _ = e.chain(c.text[broken[1] : c.end + e.v.longest])
        for s in ways_out:
            end = c.end + s.end - broken[1]
            if c.end + s.start >= broken[1] and (end == 0 or last[end] == s.piece or s.piece < 0):
                ends.append(s)
        for s in _ways_in(c, e.v):
            start = c.begin + s.start
            _, first = e.chain(c.text[start : broken[0]])
            if s.piece < 0 or (c.begin + s.end <= broken[0] and first[-1] == s.piece):
                out += [(s, t) for t in ends]
        return out
    by_start: dict[int, list[State]] = {}
    for s in _ways_in(c, e.v):
        by_start.setdefault(s.start, []).append(s)
    for start, states in by_start.items():
        last, first = e.chain(c.text[c.begin + start : c.end + e.v.longest])
        for t in ways_out:
            end = c.end + t.end - c.begin - start
            if t.piece < 0 or (end < len(last) and last[end] == t.piece):
                out += [(s, t) for s in states if s.piece < 0 or first[end] == s.piece]
    return out


Matrix = list[tuple[State, State]]


def multiply(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product of two matrices of weights 0 and minus infinity."""
    after: dict[State, set[State]] = {}
    for s, t in b:
        after.setdefault(s, set()).add(t)
    return list({(s, u) for s, t in a for u in after.get(t, ())})


def boundary_states(matrices: list[Matrix]) -> list[State]:
    """The states before, between and after the chunks of a document on its one path.

    Products of the matrices from either end meet at each cut in a single state.
    """
    ahead = [{_EDGE}]
    for m in matrices:
        ahead.append({t for s, t in m if s in ahead[-1]})
    behind = [{_EDGE}]
    for m in reversed(matrices):
        behind.append({s for s, t in m if t in behind[-1]})
    out = []
    for a, b in zip(ahead, reversed(behind), strict=True):
        (state,) = a & b
        out.append(state)
    return out


def trace_edges(e: Encoder, c: Chunk, before: State, after: State) -> tuple[list[int], str, list[int]]:
    """With the pieces at a chunk's cuts known: ids of those that start before its first break, the
    text from there to its last break, whose words are encoded by themselves, and ids after it."""
    broken = _breaks(e.v, c)
    start, end = c.begin + before.start, c.end + after.end
    first, last = broken or (end, end)
    head, tail = c.text[start:first], c.text[last:end]
    path = [(start + at, p) for at, p in e.path(head, e.chain(head)[0], len(head))]
    path += [(last + at, p) for at, p in e.path(tail, e.chain(tail)[0], len(tail))]
    own = [(at, p) for at, p in path if c.begin <= at < c.end]
    parts = [e.ids_of(c.text, [x for x in own if (x[0] < first) == early]) for early in (True, False)]
    return parts[0], c.text[first:last], parts[1]


def trace_chunks(e: Encoder, found: list[tuple[Chunk, State, State]]) -> list[np.ndarray]:
    """Ids of the pieces that start in each chunk; the words of all chunks are encoded together."""
    edges = [trace_edges(e, *x) for x in found]
    middles = [middle for _, middle, _ in edges]
    codes = np.frombuffer("".join(middles).encode("utf-32-le"), np.uint32)
    ids, counts = e.encode(codes, np.cumsum([0, *map(len, middles)]))
    inner = np.split(ids, np.cumsum(counts)[:-1]) if middles else []
    parts = [(np.array(h, np.int32), x, np.array(t, np.int32)) for (h, _, t), x in zip(edges, inner, strict=True)]
    return [np.concatenate(p) for p in parts]


def cut_document(text: str, longest: int, chunk: int) -> list[Chunk]:
    """The chunks of a document, each with the characters that a piece across its cuts can reach."""
    text = _written(text)
    out = []
    for begin in range(0, len(text), chunk):
        end = min(begin + chunk, len(text))
        low, high = max(0, begin - longest), min(len(text), end + longest)
        out.append(Chunk(text[low:high], begin - low, end - low, begin == 0, end == len(text)))
    return out


def _encode_short(docs: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    schema = docs.select(key).schema.add("ids", ArrayType(IntegerType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for rows, data, offsets in text_blocks(batches, text, _BLOCK):
            ids, counts = encoder.encode(*_code_rows(data, offsets))
            yield pa.RecordBatch.from_arrays([rows.column(0), list_array(ids, counts, pa.int32())], names=schema.names)

    return docs.select(key, text).mapInArrow(encode, schema)


_MATRIX = "array<struct<a:array<int>,b:array<int>>>"
_CHUNK_COLUMNS = ["row", "k", "body", "begin", "stop", "opens", "closes"]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 16) -> Iterator[pa.RecordBatch]:
    """A few rows at a time: chunks are long, and more so as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _chunk_of(r: dict) -> Chunk:
    return Chunk(r["body"], r["begin"], r["stop"], r["opens"], r["closes"])


def _encode_giant(docs: DataFrame, key: str, text: str, vocabulary, chunk: int) -> DataFrame:
    """Ids of documents longer than a chunk: cut, transfer, combine, trace; each over all chunks."""
    longest = vocabulary.value.longest
    key_type = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, body in enumerate(batch.column(2)):
                chunks = cut_document(body.as_py(), longest, chunk)
                same = pa.array([i] * len(chunks))
                columns = [batch.column(0).take(same), batch.column(1).take(same), pa.array(range(len(chunks)))]
                columns += [pa.array(column) for column in zip(*chunks, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *_CHUNK_COLUMNS])

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in _slices(batches):
            rows = batch.to_pylist()
            found = [[{"a": list(s), "b": list(t)} for s, t in transfer(encoder, _chunk_of(r))] for r in rows]
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            columns = [batch.column("row"), batch.column("k"), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "k", "matrix"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                matrices = [
                    [(State(*x["a"]), State(*x["b"])) for x in m["matrix"]]
                    for m in sorted(r["matrices"], key=lambda m: m["k"])
                ]
                states = [list(s) for s in boundary_states(matrices)]
                n = len(matrices)
                kind = pa.list_(pa.int32())
                arrays = [pa.array([r["row"]] * n), pa.array(range(n)), pa.array(states[:-1], kind), pa.array(states[1:], kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "k", "before", "after"])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in _slices(batches):
            rows = [(_chunk_of(r), State(*r["before"]), State(*r["after"])) for r in batch.to_pylist()]
            found = trace_chunks(encoder, rows)
            ids = list_array(np.concatenate(found), np.array([len(x) for x in found]), pa.int32())
            columns = [batch.column("row"), batch.column("key"), batch.column("k"), ids]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "k", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("body"))
    schema = f"key {key_type}, row long, k long, body string, begin long, stop long, opens boolean, closes boolean"
    chunks = cut_lineage(rows.mapInArrow(cut, schema))
    # Chunks of a document are spread over the tasks again.
    spread = chunks.repartition("row", "k")
    matrices = spread.mapInArrow(transfers, f"row long, k long, matrix {_MATRIX}")
    whole = matrices.groupBy("row").agg(F.collect_list(F.struct("k", "matrix")).alias("matrices"))
    states = whole.mapInArrow(combine, "row long, k long, before array<int>, after array<int>")
    placed = chunks.join(states, ["row", "k"])
    traced = placed.mapInArrow(trace, f"row long, key {key_type}, k long, ids array<int>")
    joined = traced.groupBy("row", "key").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return joined.select(F.col("key").alias(key), F.flatten("parts.ids").alias("ids"))


def encode(
    docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Rows (key, ids): the SentencePiece ids of each whole text, one for each input row.

    A null or empty text has no ids. Texts longer than ``chunk`` characters are scanned in chunks;
    the ids are the same. Characters outside the vocabulary are spelt by their bytes. Repeated rows
    and null keys are encoded each by itself; an empty table gives no rows; other columns are not
    read. The vocabulary, a file of fixed size, is read by the driver and sent to the tasks.
    """
    ship_package(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    giant = F.coalesce(F.length(text) > chunk, F.lit(False))
    docs = docs.select(key, text)
    short = _encode_short(docs.filter(~giant), key, text, vocabulary)
    return short.unionByName(_encode_giant(docs.filter(giant), key, text, vocabulary, chunk))


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of each row's ids; null ids give the empty text.

    The result of ``encode`` decodes to the text itself, except that a U+2581 in it, which pieces
    write for a space, becomes a space. Bytes that are no UTF-8 become U+FFFD.
    """
    ship_package(encoded.sparkSession)
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    encoded = encoded.drop(text)
    schema = encoded.select("*").schema.add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        sizes = np.diff(v.byte_offsets)
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column(batch.schema.get_field_index(ids)))
            total = np.cumsum(np.nan_to_num(lengths.to_numpy(zero_copy_only=False)).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                start = at
                before = total[start - 1] if start else 0
                at = max(start + 1, int(np.searchsorted(total, before + _DECODED, side="right")))
                part = batch.slice(start, at - start)
                column = part.column(part.schema.get_field_index(ids))
                flat = column.flatten().to_numpy(zero_copy_only=False)
                counts = np.nan_to_num(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
                n = sizes[flat]
                take = np.arange(int(n.sum())) + np.repeat(v.byte_offsets[flat] - np.cumsum(n) + n, n)
                body = v.bytes[take].tobytes()
                ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
                texts = [body[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]
                texts = [x[1:] if x.startswith(" ") else x for x in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
