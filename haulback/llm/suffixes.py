"""Repeated byte strings by sorted suffixes, in buckets between sampled splitters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulback.llm.arrays import BYTE_VALUES, gram_hashes, text_blocks
from haulback.llm.repeats import COMPARE, MANY, Scheme, later_windows, marked_anchors, own_windows, remove_repeats
from haulback.operators.lineage import cut_lineage

LENGTH = 100
#: Suffixes that are sorted at a time; suffixes with equal leading bytes stay together.
SORTED_TOGETHER = 16_384
_TOKENS = 4


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[data], offsets


def multikey_sort(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by their tokens, and the run of equal rows that each row in it belongs to.

    Token by token: rows that are alike so far form a segment, and only segments of several rows are
    sorted by the next token.
    """
    n = len(tokens[0])
    order, run = np.arange(n), np.zeros(n, np.int64)
    open_rows = np.arange(n)
    for token in tokens:
        if not len(open_rows):
            break
        rows = order[open_rows]
        sub = np.lexsort((token[rows], run[open_rows]))
        order[open_rows] = rows[sub]
        value, segment = token[rows[sub]], run[open_rows]
        fresh = np.ones(len(open_rows), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (segment[1:] != segment[:-1])
        # A segment's first row keeps its place as the segment's name, so names stay in order.
        run[open_rows] = open_rows[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        alone = fresh & np.append(fresh[1:], True)
        open_rows = open_rows[~alone]
    return order, run


def _suffix_rows(marked: DataFrame, scheme: Scheme) -> DataFrame:
    """Rows (lead, doc, start, count, context, hash) of the anchors to compare: the bytes of their
    windows, and the gram at the anchor that leads its suffix.

    The windows of a gram of very many contexts are rows of their own, known by a hash.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text", scheme.block_bytes):
            values, cuts, found, how = marked_anchors(data, offsets, rows.column(2), scheme)
            names = ["lead", "doc", "start", "count", "context", "hash"]
            many = how == COMPARE + MANY
            if many.any():
                hashes, doc, start = own_windows(values, cuts, found, many, rows.column(0), scheme)
                none = [pa.nulls(len(hashes), t) for t in (pa.binary(), pa.int64())]
                arrays = [none[0], pa.array(doc), pa.array(start), none[1], none[0], pa.array(hashes)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            own = np.flatnonzero(how == COMPARE)
            if not len(own):
                continue
            body = data.tobytes()
            place, start, count = found.place[own], found.start[own], found.count[own]
            stop = (start + count - 1 + scheme.window).tolist()
            leads = [body[a : a + scheme.gram] for a in place.tolist()]
            contexts = [body[a:b] for a, b in zip(start.tolist(), stop, strict=True)]
            doc = rows.column(0).to_numpy(zero_copy_only=False)[found.row[own]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(leads, pa.binary()),
                    pa.array(doc),
                    pa.array(start - cuts[found.row[own]]),
                    pa.array(count),
                    pa.array(contexts, pa.binary()),
                    pa.nulls(len(own), pa.int64()),
                ],
                names=names,
            )

    schema = "lead binary, doc long, start long, count long, context binary, hash long"
    return marked.mapInArrow(rows_of, schema)


def _later_in_bucket(bucket: pa.Table, length: int) -> pa.RecordBatch:
    """Sort the suffixes of a bucket that start a window, and return the later ones of each run."""
    doc, start, count = (bucket.column(c).to_numpy() for c in ("doc", "start", "count"))
    context = bucket.column("context").combine_chunks()
    offsets = np.frombuffer(context.buffers()[1], np.int32)[context.offset : context.offset + len(context) + 1]
    data = np.frombuffer(context.buffers()[2], np.uint8)
    block = length // _TOKENS
    blocks = [block] * (_TOKENS - 1) + [length - block * (_TOKENS - 1)]
    first = np.cumsum(count) - count
    inner = np.arange(int(count.sum())) - np.repeat(first, count)
    at = np.repeat(offsets[:-1].astype(np.int64), count) + inner
    hashes = {b: gram_hashes(BYTE_VALUES[data], b) for b in set(blocks)}
    tokens = [hashes[b][at + i * block] for i, b in enumerate(blocks)]
    docs, starts = np.repeat(doc, count), np.repeat(start, count) + inner
    order, run = multikey_sort(tokens)
    # Neighbours in a run are equal; of them the earliest stays, as often as its text is repeated.
    ranked = np.lexsort((starts[order], docs[order], run))
    order, run = order[ranked], run[ranked]
    heads = np.concatenate([[True], run[1:] != run[:-1]])
    head = order[heads][np.cumsum(heads) - 1]
    later = (docs[order] != docs[head]) | (starts[order] != starts[head])
    gone = np.sort(order[later])
    # Consecutive windows of a context as one row.
    owner = np.repeat(np.arange(len(count)), count)[gone]
    fresh = np.ones(len(gone), bool)
    fresh[1:] = (gone[1:] != gone[:-1] + 1) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(gone)))
    arrays = [pa.array(docs[gone[heads]]), pa.array(starts[gone[heads]]), pa.array(sizes.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc", "start", "count"])


def _sort_buckets(suffixes: DataFrame, length: int) -> DataFrame:
    """Rows (doc, start, count) of the later windows among suffixes.

    Splitters sampled from the leading bytes cut the suffixes into ranges; equal leads share one, so
    no window has an equal beyond a boundary. A range is read in order of its leads and sorted in
    buckets that end between two leads.
    """

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < SORTED_TOGETHER:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            leads = table.column("lead")
            last = leads[size - 1]
            low, high = 0, size - 1  # the first row of the last lead, which may go on
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if leads[middle] == last else (middle + 1, high)
            if low:
                yield _later_in_bucket(table.slice(0, low).combine_chunks(), length)
            held, size = table.slice(low).to_batches(), size - low
        if size:
            yield _later_in_bucket(pa.Table.from_batches(held).combine_chunks(), length)

    ranges = suffixes.repartitionByRange("lead").sortWithinPartitions("lead")
    return ranges.mapInArrow(later, "doc long, start long, count long")


def _compare_suffixes(marked: DataFrame, scheme: Scheme) -> DataFrame:
    found = cut_lineage(_suffix_rows(marked, scheme))
    many = later_windows(found.filter("hash IS NOT NULL").select("hash", "doc", "start"))
    suffixes = found.filter("hash IS NULL").drop("hash")
    return _sort_buckets(suffixes, scheme.window).unionByName(many)


def _kept_bytes(data: np.ndarray, offsets: np.ndarray, gone: np.ndarray, cuts: np.ndarray) -> list[pa.Array]:
    body, stay = data.tobytes(), data[~gone].tobytes()
    ends = np.concatenate([[0], np.cumsum(~gone)])[cuts]
    removed = np.diff(cuts) - np.diff(ends)
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    edges = cuts[:-1][cuts[:-1] < len(gone)]
    first[edges] = gone[edges]
    spans = np.diff(np.concatenate([[0], np.cumsum(first)])[cuts])
    kept = [
        stay[ends[i] : ends[i + 1]] if removed[i] else body[offsets[i] : offsets[i + 1]]
        for i in range(len(offsets) - 1)
    ]
    return [pa.array(np.diff(cuts)), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())]


def remove_strings(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_bytes, n_removed, n_spans, kept): each text without its repeated byte strings.

    A byte goes if it lies in ``length`` bytes of UTF-8 that also start earlier: in a text of smaller
    key, or before in the same text. ``kept`` (binary) holds the other bytes, which need not be valid
    UTF-8; ``n_spans`` counts the maximal removed runs. A null text is empty. Keys are long integers.
    Rows that repeat key and text are one text and each return its result; different texts under one
    key are texts of their own, of which the one whose text has the smaller 64-bit hash is the
    earlier. A text without a key is returned whole, and is no earlier place for others. Texts shorter than
    ``length`` lose nothing; an empty table gives no rows; other columns are not read.
    """
    scheme = Scheme(_bytes, length, max(1, length * 8 // 25))
    schema = "n_bytes long, n_removed long, n_spans long, kept binary"
    return remove_repeats(docs, scheme, _compare_suffixes, _kept_bytes, schema, key, text)
