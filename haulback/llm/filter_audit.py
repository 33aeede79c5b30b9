"""What each of several filters removes in every order, from one walk over all sets of filters.

A document's failures are one mask, and documents are counted in cells by part and mask. The sets of
active filters are walked in Gray-code order, which toggles one filter at a time: each mask holds a
counter of the active filters it fails, and when a toggle takes that from 0 or back to 0, the mask's
cell leaves or rejoins the running survivors. The survivors of all sets are stored, 32 for five
filters; a step of any order is then the difference of two of them. So the texts are read once, and
the orders cost nothing that grows with the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.llm.arrays import release_memory
from haulback.llm.packing import slices
from haulback.llm.shipping import ship_package
from haulback.operators.lineage import cut_lineage

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PCT = 80
MAX_CAPITALS_PCT = 10
SYMBOLS = b"#$%&*|"
MEASURES = ("documents", "good", "toxic")
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS) + b"]")
_BATCH = 1 << 12


def text_failures(body: bytes) -> int:
    """Which of the filters A to D a text fails, as bits from the lowest: too few words, too few
    distinct ones, too many capitals, a symbol."""
    n, words = 0, set()
    for part in slices(body):  # so a very long text never stands as a list of its words
        found = part.split()
        n += len(found)
        words.update(found)
    capitals = len(body) - len(body.translate(None, _UPPER))
    chars = len(body.translate(None, _CONTINUED))
    tests = (
        n < MIN_WORDS,
        100 * len(words) < MIN_DISTINCT_PCT * n,
        100 * capitals > MAX_CAPITALS_PCT * chars,
        _SYMBOL.search(body) is not None,
    )
    return sum(failed << i for i, failed in enumerate(tests))


def failure_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Rows (key, part, mask): the filters that each document fails, as bits.

    Filter E, the bit of 16, is failed by a text that a smaller key holds as well; texts are compared
    by 128-bit digests. A null text is empty and a null part the empty string. A document without a
    key is never a copy of a smaller one and makes no other a copy. Rows that repeat a key are
    documents of their own; those with one key and one text are no copies of each other.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(
        docs[key].cast("long").alias("key"),
        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
        docs[text].alias("text"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                rows = batch.slice(start, _BATCH)
                digests, masks = [], []
                for x in rows.column(2):
                    body = x.as_buffer().to_pybytes() if x.is_valid else b""
                    digests.append(blake2b(body, digest_size=16).digest())
                    masks.append(text_failures(body))
                arrays = [rows.column(0), rows.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "part", "digest", "mask"])
        release_memory()

    judged = cut_lineage(docs.mapInArrow(judge, "key long, part string, digest binary, mask int"))
    # Copies are folded where they are read; a text's least key is one row, whatever their number.
    firsts = judged.groupBy(F.col("digest").alias("_digest")).agg(F.min("key").alias("_first"))
    same = (F.col("digest") == F.col("_digest")) & (F.col("key") == F.col("_first"))
    copy = F.col("key").isNotNull() & F.col("_first").isNull()
    mask = F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    marked = judged.join(firsts, same, "left")
    return marked.select(F.col("key").alias(key), F.col("part").alias(part), mask.alias("mask"))


def count_cells(masks: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "lang") -> DataFrame:
    """Rows (part, mask, documents, good, toxic): documents by part and mask, and of them those that
    ``labels`` (key, quality, toxic) calls good (quality 1) or toxic (toxic 1).

    A key with several labels is good or toxic if one of them says so.
    """
    says = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int")).alias(f"_{c}")
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    known = known.agg(says("quality"), says("toxic")).filter("_quality + _toxic > 0")
    joined = masks.join(known, masks[key] == known["_key"], "left")
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long")
    sums = [F.count("*").alias("documents"), total("_quality").alias("good"), total("_toxic").alias("toxic")]
    return joined.groupBy(F.col(part).alias("part"), "mask").agg(*sums)


def survivors_of_all_sets(cells: np.ndarray) -> np.ndarray:
    """From cells (..., 2^n), by mask, the survivors (..., 2^n) of every set of active filters."""
    size = cells.shape[-1]
    masks = np.arange(size)
    failing = np.zeros(size, np.int64)  # how many active filters each mask fails
    running = cells.sum(axis=-1)
    out = np.empty_like(cells)
    active = 0
    out[..., active] = running
    for step in range(1, size):
        toggled = step & -step  # the one bit in which the Gray codes of step - 1 and step differ
        active ^= toggled
        met = (masks & toggled) > 0
        if active & toggled:
            failing[met] += 1
            running = running - cells[..., met & (failing == 1)].sum(axis=-1)
        else:
            failing[met] -= 1
            running = running + cells[..., met & (failing == 0)].sum(axis=-1)
        out[..., active] = running
    return out


def audit_cells(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, one row for each order of the filters and each step of it, zeros included.

    Columns: part, filter_order, step (from 1), kept, removed, redundant (failing the step's filter,
    removed earlier), unique_fails (failing no other), good_lost, toxic_lost, and shapley (its
    filter's removed, summed over all orders). No cells give no rows.
    """
    ship_package(cells.sparkSession)
    size = 1 << len(filters)
    packed = F.struct("mask", *MEASURES)
    # At most 2^n cells a part.
    by_part = cells.groupBy("part").agg(F.collect_list(packed).alias("cells"))
    orders = list(permutations(range(len(filters))))
    bits = 1 << np.array(orders)  # of each order's steps
    active = np.cumsum(bits, axis=1) - bits
    names = ["".join(filters[i] for i in order) for order in orders]
    labels = np.repeat(names, len(filters)).tolist()
    steps = np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(orders))
    bits, active, which = bits.ravel(), active.ravel(), np.array(orders).ravel()
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    fails = np.array([[(m >> i) & 1 for m in range(size)] for i in range(len(filters))])

    def rows_of(found: list[dict]) -> list[np.ndarray]:
        table = np.zeros((len(MEASURES), size), np.int64)
        for cell in found:
            table[:, cell["mask"]] += [cell[m] for m in MEASURES]
        stored = survivors_of_all_sets(table)
        lost = stored[:, active] - stored[:, active | bits]
        removed = lost[0]
        shapley = np.bincount(which, removed, len(filters)).astype(np.int64)
        failing = fails @ table[0]
        alone = table[0][bits]
        return [stored[0, active | bits], removed, failing[which] - removed, alone, lost[1], lost[2], shapley[which]]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [pa.array([part] * len(steps)), pa.array(labels), pa.array(steps), *map(pa.array, rows_of(found))]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", *counts])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in counts)
    return by_part.mapInArrow(walk, schema)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``documents`` (doc_id, text, lang) by part, which is their lang.

    An empty table gives no rows; a document without labels is neither good nor toxic; other columns
    are not read.
    """
    return audit_cells(count_cells(failure_masks(docs), labels))
