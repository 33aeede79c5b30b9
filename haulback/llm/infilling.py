"""Fill-in-middle: a text's middle goes to its end, by rotating blocks in place.

The two cuts are scanned for, the three sentinels are set into the text's bytes in front of the
parts, and neighbouring blocks change places by three reversals: each block is turned round, then
both together. A rotation is undone by the rotation back, so the text is restored byte by byte.

    sentinels set          <P>prefix <M>middle <S>suffix
    psm: the last two      <P>prefix <S>suffix <M>middle
    spm: the last to front <S>suffix <P>prefix <M>middle
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from haulback.llm.arrays import release_memory, text_blocks, word_bounds
from haulback.llm.shipping import ship_package

# Sentinels, and the shares of texts that are transformed and of those that are spm.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIM_PCT, SPM_PCT, SEED = 50, 80, 42
_SENTINEL = re.compile(b"<[PSM]>")
_SPACES = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
#: Bytes that a reversal exchanges at a time.
_STRIDE = 1 << 16


def reverse(body: bytearray, start: int, end: int) -> None:
    """Turn a stretch round in place, exchanging equal blocks from its two ends."""
    while end - start > 1:
        n = min(_STRIDE, (end - start) // 2)
        front, back = body[start : start + n], body[end - n : end]
        front.reverse()
        back.reverse()
        body[start : start + n], body[end - n : end] = back, front
        start, end = start + n, end - n


def rotate(body: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the blocks [start, cut) and [cut, end)."""
    reverse(body, start, cut)
    reverse(body, cut, end)
    reverse(body, start, end)


class Draws(NamedTuple):
    """What is drawn for a document: two cuts (modulo the units + 1), and two percentages."""

    one: int
    other: int
    plain: int
    spm: int


def draws_of(key: int | None, seed: int = SEED) -> Draws:
    """The first four 8-digit groups of the SHA-256 of ``seed:key``; without a key, of ``seed:``."""
    digest = sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return Draws(*(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)))


def transform(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with its middle, from byte ``first`` to ``second``, at its end."""
    body = bytearray(text)
    body[second:second] = SUFFIX
    body[first:first] = MIDDLE
    body[0:0] = PREFIX
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(body, middle if form == PSM else 0, suffix, len(body))
    return body


def restore(output: bytes, form: str) -> bytearray:
    """The text that ``transform`` was given: the blocks go back, then the sentinels go."""
    body = bytearray(output)
    if form == PLAIN:
        return body
    # The text holds no sentinel and none can arise across a border, so each is found once.
    if form == PSM:
        start, cut = body.index(SUFFIX), body.index(MIDDLE)
    else:
        start, cut = 0, body.index(PREFIX)
    rotate(body, start, cut, len(body))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = body.rindex(sentinel)
        del body[at : at + len(sentinel)]
    return body


def _chars(body: bytes) -> int:
    return len(body.translate(None, _CONTINUED))


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    fim_pct: int = FIM_PCT,
    spm_pct: int = SPM_PCT,
    seed: int = SEED,
) -> DataFrame:
    """Rows (key, n long, form string, prefix_chars long, middle_chars long, output string).

    A text's n units are its words, each with the white space before it, and white space at its end.
    The key draws two cuts between units and the form: ``plain`` (output is the text, both counts
    null), ``psm`` or ``spm``. A text that is null, empty or holds a sentinel is plain; the output of
    a null text is empty. Keys are integers; rows that repeat one draw alike, and all rows without
    one draw alike. An empty table gives no rows; other columns are not read. A text is held whole by
    its task, its reversals take a bounded buffer.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    fields = ["key", "n", "form", "prefix_chars", "middle_chars", "output"]

    def one(k: int | None, body: bytes, ends: np.ndarray) -> tuple:
        n, h = len(ends) - 1, draws_of(k, seed)
        if not body or h.plain % 100 >= fim_pct or _SENTINEL.search(body):
            return k, n, PLAIN, None, None, body
        first, second = (int(ends[i]) for i in sorted((h.one % (n + 1), h.other % (n + 1))))
        form = SPM if h.spm % 100 < spm_pct else PSM
        out = transform(body, first, second, form)
        return k, n, form, _chars(body[:first]), _chars(body[first:second]), bytes(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for rows, data, offsets in text_blocks(batches):
            ends = word_bounds(data, offsets)[1]
            cuts = np.searchsorted(ends, offsets, side="right")
            found = []
            for i, k in enumerate(rows.column(0).to_pylist()):
                start, end = int(offsets[i]), int(offsets[i + 1])
                body = data[start:end].tobytes()
                units = [np.zeros(1, np.int64), ends[cuts[i] : cuts[i + 1]] - start]
                if body[-1:] and body[-1] in _SPACES:
                    units.append(np.array([end - start]))
                found.append(one(k, body, np.concatenate(units)))
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            arrays[-1] = arrays[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=fields)

    schema = "key long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.mapInArrow(run, schema).withColumnRenamed("key", key)


def restore_texts(transformed: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """The rows with the column ``restored``, the text rebuilt from output and form.

    A null output restores to the empty text. A column ``restored`` is replaced.
    """
    ship_package(transformed.sparkSession)
    rows = transformed.drop("restored")
    how = rows.columns.index(form)
    schema = StructType([*rows.schema, StructField("restored", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_blocks(batches, output):
            forms = part.column(how).to_pylist()
            texts = [bytes(restore(data[a:b].tobytes(), f)) for a, b, f in zip(offsets, offsets[1:], forms, strict=False)]
            arrays = [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        release_memory()

    return rows.mapInArrow(run, schema)
