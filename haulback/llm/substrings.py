"""Substring removal: texts lose the passages that the corpus holds before them.

Windows that occur earlier are found by the anchors of ``repeats``: contexts that an earlier text
holds decide whole stretches at once, and only the windows of a new context whose gram is not new are
compared one by one. Texts are not parsed into Lempel-Ziv factors; README says so.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulback.llm.arrays import word_bounds, word_hashes
from haulback.llm.repeats import COMPARE, MANY, Scheme, later_windows, remove_repeats, window_rows

WINDOW = 20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _check_boundaries(marked: DataFrame, scheme: Scheme) -> DataFrame:
    return later_windows(window_rows(marked, scheme, (COMPARE, COMPARE + MANY)))


def _kept_texts(data: np.ndarray, offsets: np.ndarray, gone: np.ndarray, cuts: np.ndarray) -> list[pa.Array]:
    body, keep = data.tobytes(), (~gone).tolist()
    texts = []
    for i in range(len(offsets) - 1):
        words = body[offsets[i] : offsets[i + 1]].split()
        texts.append(b" ".join(compress(words, keep[cuts[i] : cuts[i + 1]])))
    removed = np.add.reduceat(np.append(gone, False), cuts[:-1], dtype=np.int64) if len(cuts) > 1 else cuts[:0]
    removed = np.where(np.diff(cuts) > 0, removed, 0)
    return [
        pa.array(np.diff(cuts)),
        pa.array(removed),
        pa.array(texts, pa.binary()).cast(pa.string()),
    ]


def remove_passages(
    docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Rows (key, n_words, n_removed, kept, *carry): each text without the passages that occur earlier.

    A word goes if it lies in ``window`` consecutive words that also start earlier: in a text of
    smaller key, or before in the same text. ``kept`` holds the other words, joined by one space.
    A null or empty text has no words. Keys are long integers. Rows that repeat key and text are one
    text and each return its result; different texts under one key are texts of their own, of which
    the one whose text has the smaller 64-bit hash is the earlier. A text without a key is returned
    whole, and is no earlier place for others. Texts shorter than the window lose nothing; an empty table gives no
    rows; other columns are not read, but for those of ``carry``, which go along.
    """
    gram = max(1, window // 4)
    scheme = Scheme(_words, window, gram, block_bytes=1 << 20)
    schema = "n_words long, n_removed long, kept string"
    return remove_repeats(docs, scheme, _check_boundaries, _kept_texts, schema, key, text, carry)
