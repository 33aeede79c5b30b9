"""Multinomial counts over equal blocks by a tree of binomial splits, at a cost of the blocks.

n draws with replacement from N rows fall on the blocks of rows as the multinomial distribution says.
The range of blocks is halved again and again; of the draws in a range, those in its left half are
binomial, with the half's share of the rows. So a replicate costs one draw for each split point,
however many rows a block has.

Each split inverts the binomial distribution function at one uniform number. The probabilities around
the mode follow from each other by ratios of whole numbers, so only multiplications, divisions and
sums of doubles are used; what lies beyond nine standard deviations is less than a double resolves.
The uniform number of a split point belongs to the stream of its replicate, whatever the partitioning
or a task's retry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5
from typing import NamedTuple

import numpy as np

from haulback.functions.draws import PRIME

#: Split points that share a stream, which gives two values for each.
POINTS_PER_STREAM = 1 << 15
#: Standard deviations, and places more, on either side of the mode.
REACH, MARGIN = 9.0, 20
#: Probabilities held at a time, and blocks that are split together.
_CELLS = 1 << 20
_TOGETHER = 1 << 16

Stream = Callable[[int], tuple[int, int, int, int]]


class Ranges(NamedTuple):
    """Ranges of blocks [low, high) with their draws; ``of`` says whose they are."""

    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    draws: np.ndarray


def stream_coefficients(*name: object) -> tuple[int, int, int, int]:
    """The coefficients of the stream of this name, as ``draws.coefficients`` cuts them."""
    text = "|".join(f"{len(str(part))}:{part}" for part in name)
    digest = md5(text.encode()).hexdigest()
    a, b, c, d = (int(digest[8 * i : 8 * i + 8], 16) % PRIME for i in range(4))
    return a, b, c, d


def _uniform(coefficients: np.ndarray, x: np.ndarray) -> np.ndarray:
    u = coefficients[3]
    for a in (coefficients[2], coefficients[1], coefficients[0]):
        u = (u * x + a) % PRIME
    return u.astype(np.float64)


def binomial(n: np.ndarray, part: np.ndarray, whole: np.ndarray, u: np.ndarray) -> np.ndarray:
    """How many of n draws fall in ``part`` of ``whole`` rows, at the uniform numbers u."""
    out = np.empty(len(n), np.int64)
    p = part / whole
    reach = np.ceil(REACH * np.sqrt(n * p * (1 - p))).astype(np.int64) + MARGIN
    order = np.argsort(reach, kind="stable")
    start = 0
    while start < len(order):
        # Alike in reach, so that little of the table is idle.
        size = max(1, _CELLS // int(2 * reach[order[start]] + 1))
        at = order[start : start + size]
        while len(at) > 1 and reach[at[-1]] > 2 * reach[at[0]]:
            at = at[: len(at) // 2]
        out[at] = _inverted(n[at], part[at], whole[at] - part[at], u[at], int(reach[at].max()))
        start += len(at)
    return out


def _inverted(n: np.ndarray, a: np.ndarray, b: np.ndarray, u: np.ndarray, reach: int) -> np.ndarray:
    """The same for a few draws: a rows in the part, b beside it, the mode +- ``reach`` looked at."""
    mode = np.minimum(n, ((n + 1) * (a / (a + b))).astype(np.int64))[:, None]
    n, odds, step = n[:, None], (a / b)[:, None], np.arange(reach)
    # Beyond 0 and n a ratio of 0 ends the product.
    above = np.cumprod(np.maximum(n - mode - step, 0) / (mode + step + 1) * odds, axis=1)
    below = np.cumprod(np.maximum(mode - step, 0) / (n - mode + step + 1) / odds, axis=1)
    heights = np.concatenate([below[:, ::-1], np.ones((len(n), 1)), above], axis=1)
    sums = np.cumsum(heights, axis=1)
    passed = (sums <= u[:, None] * sums[:, -1:]).sum(axis=1)
    return np.clip(mode[:, 0] - reach + passed, 0, n[:, 0])


def split_ranges(
    ranges: Ranges, rows: np.ndarray, block_size: int, leaf: int, streams: list[Stream]
) -> Iterator[Ranges]:
    """Ranges of at most ``leaf`` blocks, those without draws left out, a bounded number at a time.

    ``rows`` and ``streams`` are those of each owner: the rows of its group, and the streams of its
    replicate by number.
    """
    width = np.cumsum(ranges.high - ranges.low)
    start = 0
    while start < len(width):
        done = width[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(width, done + _TOGETHER, side="right")))
        yield _split(Ranges(*(x[start:end] for x in ranges)), rows, block_size, leaf, streams)
        start = end


def _split(ranges: Ranges, rows: np.ndarray, block_size: int, leaf: int, streams: list[Stream]) -> Ranges:
    done: list[Ranges] = []
    known: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    while True:
        small = ranges.high - ranges.low <= leaf
        done.append(Ranges(*(x[small] for x in ranges)))
        of, low, high, draws = (x[~small] for x in ranges)
        if not len(of):
            return Ranges(*map(np.concatenate, zip(*done, strict=True)))
        middle = (low + high) // 2
        names = list(zip(of.tolist(), (middle // POINTS_PER_STREAM).tolist(), strict=True))
        for name in set(names) - known.keys():
            known[name] = streams[name[0]](name[1])
        coefficients = np.array([known[name] for name in names], np.int64).T
        x = middle % POINTS_PER_STREAM
        u = (_uniform(coefficients, 2 * x) + _uniform(coefficients, 2 * x + 1) / PRIME) / PRIME
        end = np.minimum(high * block_size, rows[of])
        left = binomial(draws, (middle - low) * block_size, end - low * block_size, u)
        halves = Ranges(of, low, middle, left), Ranges(of, middle, high, draws - left)
        joined = Ranges(*map(np.concatenate, zip(*halves, strict=True)))
        ranges = Ranges(*(x[joined.draws > 0] for x in joined))
