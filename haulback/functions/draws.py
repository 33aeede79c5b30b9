"""Seeded uniform integers from polynomial hashing.

A 4-wise independent family: u(x) = a3 x^3 + a2 x^2 + a1 x + a0 mod P over the prime 2^31 - 1, with
the four coefficients cut from one md5 of the stream's name.  A stream is asked for fewer than P / 2
draws: longer sequences are cut into streams of their own.  Deterministic whatever the
partitioning or a task's retry, cheap enough to run inside generated code once per draw, and the
same integers in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2**31 - 1


def coefficients(*stream: Column) -> list[Column]:
    """Four columns _a0.._a3 for the stream named by the given columns.

    Put a shuffle between these and an exploded draw number: generated code puts off a column until
    it is used, which after an explode is once per draw.
    """
    # Each part with its length, so that no two lists of parts have one name.
    parts = [s.cast("string") for s in stream]
    digest = F.md5(F.concat_ws("|", *[F.concat(F.length(s), F.lit(":"), s) for s in parts]))
    return [
        (F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") % PRIME).alias(f"_a{i}")
        for i in range(4)
    ]


def uniform_index(x: Column, n: Column) -> Column:
    """Index in [0, n) for draw number x, using the columns _a0.._a3."""
    index = F.floor(_uniform(x) / F.lit(float(PRIME)) * n.cast("double"))
    return F.coalesce(index, F.lit(0).cast("long"))


def _uniform(x: Column) -> Column:
    """Value x of the stream, from 0 to P - 1, as a double."""
    p = F.lit(PRIME)
    x = x.cast("long") % p
    u = F.col("_a3")
    for name in ("_a2", "_a1", "_a0"):
        u = (u * x + F.col(name)) % p
    return u.cast("double")


def normal_score_rows(n: int) -> list[tuple[int, float]]:
    """Standard normal quantile of k/n for k = 0..n (parameter-sized, n + 1 rows)."""
    from statistics import NormalDist

    inv = NormalDist().inv_cdf
    inner = [(k, inv(k / n)) for k in range(1, n)]
    return [(0, float("-inf")), *inner, (n, float("inf"))]
