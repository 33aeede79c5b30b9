import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction
from statistics import NormalDist, mean, variance

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.draws import PRIME, coefficients
from haulback.functions.splitting import POINTS_PER_STREAM, binomial
from haulback.operators import bootstrap as boot
from haulback.operators.allocate import assign_discards, attach_groups_full
from tests.frames import trips, values


def make_trips(spark, n, zone=1, **more):
    rows = [
        {
            "TRIP_ID": i, "ZONE": zone, "COD": float(i % 7), "HAD": float(1 + i % 5),
            "TRIP": "T" if i % 3 == 0 else None, "OBS": "Y" if i % 3 == 0 else "N", **more,
        }
        for i in range(n)
    ]
    return trips(spark, *rows)


def groups(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.GROUPS)


def stream(*name):
    digest = hashlib.md5("|".join(f"{len(str(x))}:{x}" for x in name).encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) % PRIME for i in range(4)]


def uniform(coefficients, x):
    u = coefficients[3]
    for a in (coefficients[2], coefficients[1], coefficients[0]):
        u = (u * (x % PRIME) + a) % PRIME
    return u


def pick(coefficients, x, n):
    return math.floor(uniform(coefficients, x) / PRIME * n)


def split_draws(draws, low, high, rows, size, name):
    """Draws by block, from halves: the binomial distribution summed in whole numbers."""
    if high - low == 1:
        return {low: draws}
    middle = (low + high) // 2
    c, x = stream(*name, "split", middle // POINTS_PER_STREAM), middle % POINTS_PER_STREAM
    u = (uniform(c, 2 * x) + uniform(c, 2 * x + 1) / PRIME) / PRIME
    whole = min(high * size, rows) - low * size
    part = (middle - low) * size
    k, passed = 0, (whole - part) ** draws
    while passed <= Fraction(u) * whole**draws:
        k += 1
        passed += math.comb(draws, k) * part**k * (whole - part) ** (draws - k)
    left = split_draws(k, low, middle, rows, size, name) if k else {}
    return left | (split_draws(draws - k, middle, high, rows, size, name) if draws > k else {})


def brute_force(rows, nboot, seed, block_size):
    """Replicates drawn one at a time in Python."""
    by_group = defaultdict(list)
    for r in rows:
        by_group[r.GROUP].append(r)
    out = {}
    for g, members in by_group.items():
        members.sort(key=lambda r: (r.ROW_KEY, r.COD, r.HAD, r.OBS))
        n = len(members)
        for b in range(nboot):
            counts = split_draws(n, 0, -(-n // block_size), n, block_size, (seed, block_size, g, b))
            sums = defaultdict(float)
            for block, draws in counts.items():
                size = min(block_size, n - block * block_size)
                c = stream(seed, block_size, g, b, block)
                for k in range(1, draws + 1):
                    r = members[block * block_size + pick(c, k, size)]
                    sums["COD", r.OBS] += r.COD
                    sums["HAD", r.OBS] += r.HAD
            out[g, b] = (sums["COD", "Y"] / sums["HAD", "Y"]) / (
                sums["COD", "N"] / sums["HAD", "N"]
            )
    return out


@pytest.mark.parametrize("block_size, segment", [(16, 4096), (4, 2), (4, 5), (8192, 4096)])
def test_replicates_match_brute_force(spark, block_size, segment, monkeypatch):
    monkeypatch.setattr(boot, "SEGMENT", segment)
    data = make_trips(spark, 90).unionByName(make_trips(spark, 40, zone=2))
    table = groups(spark, (90, 1, 2, "A"), (90, 2, 2, "B"))
    grouped = boot.grouped_trips(data, table)
    expected = brute_force(grouped.collect(), 25, 10, block_size)
    got = boot.replicate_multipliers(grouped, 25, 10, block_size).collect()
    assert {(r.GROUP, r.REP): pytest.approx(r.MULT) for r in got} == expected


def test_binomial_against_whole_numbers():
    draw = random.Random(8)
    cases = [(1, 1, 2), (5, 1, 6), (513, 512, 513), (700, 1, 513), (2000, 512, 1024), (3, 2, 3)]
    cases += [(draw.randint(1, 300), a, a + draw.randint(1, 90)) for a in (1, 7, 64, 90) for _ in range(10)]
    numbers = [1e-9, 0.5, 1 - 1e-12, *(draw.random() for _ in range(8))]
    n, a, r, u = map(np.array, zip(*((*c, x) for c in cases for x in numbers), strict=True))
    for n, a, r, u, got in zip(*(x.tolist() for x in (n, a, r, u, binomial(n, a, r, u))), strict=True):
        k, passed = 0, (r - a) ** n
        while passed <= Fraction(u) * r**n:
            k += 1
            passed += math.comb(n, k) * a**k * (r - a) ** (n - k)
        assert got == k, (n, a, r, u)


def test_large_splits_have_the_binomial_mean_and_variance():
    u = np.random.default_rng(1).random(4000)
    n, a, r = 10**9, 3 * 10**8, 10**9
    got = binomial(np.full(4000, n), np.full(4000, a), np.full(4000, r), u)
    apart = (got - n * 0.3) / math.sqrt(n * 0.21)
    assert abs(apart.mean()) < 0.06 and apart.std() == pytest.approx(1, abs=0.05)


def test_block_draws_follow_the_blocks(spark):
    """A hundred times the trips in blocks a hundred times as large: the same rows of draws."""
    counts = []
    for rows, block in ((4000, 100), (400_000, 10_000)):
        sizes = spark.createDataFrame([("A", rows)], "`GROUP` string, N long")
        found = boot.block_draws(sizes, 50, 10, block)
        total = found.agg(F.count("*").alias("n"), F.sum("DRAWS").alias("draws")).first()
        assert total.draws == 50 * rows
        counts.append(total.n)
    assert counts == [50 * 40] * 2


def test_stream_names_do_not_collide(spark):
    df = spark.createDataFrame([("A", "5|3"), ("A|5", "3")], "a string, b string")
    first, second = df.select(*coefficients(F.col("a"), F.col("b"))).collect()
    assert tuple(first) != tuple(second)


def test_replicates_do_not_depend_on_partitions(spark, monkeypatch):
    grouped = boot.grouped_trips(make_trips(spark, 200), groups(spark, (90, 1, 2, "A")))
    one = values(boot.replicate_multipliers(grouped.coalesce(1), 20, 3, 32), "REP", "MULT")
    monkeypatch.setattr(boot, "REPS_PER_COPY", 3)
    monkeypatch.setattr(boot, "ROWS_PER_BUCKET", 2)
    many = values(boot.replicate_multipliers(grouped.repartition(7), 20, 3, 32), "REP", "MULT")
    assert [b for b, _ in one] == [b for b, _ in many]
    assert [m for _, m in one] == pytest.approx([m for _, m in many])


def test_rows_are_numbered_without_gaps(spark):
    grouped = boot.grouped_trips(make_trips(spark, 500), groups(spark, (90, 1, 2, "A")))
    numbered = boot.number_rows(grouped)
    assert [i for (i,) in values(numbered.withColumn("IDX", F.format_string("%04d", "IDX")), "IDX")] == [
        f"{i:04d}" for i in range(500)
    ]
    assert numbered.select("N").distinct().collect() == [(500,)]


def test_draws_are_uniform_over_rows(spark):
    """Counts of each row over many replicates have the multinomial's mean and variance."""
    n, nboot, block = 60, 3000, 8
    rows = [(f"G{0}", 1.0 if i == 17 else 0.0, 1.0, "Y", hashlib.md5(b"%d" % i).hexdigest()) for i in range(n)]
    data = spark.createDataFrame(rows, "`GROUP` string, COD double, HAD double, OBS string, ROW_KEY string")
    blocks = boot.row_blocks(boot.number_rows(data), block)
    sizes = data.groupBy("GROUP").agg(F.count(F.lit(1)).alias("N"))
    draws = boot.block_draws(sizes, nboot, 1, block).withColumn("COPY", F.lit(0))
    sums = boot.replicate_sums(blocks.withColumn("COPY", F.lit(0)), draws).collect()
    assert len(sums) == nboot and {r.HAD_Y for r in sums} == {float(n)}
    counts = [r.COD_Y for r in sums]
    assert mean(counts) == pytest.approx(1.0, abs=0.08)
    assert variance(counts) == pytest.approx(1 - 1 / n, abs=0.12)


def test_unknown_weight_makes_drawn_replicates_unknown(spark):
    data = make_trips(spark, 30).withColumn("COD", F.when(F.col("TRIP_ID") != 4, F.col("COD")))
    grouped = boot.grouped_trips(data, groups(spark, (90, 1, 2, "A")))
    got = boot.replicate_multipliers(grouped, 40, 10).collect()
    assert 0 < sum(r.MULT is None for r in got) < 40


def replicate_table(spark, mults):
    return spark.createDataFrame([("A", i, m) for i, m in enumerate(mults)], "`GROUP` string, REP int, MULT double")


def test_scores_with_ties_and_undefined(spark):
    nan, z = math.nan, NormalDist().inv_cdf
    got = boot.ranked_scores(replicate_table(spark, [2.0, 1.0, 2.0, nan]), 4).orderBy("ID").collect()
    assert [r.MULT for r in got[:3]] == [1.0, 2.0, 2.0] and math.isnan(got[3].MULT)
    assert [r.OMEGA for r in got] == [0.25, 0.75, 0.75, None]
    assert got[0].CORRECTED == pytest.approx(3 * z(0.25))
    assert got[3].PLAIN == math.inf and got[3].CORRECTED is None


def test_curves_and_summary(spark):
    mults = [k / 10 for k in range(1, 11)] + [-1.0, math.nan]
    n, z = len(mults), NormalDist().inv_cdf
    stats = boot.group_statistics(boot.ranked_scores(replicate_table(spark, mults), n))
    row = stats.first()
    assert row.MEANMULT == pytest.approx(0.55) and row.BIAS == pytest.approx(0, abs=1e-12)
    assert row.VAR == pytest.approx(variance(k / 10 for k in range(1, 11)))
    curves = {round(r.prob, 3): r for r in boot.percentile_curves(stats).collect()}
    assert len(curves) == 990 and min(curves) == 0.001 and max(curves) == 0.99
    h = (n - 1) * 0.5
    lo = math.floor(h)
    expected = z((lo + 1) / n) * (1 - (h - lo)) + z((lo + 2) / n) * (h - lo)
    assert curves[0.5].perc == pytest.approx(expected)
    assert curves[0.5].perc2 == pytest.approx(expected * 0.55)
    assert curves[0.99].perc == math.inf


def test_excluded_and_ungrouped_trips_stay_out(spark):
    data = make_trips(spark, 12).unionByName(make_trips(spark, 12, zone=2))
    data = data.unionByName(make_trips(spark, 12, zone=3)).unionByName(make_trips(spark, 12, zone=None))
    table = groups(spark, (90, 1, 2, "A"), (90, 2, 2, "excluded"), (90, 3, 2, None), (90, None, 2, "N"))
    got = boot.bootstrap_multiplier(data, table, 10)
    assert values(got.summary, "GROUP") == [("A",), ("N",)]
    assert got.curves.count() == 2 * 990


def results(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.GROUP_RESULTS)


def test_shares_add_up_to_the_group(spark):
    data = trips(
        spark,
        {"VR_NUMBER_FISHING": 1, "HAD": 3.0},
        {"VR_NUMBER_FISHING": 1, "HAD": 1.0, "TRIP_ID": 2},
        {"VR_NUMBER_FISHING": 2, "HAD": 4.0},
        {"VR_NUMBER_FISHING": 3, "HAD": 9.0, "ZONE": 2},
        {"VR_NUMBER_FISHING": 4, "HAD": 9.0, "ZONE": 3},
        {"VR_NUMBER_FISHING": 5, "HAD": 9.0, "ZONE": 4},
    )
    table = groups(spark, (90, 1, 2, "A"), (90, 2, 2, "B"), (90, 3, 2, "C"), (90, 4, 2, "D"))
    shares = results(spark, ("A", "Y", 10.0), ("B", "N", 0.0), ("C", "N", -1.0), ("D", "N", None))
    got = assign_discards(data, table, shares)
    assert values(got, "VR_NUMBER_FISHING", "DISCARDS") == [(1, 5.0), (2, 5.0)]


def test_empty_stratum_leaves_its_group_unknown_unless_ignored(spark):
    data = trips(spark, {"HAD": 3.0})
    table = groups(spark, (90, 1, 2, "A"), (90, 9, 2, "A"))
    shares = results(spark, ("A", "Y", 10.0))
    assert attach_groups_full(data, table).count() == 2
    got = assign_discards(data, table, shares)
    assert values(got, "ZONE", "DISCARDS") == [(1, None), (9, None)]
    got = assign_discards(data, table, shares, ignore_empty=True)
    assert values(got, "ZONE", "DISCARDS") == [(1, 10.0)]


def test_group_without_haddock_has_undefined_shares(spark):
    got = assign_discards(
        trips(spark, {"HAD": 0.0}), groups(spark, (90, 1, 2, "A")), results(spark, ("A", "Y", 1.0))
    )
    assert math.isnan(got.first().DISCARDS)
