"""Bootstrap of the landings multiplier by group, with percentile curves.

A replicate draws n rows with replacement from the n trips of its group.  All (group, replicate)
pairs run as one job and no step holds a group in one task:

1. Trips are numbered 0..n-1 within their group by hash bucket (bucket offsets plus a row number
   inside the bucket) and packed into blocks of at most ``block_size`` rows.
2. How many of a replicate's n draws fall in each block comes from a tree of binomial splits over
   the blocks (``functions.splitting``), at a cost of blocks x replicates.
3. The counts meet their block, where each draw picks its row uniformly; the sums are folded per
   replicate before they are shuffled.

Drawing the blocks' counts and then rows within them is the multinomial draw itself, so the
resampling is exact.  What travels is blocks x replicates, not trips x replicates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulback import schemas
from haulback.functions.draws import coefficients, normal_score_rows, uniform_index
from haulback.functions.missing import INF, at_least
from haulback.functions.splitting import Ranges, split_ranges, stream_coefficients
from haulback.operators.joins import null_safe_join
from haulback.operators.lineage import cut_lineage
from haulback.operators.ratio import PARTS, multiplier
from haulback.shipping import ship_package

EXCLUDED = "excluded"  # Fixed value: reserved group name.
WEIGHT_FLOOR = 0.001  # Fixed value: stands in for a zero weight.
NBOOT = 1000
# Part of the draw, as the seed is: the rows of a replicate depend on both.
BLOCK_SIZE = 512
# Blocks of a group that are split in one task, at most.
SEGMENT = 4096
# Rows of a group that are put in order together, at most about so many.
ROWS_PER_BUCKET = 4096
# Replicates that meet one copy of a block.
REPS_PER_COPY = 128
# The normal distribution function rounds to 1 above this score.
SATURATION = 8.292
PROBABILITIES = [k / 1000 for k in range(1, 991)]


class Bootstrap(NamedTuple):
    curves: DataFrame
    summary: DataFrame
    replicates: DataFrame


def attach_groups(trips: DataFrame, groups: DataFrame) -> DataFrame:
    """GROUP of each trip by its stratum; missing keys match missing keys.

    The strata, which the codes and the map bound, are sent to the trips: by so few keys, a shuffle
    would put all trips into as many tasks.
    """
    return null_safe_join(trips, F.broadcast(groups.select(*schemas.STRATUM, "GROUP")), schemas.STRATUM)


def in_group() -> Column:
    return F.col("GROUP").isNotNull() & (F.col("GROUP") != EXCLUDED)


def floor_zero(weight: str) -> Column:
    return F.when(F.col(weight) == 0, F.lit(WEIGHT_FLOOR)).otherwise(F.col(weight)).alias(weight)


def grouped_trips(trips: DataFrame, groups: DataFrame) -> DataFrame:
    """Trips that take part, with their group, an md5 of their identity, and floored weights."""
    measures = {"COD", "HAD", "POL", "OBS", "GROUP"}
    identity = [
        F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~"))
        for c in sorted(trips.columns)
        if c not in measures
    ]
    return (
        attach_groups(trips, groups)
        .filter(in_group())
        .select(
            "GROUP",
            floor_zero("COD"),
            floor_zero("HAD"),
            "OBS",
            F.md5(F.concat_ws("|", *identity)).alias("ROW_KEY"),
        )
    )


def number_rows(data: DataFrame) -> DataFrame:
    """IDX 0..n-1 within the group in order of ROW_KEY, and the group's N.

    A hash prefix cuts the group into buckets, so a group of any size is ordered in many tasks;
    its length follows from the group's size, and the offsets come from one count per bucket.  The
    sizes, a row per group, are sent to the rows, so that no group is shuffled whole.
    """
    sizes = data.groupBy(F.col("GROUP").alias("_group")).agg(F.count(F.lit(1)).alias("_size"))
    digits = F.ceil(F.log(16.0, F.col("_size") / ROWS_PER_BUCKET))
    digits = F.greatest(F.lit(1), F.least(F.lit(32), digits)).cast("int")
    data = data.join(F.broadcast(sizes), F.col("GROUP") == F.col("_group"))
    data = data.withColumn("BUCKET", F.substring(F.col("ROW_KEY"), F.lit(1), digits))
    data = data.drop("_group", "_size")
    before = Window.partitionBy("GROUP").orderBy("BUCKET").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        data.groupBy("GROUP", "BUCKET")
        .agg(F.count(F.lit(1)).alias("SIZE"))
        .select(
            "GROUP",
            "BUCKET",
            F.coalesce(F.sum("SIZE").over(before), F.lit(0)).alias("OFFSET"),
            F.sum("SIZE").over(Window.partitionBy("GROUP")).alias("N"),
        )
    )
    inside = Window.partitionBy("GROUP", "BUCKET").orderBy("ROW_KEY", "COD", "HAD", "OBS")
    return (
        data.withColumn("RANK", F.row_number().over(inside))
        .join(offsets, ["GROUP", "BUCKET"])
        .withColumn("IDX", F.col("OFFSET") + F.col("RANK") - 1)
        .drop("BUCKET", "RANK", "OFFSET")
    )


def _flag_code() -> Column:
    """1 observed, 2 unobserved, 0 neither, 3 when the row makes its sums unknown."""
    obs = F.col("OBS")
    lacks = F.col("COD").isNull() | F.col("HAD").isNull()
    used = obs.isin("Y", "N")
    return (
        F.when(obs.isNull() | (used & lacks), 3)
        .when(obs == "Y", 1)
        .when(obs == "N", 2)
        .otherwise(0)
        .cast("byte")
    )


def row_blocks(numbered: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Rows of each group packed into blocks of at most ``block_size``, in IDX order."""
    row = F.struct("IDX", "COD", "HAD", _flag_code().alias("FLAG"))
    return (
        numbered.withColumn("BLOCK", F.floor(F.col("IDX") / block_size))
        .repartition(_partitions(numbered), "GROUP", "BLOCK")
        .groupBy("GROUP", "BLOCK")
        .agg(F.sort_array(F.collect_list(row)).alias("ROWS"))
        .select(
            "GROUP",
            "BLOCK",
            F.col("ROWS.COD").alias("CODS"),
            F.col("ROWS.HAD").alias("HADS"),
            F.col("ROWS.FLAG").alias("FLAGS"),
        )
    )


def _partitions(df: DataFrame) -> int:
    """Stated where work outweighs bytes, because adaptive execution merges partitions by bytes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_draws(
    sizes: DataFrame, nboot: int, seed: int, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """How many of each replicate's N draws fall in each block: GROUP, REP, BLOCK, DRAWS.

    With them go the coefficients of the block's own stream of draws.  Blocks without draws have no
    row, so there are at most as many rows as blocks times replicates, whatever a block holds.

    The range of a group's blocks is split by ``splitting``, first down to segments, which are dealt
    out, so that a large group fills many tasks, then to blocks.  Cutting segments changes no draw.
    """
    blocks = F.ceil(F.col("N") / block_size).cast("long")
    whole = sizes.withColumn("REP", F.explode(F.sequence(F.lit(0), F.lit(nboot - 1)))).select(
        "GROUP", "N", "REP", F.lit(0).cast("long").alias("LOW"), blocks.alias("HIGH"), F.col("N").alias("DRAWS")
    )
    dealt = _partitions(sizes)
    segments = _split_ranges(whole.repartition(dealt, "GROUP", "REP"), seed, block_size, SEGMENT)
    drawn = _split_ranges(segments.repartition(dealt, "GROUP", "REP", "LOW"), seed, block_size, 1)
    streams = coefficients(F.lit(seed), F.lit(block_size), F.col("GROUP"), F.col("REP"), F.col("BLOCK"))
    return drawn.select("GROUP", "REP", F.col("LOW").alias("BLOCK"), "DRAWS").select("*", *streams)


def _split_ranges(ranges: DataFrame, seed: int, block_size: int, leaf: int) -> DataFrame:
    """Rows (GROUP, N, REP, LOW, HIGH, DRAWS) split until they span at most ``leaf`` blocks."""
    ship_package(ranges.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, rows, rep, low, high, draws = batch.columns
            owners = zip(group.to_pylist(), rep.to_pylist(), strict=True)
            streams = [partial(stream_coefficients, seed, block_size, g, r, "split") for g, r in owners]
            numbers = rows.to_numpy()
            ranges = Ranges(np.arange(batch.num_rows), low.to_numpy(), high.to_numpy(), draws.to_numpy())
            for found in split_ranges(ranges, numbers, block_size, leaf, streams):
                of = pa.array(found.of)
                own = [group.take(of), rows.take(of), rep.take(of)]
                arrays = [*own, pa.array(found.low), pa.array(found.high), pa.array(found.draws)]
                yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return ranges.mapInArrow(split, ranges.schema)


def replicate_sums(blocks: DataFrame, draws: DataFrame) -> DataFrame:
    """The four ratio sums of every replicate; null when an unknown row was drawn."""
    at = uniform_index(F.col("K"), F.size("FLAGS")).cast("int")
    picked = (
        draws.join(blocks, ["GROUP", "BLOCK", "COPY"])
        .withColumn("K", F.explode(F.sequence(F.lit(1).cast("long"), F.col("DRAWS"))))
        .withColumn("AT", at)
        .select(
            "GROUP",
            "REP",
            F.col("CODS")[F.col("AT")].alias("COD"),
            F.col("HADS")[F.col("AT")].alias("HAD"),
            F.col("FLAGS")[F.col("AT")].alias("FLAG"),
        )
    )
    sums = [
        F.sum(F.when(F.col("FLAG") == code, F.col(w)).otherwise(0.0)).alias(f"{w}_{name}")
        for name, code in (("Y", 1), ("N", 2))
        for w in ("COD", "HAD")
    ]
    unknown = F.max((F.col("FLAG") == 3).cast("int")).alias("UNKNOWN")
    folded = picked.groupBy("GROUP", "REP").agg(*sums, unknown)
    return folded.select(
        "GROUP", "REP", *[F.when(F.col("UNKNOWN") == 0, F.col(p)).alias(p) for p in PARTS]
    )


def replicate_multipliers(
    data: DataFrame, nboot: int = NBOOT, seed: int = 10, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """MULT of every (GROUP, REP)."""
    sizes = data.groupBy("GROUP").agg(F.count(F.lit(1)).alias("N"))
    blocks = row_blocks(number_rows(data), block_size)
    draws = block_draws(sizes, nboot, seed, block_size)
    draws = draws.withColumn("COPY", F.floor(F.col("REP") / REPS_PER_COPY).cast("int"))
    copies = F.sequence(F.lit(0), F.lit((nboot - 1) // REPS_PER_COPY))
    blocks = blocks.withColumn("COPY", F.explode(copies))
    # Both sides alike, so that the draws of a few replicates from one block are a task's least.
    keys = ["GROUP", "BLOCK", "COPY"]
    draws = draws.repartition(_partitions(data), *keys)
    blocks = blocks.repartition(_partitions(data), *keys)
    sums = replicate_sums(blocks, draws)
    return sums.select("GROUP", "REP", multiplier().alias("MULT"))


def ranked_scores(replicates: DataFrame, nboot: int = NBOOT) -> DataFrame:
    """Rank, empirical distribution and normal scores of each group's nboot multipliers."""
    known = F.col("MULT").isNotNull() & ~F.isnan("MULT")
    by_value = Window.partitionBy("GROUP").orderBy(F.asc_nulls_last("MULT"))
    ranked = replicates.select(
        "GROUP",
        "REP",
        "MULT",
        F.row_number()
        .over(Window.partitionBy("GROUP").orderBy(F.asc_nulls_last("MULT"), "REP"))
        .alias("ID"),
        F.when(
            known,
            F.count(F.lit(1)).over(
                by_value.rangeBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        ).alias("AT_MOST"),
    )
    scores = replicates.sparkSession.createDataFrame(normal_score_rows(nboot), "K int, Z double")
    scores = F.broadcast(scores)  # nboot + 1 rows.
    alpha = scores.select(F.col("K").alias("ID"), F.col("Z").alias("ZALPHA"))
    omega = scores.select(F.col("K").cast("long").alias("AT_MOST"), F.col("Z").alias("Z0"))
    corrected = 2 * F.col("Z0") + F.col("ZALPHA")
    return (
        ranked.join(alpha, "ID")
        .join(omega, "AT_MOST", "left")
        .select(
            "GROUP",
            "REP",
            "MULT",
            "ID",
            (F.col("ID") / nboot).alias("ALPHA"),
            (F.col("AT_MOST") / nboot).alias("OMEGA"),
            "ZALPHA",
            "Z0",
            F.col("ZALPHA").alias("PLAIN"),
            F.when(corrected > SATURATION, F.lit(INF)).otherwise(corrected).alias("CORRECTED"),
        )
    )


def group_statistics(scored: DataFrame) -> DataFrame:
    """Per group: both percentile curves as arrays, and mean, variance and bias of MULT >= 0."""
    probabilities = F.lit(PROBABILITIES)
    usable = F.when(at_least(F.col("MULT"), 0), F.col("MULT"))

    def curve(score: str) -> Column:
        return F.percentile(F.when(~F.isnan(score), F.col(score)), probabilities)

    # Each group's nboot replicates stand in one window already, so its mean joins them there.
    mean = F.avg(usable).over(Window.partitionBy("GROUP"))
    scored = scored.withColumn("APART", usable - mean)
    return scored.groupBy("GROUP").agg(
        curve("PLAIN").alias("PERCS"),
        curve("CORRECTED").alias("BCPERCS"),
        F.avg(usable).alias("MEANMULT"),
        F.var_samp(usable).alias("VAR"),
        F.count(usable).alias("USED"),
        F.avg("APART").alias("BIAS"),
    )


def percentile_curves(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("GROUP").alias("group"),
        "MEANMULT",
        "BCPERCS",
        F.posexplode("PERCS").alias("pos", "perc"),
    ).select(
        "group",
        ((F.col("pos") + 1) / 1000).alias("prob"),
        "perc",
        F.get("BCPERCS", F.col("pos")).alias("bcperc"),
        "MEANMULT",
        (F.col("perc") * F.col("MEANMULT")).alias("perc2"),
        (F.get("BCPERCS", F.col("pos")) * F.col("MEANMULT")).alias("bcperc2"),
    )


def bootstrap_multiplier(
    trips: DataFrame,
    groups: DataFrame,
    nboot: int = NBOOT,
    *,
    seed: int = 10,
    block_size: int = BLOCK_SIZE,
    folder: str | None = None,
) -> Bootstrap:
    """Bootstrapped multipliers of every group, their summary and percentile curves.

    ``block_size`` belongs to the draw as ``seed`` does: results are alike for both alike.  The trips
    are read three times and the replicates serve three outputs, so both are written once, to
    ``folder`` or else to the session's ``spark.checkpoint.dir``.
    """
    data = cut_lineage(grouped_trips(trips, groups), folder)
    replicates = cut_lineage(replicate_multipliers(data, nboot, seed, block_size), folder)
    stats = group_statistics(ranked_scores(replicates, nboot))
    summary = stats.filter("USED > 0").select("GROUP", "MEANMULT", "VAR", "BIAS")
    return Bootstrap(percentile_curves(stats), summary, replicates)


