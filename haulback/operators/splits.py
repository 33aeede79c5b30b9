"""Splits that take records out of the estimate, each with its reason.

``label_landings`` brings the evidence of all splits to the landings with one join on the trip
number, and what the directed trips and records amount to with two on small tables; ``splits_of`` reads every kept and removed side off its columns.
The functions of single splits do the same for a caller who needs one of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.codes import (
    NO_PANEL_FEATURE,
    NON_COMMERCIAL_SET,
    TARGET_SPECIES_SOUGHT,
)
from haulback.functions.missing import count_where, ieee_divide, is_finite
from haulback.operators.joins import (
    SALT,
    TRIP_SALTS,
    Split,
    deal_out,
    join_dealt,
    join_on_trip,
    null_safe_join,
    repeat_rows,
)

__all__ = ["Split", "no_panel", "non_commercial", "observed_quarters", "species_sought"]

# The reason given with each removed record.
NON_COMMERCIAL_COMMENT = "NON COMMERCIAL TRIP"
NO_PANEL_COMMENT = "DID NOT USE SEPARATOR PANEL"
OTHER_SPECIES_COMMENT = "SPECIES OTHER THAN COD OR HADDOCK SOUGHT"
ALL_COD_COMMENT = "ALL SETS COD DIRECTED"
LAST_COD_COMMENT = "LAST SETS COD DIRECTED"
POLLOCK_COMMENT = "POLLOCK DIRECTED"
FULLY_OBSERVED_COMMENT = "QUARTER WITH 100% OBSERVER COVERAGE"
COD_DIRECTED_RATIO = 0.8

RECORD_KEYS = ["VR_NUMBER_FISHING", "TRIP_ID", "LANDED_DATE", "DATE_FISHED", *schemas.WEIGHTS]


def non_commercial(landings: DataFrame, observers: DataFrame) -> Split:
    """Trips with a non-commercial set leave; the removed side holds each record once."""
    trips = (
        observers.filter(F.col("SETCD_ID") == NON_COMMERCIAL_SET)
        .select("TRIP", F.lit(True).alias("_non_commercial"))
        .distinct()
    )
    marked = join_on_trip(landings, trips)
    return Split(
        kept=marked.filter(F.col("_non_commercial").isNull()).drop("_non_commercial"),
        removed=marked.filter("_non_commercial")
        .drop("_non_commercial")
        .withColumn("COMMENT", F.lit(NON_COMMERCIAL_COMMENT))
        .distinct(),
    )


def no_panel(landings: DataFrame, features: DataFrame, *, exclusive: bool = False) -> Split:
    """Trips fishing without a separator panel leave.

    By default a trip with both features is on both sides and each feature row of a trip repeats
    its landings; ``exclusive`` puts every landing on exactly one side, once.
    """
    if exclusive:
        bare = (
            features.filter(F.col("GEARFCD_ID") == NO_PANEL_FEATURE)
            .select("TRIP", F.col("GEARFCD_ID"))
            .distinct()
        )
        marked = join_on_trip(landings, bare)
    else:
        marked = join_on_trip(landings, features.select("TRIP", "GEARFCD_ID"))
    feature = F.col("GEARFCD_ID")
    return Split(
        kept=marked.filter(feature.isNull() | (feature != NO_PANEL_FEATURE)).drop("GEARFCD_ID"),
        removed=marked.filter(feature == NO_PANEL_FEATURE)
        .drop("GEARFCD_ID")
        .withColumn("COMMENT", F.lit(NO_PANEL_COMMENT)),
    )


def _filled(code: str):
    return F.coalesce(F.col(code), F.lit(0.0))


def _cod_ratio():
    return ieee_divide(_filled("100"), _filled("110"))


def _cod_directed():
    """Ratio above the bound; a quotient of two zeroes is not."""
    ratio = _cod_ratio()
    return F.coalesce(~F.isnan(ratio) & (ratio > COD_DIRECTED_RATIO), F.lit(False))


def other_species_trips(sought: DataFrame) -> DataFrame:
    """Trips that sought species other than cod and haddock, with how many."""
    other = ~F.col("SPECSCD_ID").isin(*TARGET_SPECIES_SOUGHT)
    return (
        sought.filter(other)
        .select("TRIP", "SPECSCD_ID")
        .distinct()
        .groupBy("TRIP")
        .agg(F.count(F.lit(1)).alias("N_OTHER"))
    )


def cod_directed_trips(landings: DataFrame) -> DataFrame:
    """Per trip: were all sets cod directed; was the first finite-ratio set not, but the last.

    First and last are extremes of (set id, flag) structs, not a window, so a long trip is folded
    before it is shuffled; sets that share an id count in flag order.
    """
    flag = F.when(_cod_directed(), 1).otherwise(0)
    known = is_finite(_cod_ratio())
    set_id = F.col("LOG_EFRT_STD_INFO_ID")
    position = F.when(known, F.struct(set_id.isNull().alias("late"), set_id, flag.alias("flag")))
    per_trip = landings.groupBy("TRIP_ID").agg(
        (F.min(flag) == 1).alias("ALL_DIRECTED"),
        F.min(position).getField("flag").alias("FIRST_FLAG"),
        F.max(position).getField("flag").alias("LAST_FLAG"),
    )
    return per_trip.select(
        "TRIP_ID",
        "ALL_DIRECTED",
        F.coalesce((F.col("FIRST_FLAG") == 0) & (F.col("LAST_FLAG") == 1), F.lit(False)).alias(
            "TURNED_TO_COD"
        ),
    ).filter(F.col("ALL_DIRECTED") | F.col("TURNED_TO_COD"))


def pollock_directed():
    return _filled("170") > _filled("100") + _filled("110")


def tag_directed(landings: DataFrame, sought: DataFrame) -> DataFrame:
    """Landings with the evidence of the four direction rules."""
    tagged = join_on_trip(landings, other_species_trips(sought))
    tagged = null_safe_join(tagged, cod_directed_trips(landings), ["TRIP_ID"], salts=TRIP_SALTS)
    turned = F.coalesce("TURNED_TO_COD", F.lit(False))
    return tagged.select(
        *landings.columns,
        F.coalesce("N_OTHER", F.lit(0)).cast("int").alias("N_OTHER"),
        F.coalesce("ALL_DIRECTED", F.lit(False)).alias("ALL_COD"),
        (turned & is_finite(_cod_ratio()) & _cod_directed()).alias("LAST_COD"),
        pollock_directed().alias("POLLOCK"),
    )


EVIDENCE = ["N_OTHER", "ALL_COD", "LAST_COD", "POLLOCK"]


def directed_records(tagged: DataFrame) -> DataFrame:
    """One row per record and rule it meets, and per other species sought.

    The two rules that compare filled weights report them filled.
    """
    reason = F.explode(
        F.concat(
            F.array_repeat(F.lit(OTHER_SPECIES_COMMENT), F.col("N_OTHER")),
            F.array_repeat(F.lit(ALL_COD_COMMENT), F.col("ALL_COD").cast("int")),
            F.array_repeat(F.lit(LAST_COD_COMMENT), F.col("LAST_COD").cast("int")),
            F.array_repeat(F.lit(POLLOCK_COMMENT), F.col("POLLOCK").cast("int")),
        )
    )
    out = tagged.withColumn("COMMENT", reason)
    filled = F.col("COMMENT").isin(LAST_COD_COMMENT, POLLOCK_COMMENT)
    for code in schemas.WEIGHTS:
        out = out.withColumn(code, F.when(filled, _filled(code)).otherwise(F.col(code)))
    return out.drop(*EVIDENCE)


def directed_keys(tagged: DataFrame) -> DataFrame:
    """The keys under which directed records are reported, each once: with their weights as they
    are, or filled, by the rules they meet."""
    raw = F.struct(*RECORD_KEYS)
    filled = F.struct(*(_filled(c).alias(c) if c in schemas.WEIGHTS else F.col(c) for c in RECORD_KEYS))
    reported = F.array(
        F.when((F.col("N_OTHER") > 0) | F.col("ALL_COD"), raw), F.when(F.col("LAST_COD") | F.col("POLLOCK"), filled)
    )
    keys = tagged.select(F.explode(reported).alias("k")).filter("k IS NOT NULL")
    return keys.select("k.*").distinct()


def species_sought(landings: DataFrame, sought: DataFrame, *, by_record: bool = False) -> Split:
    """Records directed at other species leave.

    By default a record leaves when a directed record has its vessel, trip, dates and weights, so
    twins leave together and a record reported with filled weights stays; ``by_record`` removes
    exactly the directed records.
    """
    return split_directed(tag_directed(landings, sought), by_record=by_record)


def split_directed(tagged: DataFrame, *, by_record: bool = False) -> Split:
    directed = directed_records(tagged)
    if by_record:
        kept = tagged.filter((F.col("N_OTHER") == 0) & ~F.col("ALL_COD") & ~F.col("LAST_COD"))
        kept = kept.filter(~F.col("POLLOCK"))
    else:
        kept = null_safe_join(tagged, directed_keys(tagged), RECORD_KEYS, "left_anti")
    return Split(kept=kept.drop(*EVIDENCE), removed=directed)


def fully_observed_strata(landings: DataFrame, on: Sequence[str] = schemas.STRATUM) -> DataFrame:
    """Strata in which every fishing set was observed."""
    unobserved = count_where(F.col("TRIP").isNull())
    observed = count_where(F.col("TRIP").isNotNull())
    return (
        landings.groupBy(*on)
        .agg(unobserved.alias("N"), observed.alias("Y"))
        .filter((F.col("N") == 0) & (F.col("Y") >= 1))
        .select(*on)
    )


def observed_quarters(landings: DataFrame) -> Split:
    """Strata with 100% observer coverage leave.

    A stratum is a sector, a zone and a quarter, of which the codes and the map allow a bounded
    number, whatever the landings.  They are sent to the landings: by so few keys, a shuffle would put
    all landings into as many tasks.
    """
    full = fully_observed_strata(landings).withColumn("_full", F.lit(True))
    marked = null_safe_join(landings, F.broadcast(full), schemas.STRATUM)
    return Split(
        kept=marked.filter(F.col("_full").isNull()).drop("_full"),
        removed=marked.filter("_full")
        .drop("_full")
        .withColumn("COMMENT", F.lit(FULLY_OBSERVED_COMMENT)),
    )


def trip_evidence(observers: DataFrame, features: DataFrame, sought: DataFrame) -> DataFrame:
    """One row per trip number: has it a non-commercial set, how many feature rows of either kind,
    how many other species did it seek."""
    trip, zero = F.col("TRIP"), F.lit(0).cast("long")
    one = lambda test: F.when(test, 1).otherwise(0).cast("long")
    bare = F.coalesce(F.col("GEARFCD_ID") == NO_PANEL_FEATURE, F.lit(False))
    rows = (
        observers.filter(F.col("SETCD_ID") == NON_COMMERCIAL_SET)
        .select(trip, F.lit(1).cast("long").alias("n"), zero.alias("bare"), zero.alias("panel"), zero.alias("other"))
        .unionByName(
            features.select(trip, zero.alias("n"), one(bare).alias("bare"), one(~bare).alias("panel"), zero.alias("other"))
        )
        .unionByName(
            other_species_trips(sought).select(
                trip, zero.alias("n"), zero.alias("bare"), zero.alias("panel"), F.col("N_OTHER").cast("long").alias("other")
            )
        )
    )
    return rows.groupBy("TRIP").agg(
        (F.sum("n") > 0).alias("NON_COMMERCIAL"),
        F.sum("bare").alias("N_BARE"),
        F.sum("panel").alias("N_PANEL"),
        F.sum("other").cast("int").alias("N_OTHER"),
    )


def join_evidence(landings: DataFrame, evidence: DataFrame) -> DataFrame:
    """Landings with the evidence on their trip number; a missing number matches a missing one.

    Most landings have a missing or a blank number, whose evidence is two rows at most: these are
    sent to the landings, which so need not be shuffled.  Only numbered landings are.
    """
    plain = F.coalesce(F.col("TRIP") == "", F.lit(True))
    renamed = evidence.withColumnRenamed("TRIP", "_TRIP")
    few = F.broadcast(renamed.filter(F.coalesce(F.col("_TRIP") == "", F.lit(True))))
    unnumbered = landings.filter(plain).join(few, F.col("TRIP").eqNullSafe(F.col("_TRIP")), "left")
    numbered = landings.filter(~plain).join(
        renamed.filter(F.col("_TRIP") != ""), F.col("TRIP") == F.col("_TRIP"), "left"
    )
    joined = unnumbered.unionByName(numbered).drop("_TRIP")
    none = {"NON_COMMERCIAL": F.lit(False)} | {c: F.lit(0) for c in ("N_BARE", "N_PANEL", "N_OTHER")}
    return joined.withColumns({c: F.coalesce(c, v) for c, v in none.items()})


LABELS = [
    "NON_COMMERCIAL", "N_BARE", "N_PANEL", "N_KEPT", "N_OTHER", "ALL_COD", "LAST_COD", "POLLOCK",
    "TWIN",
]


def as_is(df: DataFrame) -> DataFrame:
    return df


def label_landings(
    zoned: DataFrame,
    evidence: DataFrame,
    *,
    exclusive: bool = False,
    keep: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Landings, in a zone or not, with all that the splits look at (``LABELS``).

    N_KEPT is how often the panel split keeps the landing.  Direction is judged among the landings
    it keeps, by trip; TWIN says that a directed record is reported with the landing's vessel, trip,
    dates and weights.

    Trips are folded in the tasks that read them, and only those whose sets turn out directed come
    back to the landings; so do the distinct keys of directed records.  Neither holds a trip's
    landings in one task, however many these are.  Both come by trip id, a missing one dealt out once
    for the two of them, so the landings are shuffled once (``tune`` allows that).  ``keep`` writes a
    table that is read more than once: the landings with their evidence, and the two small ones, whose
    size Spark then knows.
    """
    joined = join_evidence(zoned, evidence)
    left = F.when(F.col("N_BARE") + F.col("N_PANEL") == 0, 1).otherwise(F.col("N_PANEL"))
    if exclusive:
        left = F.when(F.col("N_BARE") == 0, 1).otherwise(0)
    here = in_zone() & ~F.col("NON_COMMERCIAL")
    joined = keep(joined.withColumn("N_KEPT", F.when(here, left).otherwise(0).cast("long")))
    judged = F.col("N_KEPT") > 0
    trips = keep(cod_directed_trips(joined.filter(judged)))
    by_trip = {"dealt": ["TRIP_ID"], "salts": TRIP_SALTS}
    joined = join_dealt(deal_out(joined, **by_trip), trips, ["TRIP_ID"], **by_trip)
    turned = F.coalesce("TURNED_TO_COD", F.lit(False))
    joined = joined.withColumns(
        {
            "N_OTHER": F.when(judged, F.col("N_OTHER")).otherwise(0),
            "ALL_COD": judged & F.coalesce("ALL_DIRECTED", F.lit(False)),
            "LAST_COD": judged & turned & is_finite(_cod_ratio()) & _cod_directed(),
            "POLLOCK": judged & pollock_directed(),
        }
    ).drop("ALL_DIRECTED", "TURNED_TO_COD")
    keys = keep(directed_keys(joined))
    joined = join_dealt(joined, keys.withColumn("TWIN", F.lit(True)), RECORD_KEYS, **by_trip)
    return joined.withColumn("TWIN", F.coalesce("TWIN", F.lit(False))).drop(SALT)


def in_zone() -> Column:
    return F.coalesce(F.col("ZONE") >= 1, F.lit(False))


class LandingSplits(NamedTuple):
    commercial: Split
    panel: Split
    directed: Split


def splits_of(labelled: DataFrame, *, exclusive: bool = False, by_record: bool = False) -> LandingSplits:
    """Both sides of the three splits, as filters of the labelled landings."""
    zoned = labelled.filter(in_zone())
    land = schemas.ZONED
    odd = F.col("NON_COMMERCIAL")
    commercial = Split(
        zoned.filter(~odd).select(*land),
        zoned.filter(odd).select(*land, F.lit(NON_COMMERCIAL_COMMENT).alias("COMMENT")).distinct(),
    )
    bare = F.least(F.col("N_BARE"), F.lit(1)) if exclusive else F.col("N_BARE")
    without = zoned.filter(~odd).withColumn("_n", bare).filter("_n > 0")
    kept = zoned.filter("N_KEPT > 0")
    panel = Split(
        repeat_rows(kept.select(*land, "N_KEPT"), "N_KEPT"),
        repeat_rows(without.select(*land, "_n", F.lit(NO_PANEL_COMMENT).alias("COMMENT")), "_n"),
    )
    tagged = repeat_rows(kept.select(*land, *EVIDENCE, "TWIN", "N_KEPT"), "N_KEPT")
    met = (F.col("N_OTHER") > 0) | F.col("ALL_COD") | F.col("LAST_COD") | F.col("POLLOCK")
    gone = met if by_record else F.col("TWIN")
    directed = Split(tagged.filter(~gone).select(*land), directed_records(tagged.drop("TWIN")))
    return LandingSplits(commercial, panel, directed)


def removed_records(*steps: Split) -> DataFrame:
    """Log of the removed records of all splits, in their order."""
    first, *rest = [split.removed.select(*schemas.ZONED, "COMMENT") for split in steps]
    for part in rest:
        first = first.unionByName(part)
    return first
