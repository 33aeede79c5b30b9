"""What each step of the chain took in, repeated, removed and kept, counted as its tables are written.

The counts are observed in the jobs that write the tables, so they cost no pass of their own. They
are held against each other: what one step keeps is what the next takes in, and what goes in comes
out again, kept, removed or repeated as stated. A row that a join loses or doubles shows as lost. A
stage that runs again after the loss of an executor may be counted again, so a difference is a
reason to look, not an error.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from haulback.operators.reconcile import UNRESOLVED
from haulback.operators.splits import in_zone


class Step(NamedTuple):
    """Rows of a step; ``repeated`` are those it adds by design, ``lost`` those it cannot account for."""

    name: str
    taken: int
    repeated: int
    removed: int
    kept: int
    lost: int


def _count(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0))


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def reconciled_counts() -> dict[str, Column]:
    """Of the reconciled landings: rows, landings (each row counts as its share), unresolved rows."""
    return {
        "rows": F.count(F.lit(1)),
        "landings": F.coalesce(F.sum(1 / F.col("COPIES")), F.lit(0.0)),
        "unresolved": _count(F.col("OUTCOME") == UNRESOLVED),
    }


def label_counts(exclusive: bool) -> dict[str, Column]:
    """Of the labelled landings: what each split keeps and removes."""
    commercial = in_zone() & ~F.col("NON_COMMERCIAL")
    bare = F.least(F.col("N_BARE"), F.lit(1)) if exclusive else F.col("N_BARE")
    return {
        "rows": F.count(F.lit(1)),
        "in_zone": _count(in_zone()),
        "non_commercial": _count(in_zone() & F.col("NON_COMMERCIAL")),
        "panel": _sum(F.col("N_KEPT")),
        "no_panel": _sum(F.when(commercial, bare)),
        "neither": _count(commercial & (F.col("N_KEPT") == 0) & (bare == 0)),
        "directed": _sum(F.when(F.col("TWIN"), F.col("N_KEPT"))),
    }


class Accounts:
    """The counts of one run of the chain."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, counts: dict[str, Column]) -> DataFrame:
        """The table, counted by the job that writes it."""
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], *(c.alias(k) for k, c in counts.items()))

    def steps(self) -> list[Step]:
        """Every step of the chain; to be asked for when its tables have been written."""
        pulled, met, labels = (self._seen[n].get for n in ("pulled", "reconciled", "labelled"))
        landings = round(met["landings"])
        resolved = met["rows"] - met["unresolved"]
        here = labels["in_zone"] - labels["non_commercial"]
        panel = labels["panel"] + labels["no_panel"]
        return [
            Step("reconcile", pulled["rows"], met["rows"] - landings, met["unresolved"], resolved, pulled["rows"] - landings),
            Step("zone", resolved, 0, labels["rows"] - labels["in_zone"], labels["in_zone"], resolved - labels["rows"]),
            Step("commercial", labels["in_zone"], 0, labels["non_commercial"], here, 0),
            Step("panel", here, panel + labels["neither"] - here, labels["no_panel"], labels["panel"], labels["neither"]),
            Step("directed", labels["panel"], 0, labels["directed"], labels["panel"] - labels["directed"], 0),
        ]

    def problems(self) -> list[str]:
        """What does not add up; nothing if all does."""
        return [
            f"{s.name}: of {s.taken} rows {abs(s.lost)} are {'lost' if s.lost > 0 else 'there twice'}"
            for s in self.steps()
            if s.lost
        ]
