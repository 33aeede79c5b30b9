"""Report sinks: one directory of part files per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame

from haulback.operators.coverage import CoverageSummary
from haulback.sources.publish import publication

# The sheets of the coverage report.
COVERAGE_SHEETS = {
    "fleet": "FLEET SUMMARY",
    "mean": "MEAN COVERAGE",
    "fleet_all_observed": "FLEETS ALL OBS",
    "stratum": "FLEET-ZONE-Q SUMMARY",
    "stratum_all_observed": "FLEET-ZONE-Q ALL OBS",
}


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write
    if fmt == "csv":
        # Missing stays an empty field; an empty trip number is written as "".
        writer = writer.option("header", True).option("emptyValue", '""')
    writer.format(fmt).save(path)


def _write_set(tables: dict[str, DataFrame], directory: str, fmt: str) -> None:
    """Tables by their names in the directory, put in place together."""
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    with publication(spark, directory) as stage:
        for name, df in tables.items():
            _write(df, stage.path(name), fmt)


def report_names(tables: Iterable[str], year: int, run_date: dt.date | None = None) -> dict[str, str]:
    """What each report is called in its directory, which carries the year and the run date."""
    day = (run_date or dt.date.today()).isoformat()
    return {name: f"Discards_{name}_{year}_{day}" for name in tables}


def coverage_names(run_date: dt.date | None = None) -> dict[str, str]:
    """What each sheet of the coverage report is called."""
    day = (run_date or dt.date.today()).isoformat()
    base = f"Discards_ObsCoverageSummary_{day}"
    return {sheet: f"{base}/{sheet.replace(' ', '_')}" for sheet in COVERAGE_SHEETS.values()}


def write_reports(
    tables: dict[str, DataFrame],
    directory: str,
    year: int,
    run_date: dt.date | None = None,
    fmt: str = "csv",
    coverage: CoverageSummary | None = None,
) -> dict[str, str]:
    """Write each table under a name carrying year and run date, and the sheets of ``coverage``;
    returns the paths. A run that fails leaves the reports of a former one whole."""
    names = report_names(tables, year, run_date)
    named = {names[name]: df for name, df in tables.items()}
    if coverage is not None:
        names |= coverage_names(run_date)
        named |= _sheets(coverage, run_date)
    _write_set(named, directory, fmt)
    return {name: f"{directory}/{place}" for name, place in names.items()}


def _sheets(summary: CoverageSummary, run_date: dt.date | None) -> dict[str, DataFrame]:
    names = coverage_names(run_date)
    return {names[sheet]: getattr(summary, field) for field, sheet in COVERAGE_SHEETS.items()}


def write_coverage(
    summary: CoverageSummary, directory: str, run_date: dt.date | None = None, fmt: str = "csv"
) -> dict[str, str]:
    """Write the five coverage tables, one per sheet name."""
    _write_set(_sheets(summary, run_date), directory, fmt)
    return {sheet: f"{directory}/{place}" for sheet, place in coverage_names(run_date).items()}
