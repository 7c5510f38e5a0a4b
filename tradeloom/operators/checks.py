"""Data-quality checks; every check returns a DataFrame of violations.

A suite can be measured while its table is written (``WriteChecks``): all
checks but uniqueness are then known without reading the table again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradeloom.config import Check, Feed

REPORT_DDL = "check string, columns string, severity string, failures bigint, note string"


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    )


def null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def value_violations(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _now(as_of: str | None, timezone: str) -> Column:
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz")
    zone = F.lit(timezone)
    return F.convert_timezone(F.current_timezone(), zone, F.localtimestamp())


def _newest(column: str, now: Column) -> Column:
    at = F.col(column).cast("timestamp_ntz")
    return F.max(F.when(at <= now, at))


def _stale(newest: Column, now: Column, days: int) -> Column:
    floor = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.coalesce(newest, floor) < F.timestamp_add("DAY", F.lit(-days), now)


def recency_violations(
    df: DataFrame,
    column: str,
    days: int,
    as_of: str | None = None,
    timezone: str = "America/Los_Angeles",
) -> DataFrame:
    """One row when the newest value is older than ``days`` before now.

    Values in the future do not count; a column without values is stale.
    """
    now = _now(as_of, timezone)
    return df.agg(_newest(column, now).alias("max_timestamp")).where(
        _stale(F.col("max_timestamp"), now, days)
    )


def _line(check: Check, failures: Column, note: str = "") -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(",".join(check.columns)).alias("columns"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        F.lit(note).alias("note"),
    )


def _missing(check: Check, df: DataFrame) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in check.columns if c.lower() not in have]


def _measures(df: DataFrame, checks: Sequence[Check], now: Column) -> dict[str, Column]:
    """The aggregate of every check that needs no groups, by its place in the suite."""
    found = {}
    for i, check in enumerate(checks):
        if check.kind == "unique" or _missing(check, df):
            continue
        column = check.columns[0]
        if check.kind == "not_null":
            aggregate = F.count_if(F.col(column).isNull())
        elif check.kind == "accepted":
            aggregate = F.count_if(~F.col(column).isin(list(check.values)))
        elif check.kind == "recent":
            aggregate = _stale(_newest(column, now), now, check.days).cast("bigint")
        else:
            raise ValueError(f"unknown check {check.kind!r}")
        found[f"_check{i}"] = aggregate
    return found


class WriteChecks:
    """Measures a suite on the rows of one write.

    ``watch`` goes around the frame that is written, as the last step before
    the write: its tasks are counted once each, also when executors are lost
    and tasks run again. ``measured`` is ``None`` until a watched write ends.
    """

    def __init__(
        self, checks: Feed | Sequence[Check], as_of: str | None = None, timezone: str = "America/Los_Angeles"
    ):
        self.checks = checks.checks if isinstance(checks, Feed) else tuple(checks)
        self.as_of, self.timezone = as_of, timezone
        self._seen: Observation | None = None
        self._empty = False

    def watch(self, df: DataFrame) -> DataFrame:
        measures = _measures(df, self.checks, _now(self.as_of, self.timezone))
        self._empty = not measures
        if self._empty:
            return df
        self._seen = Observation()
        return df.observe(self._seen, *[m.alias(name) for name, m in measures.items()])

    @property
    def measured(self) -> Mapping[str, int] | None:
        if self._seen is None:
            return {} if self._empty else None
        return self._seen.get

    def report(self, written: DataFrame) -> DataFrame:
        """The report of ``run_checks``; only uniqueness reads the written table."""
        return run_checks(written, self.checks, self.as_of, self.timezone, self.measured)


def run_checks(
    df: DataFrame,
    checks: Feed | Sequence[Check],
    as_of: str | None = None,
    timezone: str = "America/Los_Angeles",
    measured: Mapping[str, int] | None = None,
) -> DataFrame:
    """One report row per check: rows at fault, for ``unique`` groups at fault.

    All checks but ``unique`` share one aggregation pass, or none if they were
    ``measured`` while the table was written. A check on a column the table
    does not have is reported with no count.
    """
    checks = checks.checks if isinstance(checks, Feed) else checks
    measures = _measures(df, checks, _now(as_of, timezone))
    lines, reports = [], []
    for i, check in enumerate(checks):
        name = f"_check{i}"
        missing = _missing(check, df)
        if missing:
            lines.append(_line(check, F.lit(None), f"no column {', '.join(missing)}"))
        elif check.kind == "unique":
            groups = unique_violations(df, check.columns).agg(F.count(F.lit(1)).alias("n"))
            reports.append(groups.select(_line(check, F.col("n")).alias("line")))
        else:
            lines.append(_line(check, F.col(name) if measured is None else F.lit(measured[name])))
    if lines:
        aggregates = [m.alias(name) for name, m in measures.items()] if measured is None else []
        base = df.agg(*aggregates) if aggregates else df.sparkSession.range(1)
        reports.insert(0, base.select(F.explode(F.array(*lines)).alias("line")))
    if not reports:
        return df.sparkSession.createDataFrame([], REPORT_DDL)
    return reduce(DataFrame.unionByName, reports).select("line.*")
