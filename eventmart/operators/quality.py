"""Data-quality checks: each gives rows (model, column, check, severity, failures, status)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.schemas import EVENT_TYPES

REPORT = ("model", "column", "check", "severity", "failures", "status")

# Age of the newest row at which the source is late, in minutes.
WARN_AFTER_MINUTES = 15
ERROR_AFTER_MINUTES = 60


@dataclass(frozen=True)
class Checks:
    """What must hold for a model. `warn` names the checks that report but do not stop a run."""

    model: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    expressions: dict[str, str] = field(default_factory=dict)
    warn: tuple[str, ...] = ("accepted_values",)

    def severity(self, check: str) -> str:
        return "warn" if check in self.warn else "error"


BRONZE = Checks(
    "raw_events",
    not_null=("event_id", "event_type", "ingested_at"),
    unique=("event_id",),
    # Delivery is at least once, so bronze may hold copies; silver must not.
    warn=("unique",),
)
SILVER = Checks(
    "silver_events",
    not_null=("event_id", "event_type", "repo_name", "event_created_at"),
    unique=("event_id",),
    accepted={"event_type": EVENT_TYPES},
)
DIMENSION = Checks(
    "dim_repo_scd2",
    not_null=("repo_version_key", "repo_name", "valid_from", "is_current"),
    unique=("repo_version_key",),
)
FACT = Checks(
    "fct_events_hourly",
    not_null=("event_hour", "event_type", "event_count"),
    expressions={"event_count": "event_count >= 0"},
)


def _report(counts: DataFrame, checks: Checks, check: str, columns: list[str]) -> DataFrame:
    """Turn one row of failure counts, a column each, into report rows."""
    severity = checks.severity(check)
    entries = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("failures")) for c in columns])
    )
    return counts.select(entries.alias("e")).select(
        F.lit(checks.model).alias("model"),
        F.col("e.column"),
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        F.col("e.failures"),
        F.when(F.col("e.failures") == 0, "pass").otherwise(severity).alias("status"),
    )


def not_null(rows: DataFrame, checks: Checks) -> DataFrame:
    """Null values per column, all columns in one pass."""
    columns = list(checks.not_null)
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _report(counts, checks, "not_null", columns)


def expression_is_true(rows: DataFrame, checks: Checks) -> DataFrame:
    """Rows where the expression is false; null does not fail."""
    columns = list(checks.expressions)
    counts = rows.agg(*[F.count_if(~F.expr(e)).alias(c) for c, e in checks.expressions.items()])
    return _report(counts, checks, "expression_is_true", columns)


def unique(rows: DataFrame, checks: Checks, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    repeated = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
    return _report(repeated.agg(F.count("*").alias(column)), checks, "unique", [column])


def accepted_values(rows: DataFrame, checks: Checks, column: str) -> DataFrame:
    """Distinct values outside the accepted ones; null does not fail."""
    outside = rows.filter(~F.col(column).isin(list(checks.accepted[column])))
    return _report(outside.agg(F.countDistinct(column).alias(column)), checks, "accepted_values", [column])


def freshness(rows: DataFrame, checks: Checks, column: str, now: datetime | Column) -> DataFrame:
    """Age of the newest row: warn after 15 minutes, error after 60 or where there are no rows."""
    now = F.lit(now) if isinstance(now, datetime) else now
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 60_000_000
    status = (
        F.when(age <= WARN_AFTER_MINUTES, "pass").when(age <= ERROR_AFTER_MINUTES, "warn").otherwise("error")
    )
    return (
        rows.agg(F.max(column).alias("newest"))
        .select(status.alias("status"))
        .select(
            F.lit(checks.model).alias("model"),
            F.lit(column).alias("column"),
            F.lit("freshness").alias("check"),
            F.when(F.col("status") == "pass", "error").otherwise(F.col("status")).alias("severity"),
            (F.col("status") != "pass").cast("bigint").alias("failures"),
            "status",
        )
    )


def run_checks(rows: DataFrame, checks: Checks) -> DataFrame:
    """All checks of a model as one report."""
    parts = []
    if checks.not_null:
        parts.append(not_null(rows, checks))
    if checks.expressions:
        parts.append(expression_is_true(rows, checks))
    parts += [unique(rows, checks, column) for column in checks.unique]
    parts += [accepted_values(rows, checks, column) for column in checks.accepted]
    return reduce(DataFrame.unionByName, parts)
