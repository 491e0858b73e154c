"""The checks of bronze and silver kept up to date load by load.

Each load adds what it changes to a ledger of counts: nulls, values that are not accepted, ids with copies, the newest
time of ingestion. Silver's latest copies come from the index of copies, before and after the load, so a run reads
the loads that are new and the index buckets of their ids. The report is that of the checks in full.

A change must count once. A load that is replaced after it was counted, and a run that died while writing, make the
ledger be counted anew from all of bronze.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import quality
from eventmart.operators.quality import BRONZE, SILVER, Checks
from eventmart.operators.silver import event_facts
from eventmart.sources import copies, files, progress
from eventmart.sources.bronze import read_loads, read_raw_events
from eventmart.sources.layout import Layout
from eventmart.sources.progress import CHECKS as NAME
from eventmart.sources.progress import EVERYTHING
from eventmart.sources.staging import dropped_after, stage

_LEDGER = "model string, column string, check string, value string, n long, newest timestamp_ntz"
_NULLS, _UNIQUE, _ACCEPTED, _FRESH = "not_null", "unique", "accepted_values", "freshness"


def _entry(model: str, column: str, check: str, value: Column | None = None, n: Column | None = None) -> Column:
    return F.struct(
        F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(check).alias("check"),
        (F.lit(None) if value is None else value).cast("string").alias("value"),
        (F.lit(0) if n is None else n).cast("long").alias("n"),
    )


def _entries(rows: DataFrame, entries: list[Column], newest: Column | None = None) -> DataFrame:
    return rows.select(F.explode(F.array(*entries)).alias("e"), (F.lit(None) if newest is None else newest).cast("timestamp_ntz").alias("newest")).select("e.*", "newest")


def _bronze_counts(rows: DataFrame) -> DataFrame:
    """Nulls of rows, in one pass, and the newest time of ingestion."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in BRONZE.not_null], F.max("ingested_at").alias("newest"))
    entries = [_entry(BRONZE.model, c, _NULLS, n=F.col(c)) for c in BRONZE.not_null]
    entries.append(_entry(BRONZE.model, "ingested_at", _FRESH))
    return _entries(counts, entries, F.col("newest"))


def _copied(rows: DataFrame, times: int) -> DataFrame:
    """How many ids have copies."""
    ids = rows.filter("event_id is not null").groupBy("event_id").agg(F.count("*").alias("n")).filter("n > 1")
    counts = ids.agg((F.count("*") * times).alias("n"))
    return _entries(counts, [_entry(BRONZE.model, "event_id", _UNIQUE, n=F.col("n"))])


def _silver_counts(facts: DataFrame, times: int) -> DataFrame:
    """Nulls of the latest copies, and values that are not accepted; each row counts some times."""
    nulls = facts.agg(*[(F.count_if(F.col(c).isNull()) * times).alias(c) for c in SILVER.not_null])
    parts = [_entries(nulls, [_entry(SILVER.model, c, _NULLS, n=F.col(c)) for c in SILVER.not_null])]
    for column, accepted in SILVER.accepted.items():
        odd = facts.filter(~F.col(column).isin(list(accepted))).groupBy(column).agg((F.count("*") * times).alias("n"))
        parts.append(_entries(odd, [_entry(SILVER.model, column, _ACCEPTED, F.col(column), F.col("n"))]))
    return reduce(DataFrame.unionByName, parts)


def _counted(counts: DataFrame, checks: Checks, check: str, columns: list[str], failures: Column) -> DataFrame:
    """Report rows of a check, from the ledger's sums; a column that nothing was counted for has no failures."""
    named = counts.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], "_column string, _at int")
    of = counts.filter((F.col("model") == checks.model) & (F.col("check") == check))
    found = of.groupBy("column").agg(failures.alias("failures"))
    rows = named.join(found, F.col("_column") == F.col("column"), "left").orderBy("_at")
    severity, n = checks.severity(check), F.coalesce("failures", F.lit(0).cast("long"))
    return rows.select(
        F.lit(checks.model).alias("model"), F.col("_column").alias("column"), F.lit(check).alias("check"),
        F.lit(severity).alias("severity"), n.alias("failures"), F.when(n == 0, "pass").otherwise(severity).alias("status"),
    )


@dataclass(frozen=True)
class CheckLedger:
    """Counts of failures below a layout."""

    spark: SparkSession
    layout: Layout

    def _write(self, entries: DataFrame, part: str) -> None:
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.layout.ledger}/part={part}")

    def build(self) -> None:
        """Count everything anew."""
        raw = read_raw_events(self.spark, self.layout)
        done = progress.pending(self.spark, self.layout, NAME)
        out = sorted(progress.arriving(self.spark, self.layout))
        raw = raw.filter(~F.col("load").isin(out))
        progress.started(self.spark, self.layout, NAME, done, [EVERYTHING])
        files.delete(self.spark, self.layout.ledger)
        parts = [_bronze_counts(raw), _copied(raw, 1), _silver_counts(event_facts(raw), 1)]
        self._write(reduce(DataFrame.unionByName, parts), "all")
        progress.finished(self.spark, self.layout, NAME, done)

    def update(self) -> None:
        """Count the loads that are new."""
        _, died = progress.interrupted(self.spark, self.layout, NAME)
        if died or not files.exists(self.spark, self.layout.ledger):
            return self.build()
        loads = progress.pending(self.spark, self.layout, NAME)
        if loads:
            with dropped_after(self.spark):
                self._merge(loads)
        return None

    def _merge(self, loads: list[str]) -> None:
        rows = read_loads(self.spark, self.layout, loads)
        found, _ = stage(copies.find(rows, self.layout), "copies")
        # Listed when the copies have been read: whatever load they are of is known by then.
        arriving = progress.arriving(self.spark, self.layout)
        later = sorted({*arriving, *progress.pending(self.spark, self.layout, NAME)} - set(loads))
        after = found.filter(~F.col("load").isin(later))
        before = found.filter(~F.col("load").isin([*later, *loads]))
        parts = [_bronze_counts(rows), _copied(after, 1), _copied(before, -1)]
        parts += [_silver_counts(event_facts(after), 1), _silver_counts(event_facts(before), -1)]
        entries, _ = stage(reduce(DataFrame.unionByName, parts), "entries")
        progress.started(self.spark, self.layout, NAME, loads, [EVERYTHING])
        self._write(entries, uuid.uuid4().hex)
        progress.finished(self.spark, self.layout, NAME, loads)

    def report(self, now: datetime | None = None) -> DataFrame:
        """The report rows of bronze and silver, as the checks in full give them. With `now`, freshness as well."""
        ledger = self.spark.read.schema(_LEDGER).parquet(self.layout.ledger)
        sums = ledger.groupBy("model", "column", "check", "value").agg(F.sum("n").alias("n"))
        total, values = F.sum("n"), F.count_if(F.col("n") > 0)
        parts = [
            _counted(sums, BRONZE, _NULLS, list(BRONZE.not_null), total),
            _counted(sums, BRONZE, _UNIQUE, list(BRONZE.unique), total),
        ]
        if now is not None:
            newest = ledger.filter(F.col("check") == _FRESH).select(F.col("newest").alias("ingested_at"))
            parts.append(quality.freshness(newest, BRONZE, "ingested_at", now))
        parts += [
            _counted(sums, SILVER, _NULLS, list(SILVER.not_null), total),
            # Silver holds one copy of each id.
            _counted(sums, SILVER, _UNIQUE, list(SILVER.unique), total),
            _counted(sums, SILVER, _ACCEPTED, list(SILVER.accepted), values),
        ]
        return reduce(DataFrame.unionByName, parts)
