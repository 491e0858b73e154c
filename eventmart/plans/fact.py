"""The hourly fact as a table: built in full, or merged with what a load changes.

Exact distinct counts are kept mergeable as reference counts: how many events of an hour and type name an actor,
and how many name an entity. A load adds references where its events are, and takes them from where the copies
were that counted before. It writes these changes, as a part of their own below each day, and computes the rows
of the hours and types it changed from all parts of these. Bronze is not read: the copies come from the index.

A change must count once. So a load that no marker names as pending is not merged again, and days an update died
over are made anew from bronze, without the loads that are still pending.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.time import lookback_day
from eventmart.operators.dedup import copies_of
from eventmart.operators.hourly import REFERENCES, fact_of, references
from eventmart.operators.silver import event_facts
from eventmart.schemas import HOURLY_FACT
from eventmart.sources import copies, files, progress
from eventmart.sources.bronze import read_loads, read_raw_events
from eventmart.sources.layout import Layout
from eventmart.sources.progress import EVERYTHING
from eventmart.sources.progress import FACT as NAME
from eventmart.sources.staging import dropped_after, stage

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: hours a look-back goes back.
LOOKBACK_HOURS = 3


def _day() -> Column:
    return F.to_date("event_created_at")


@dataclass(frozen=True)
class _Days:
    """Days to be made anew, as a table, and their bounds for the scan."""

    table: DataFrame
    low: date | None
    high: date | None
    no_day: bool

    @staticmethod
    def of_list(days: list[date | None], table: DataFrame) -> _Days:
        named = [d for d in days if d is not None]
        return _Days(table, min(named, default=None), max(named, default=None), None in days)

    def of(self, rows: DataFrame) -> DataFrame:
        """Rows on these days, those without a day if that is one of them."""
        time = F.col("event_created_at")
        bounds = F.lit(False)
        if self.low is not None:
            bounds = time >= F.lit(datetime.combine(self.low, datetime.min.time()))
            # The last day a timestamp can name has no day after it.
            if self.high < date.max:
                bounds = bounds & (time < F.lit(datetime.combine(self.high + timedelta(days=1), datetime.min.time())))
        if self.no_day:
            bounds = bounds | time.isNull()
        wanted = self.table.select(F.col("day").alias("_day"))
        return rows.filter(bounds).join(wanted, _day().eqNullSafe(F.col("_day")), "left_semi")


@dataclass(frozen=True)
class FactTable:
    """The hourly fact below a layout."""

    spark: SparkSession
    layout: Layout

    def read(self) -> DataFrame:
        """The table, with its day partition as a column to filter on: `event_date`."""
        schema = T.StructType([*HOURLY_FACT.fields, T.StructField("event_date", T.DateType())])
        return self.spark.read.schema(schema).parquet(self.layout.fact)

    def _write(self, rows: DataFrame, mode: str) -> None:
        dated = rows.withColumn("event_date", F.to_date("event_hour"))
        (
            dated.hint("rebalance", "event_date")
            .sortWithinPartitions("event_date", "event_type")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy("event_date")
            .parquet(self.layout.fact)
        )

    # -- references

    def _references(self, days: list[date | None] | None = None) -> DataFrame:
        """Changes to reference counts, of all days or some; each part is one write."""
        fields = [*REFERENCES.fields, T.StructField("event_date", T.DateType()), T.StructField("part", T.StringType())]
        reader = self.spark.read.schema(T.StructType(fields))
        root = self.layout.references
        if days is None:
            return reader.parquet(root)
        folders = [f for f in (f"{root}/{_folder(d)}" for d in days) if files.exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], T.StructType(fields))
        return reader.option("basePath", root).parquet(*folders)

    def _write_references(self, changes: DataFrame, part: str) -> None:
        """Add a part to each day that changes, sorted so that hours can be skipped."""
        (
            changes.withColumn("event_date", F.to_date("event_hour"))
            .hint("rebalance", "event_date")
            .withColumn("part", F.lit(part))
            .sortWithinPartitions("event_date", "event_hour", "event_type")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "part")
            .parquet(self.layout.references)
        )

    def compact(self, days: list[date | None]) -> None:
        """Put the parts of some days together as one each, say once a day for the days before."""
        path = progress.note_days(self.layout, NAME, self.spark.createDataFrame([(d,) for d in days], "day date"))
        part = os.path.basename(path)
        staged, _ = stage(_summed(self._references(days)).drop("event_date"), "references")
        progress.started(self.spark, self.layout, NAME, [], [path])
        for day in days:
            files.delete(self.spark, f"{self.layout.references}/{_folder(day)}")
        self._write_references(staged, part)
        progress.finished(self.spark, self.layout, NAME, [])
        files.delete(self.spark, path)

    # -- building

    def build(self, loads: list[str] | None = None) -> None:
        """Build the whole table from bronze. `loads` are logged as done."""
        # Listed before bronze is, so that no load is logged as done that was not read.
        done = loads if loads is not None else progress.pending(self.spark, self.layout, NAME)
        raw = read_raw_events(self.spark, self.layout)
        # Its files are listed by now, so a load that comes later is not read.
        later = [load for load in self._out() if load not in done]
        raw = raw.filter(~F.col("load").isin(later))
        progress.started(self.spark, self.layout, NAME, done, [EVERYTHING])
        files.delete(self.spark, self.layout.references)
        self._write_references(references(event_facts(raw), F.lit(1)), uuid.uuid4().hex)
        self._write(fact_of(_summed(self._references())), "static")
        progress.finished(self.spark, self.layout, NAME, done)

    def update(self, loads: list[str]) -> None:
        """Bring the table up to date with loads that are in bronze and not in the table yet."""
        if not files.exists(self.spark, self.layout.fact) or not files.exists(self.spark, self.layout.references):
            return self.build()
        with dropped_after(self.spark):
            died = self._recover()
            if died is None:
                return self.build()
            pending = progress.pending(self.spark, self.layout, NAME)
            wanted = sorted({load for load in loads if load in pending} | set(died))
            if wanted:
                self._merge(wanted)
        return None

    def _out(self) -> list[str]:
        """Loads that the table has not taken in; on its way before pending, as a load goes from the one to the other."""
        arriving = progress.arriving(self.spark, self.layout)
        return sorted({*arriving, *progress.pending(self.spark, self.layout, NAME)})

    def _merge(self, loads: list[str]) -> None:
        """Take some loads in."""
        found, _ = stage(copies.find(read_loads(self.spark, self.layout, loads), self.layout), "copies")
        # Listed when the copies have been read: whatever load they are of is known by then.
        later = [load for load in self._out() if load not in loads]
        after = event_facts(found.filter(~F.col("load").isin(later)))
        before = event_facts(found.filter(~F.col("load").isin([*later, *loads])))
        changes = references(after.withColumn("_n", F.lit(1)).unionByName(before.withColumn("_n", F.lit(-1))), F.col("_n"))
        changes, _ = stage(changes, "changes")
        keys, _ = stage(changes.select("event_hour", "event_type").distinct(), "keys")
        path = progress.note_days(self.layout, NAME, keys.select(F.to_date("event_hour")))
        days = [r["day"] for r in self.spark.read.schema("day date").parquet(path).collect()]
        if days:
            progress.started(self.spark, self.layout, NAME, loads, [path])
            self._write_references(changes, os.path.basename(path))
            self._rewrite(keys, days)
        progress.finished(self.spark, self.layout, NAME, loads)
        files.delete(self.spark, path)

    def _rewrite(self, keys: DataFrame, days: list[date | None]) -> None:
        """Write the days again with new rows for some hours and types."""
        hours = keys.select(F.col("event_hour").alias("_hour"), F.col("event_type").alias("_type"))

        def same(rows: DataFrame) -> Column:
            return rows["event_hour"].eqNullSafe(F.col("_hour")) & rows["event_type"].eqNullSafe(F.col("_type"))

        changed = self._references(days)
        fresh = fact_of(_summed(changed.join(hours, same(changed), "left_semi")))
        stored = _on_days(self.read(), "event_date", days)
        kept = stored.join(hours, same(stored), "left_anti").drop("event_date")
        rows, _ = stage(fresh.unionByName(kept), "days")
        # A dynamic overwrite leaves a day alone that gets no rows; stored ones of those are deleted.
        left = {r["day"] for r in rows.select(F.to_date("event_hour").alias("day")).distinct().collect()}
        self._write(rows, "dynamic")
        for day in set(days) - left:
            files.delete(self.spark, f"{self.layout.fact}/{_folder(day)}")

    def look_back(self, now: datetime, hours: int = LOOKBACK_HOURS) -> None:
        """Take in what is pending, and recompute the days the last hours fall on, the first of them from its start."""
        if not files.exists(self.spark, self.layout.fact):
            return self.build()
        self.update(progress.pending(self.spark, self.layout, NAME))
        since = lookback_day(now, hours)
        raw = read_raw_events(self.spark, self.layout)
        recent = raw.filter(F.col("event_created_at") >= F.lit(since)).select(_day().alias("day"))
        stored = self.read().filter(F.col("event_date") >= F.lit(since.date())).select("event_date")
        path = progress.note_days(self.layout, NAME, recent.union(stored))
        progress.started(self.spark, self.layout, NAME, [], [path])
        self._recover()
        return None

    # -- recovery

    def _recover(self) -> list[str] | None:
        """Make the days that an earlier run died over anew from bronze, as if it had not begun.

        Returns the loads it was about to take in; None if the whole table has to be built.
        """
        loads, scope = progress.interrupted(self.spark, self.layout, NAME)
        if not all(name != EVERYTHING and files.exists(self.spark, name) for name in scope):
            return None
        if scope:
            noted = self.spark.read.schema("day date").parquet(*scope).distinct()
            days = [r["day"] for r in noted.collect()]
            with dropped_after(self.spark):
                self._rebuild(_Days.of_list(days, noted), days, set(loads))
        # The loads stay pending; only now may the notes go.
        for load in loads:
            progress.wait(self.spark, self.layout, NAME, load)
        progress.finished(self.spark, self.layout, NAME, [])
        for path in scope:
            files.delete(self.spark, path)
        return loads

    def _rebuild(self, days: _Days, listed: list[date | None], loads: set[str]) -> None:
        """Days made anew from bronze, without these loads and others that are not taken in.

        Copies of an event may name other days, so first come the ids with any copy on the days,
        then all copies of those, then the dedup.
        """
        raw = read_raw_events(self.spark, self.layout)
        raw = raw.filter(~F.col("load").isin(sorted({*loads, *self._out()})))
        ids, seen = stage(
            days.of(raw).select("event_id").distinct(), "day-ids", low=F.min("event_id"), high=F.max("event_id")
        )
        facts = days.of(event_facts(copies_of(raw, ids, seen["low"], seen["high"])))
        staged, _ = stage(references(facts, F.lit(1)), "references")
        for day in listed:
            files.delete(self.spark, f"{self.layout.references}/{_folder(day)}")
            files.delete(self.spark, f"{self.layout.fact}/{_folder(day)}")
        self._write_references(staged, uuid.uuid4().hex)
        self._write(fact_of(_summed(self._references(listed))), "dynamic")


def _folder(day: date | None) -> str:
    return f"event_date={NO_DAY if day is None else day.isoformat()}"


def _on_days(rows: DataFrame, column: str, days: list[date | None]) -> DataFrame:
    """Rows of some partitions by day."""
    named = F.col(column).isin([d for d in days if d is not None])
    return rows.filter(named | F.col(column).isNull() if None in days else named)


def _summed(changes: DataFrame) -> DataFrame:
    """Reference counts, from all changes to them; those that are gone are left out."""
    counts = changes.groupBy("event_hour", "event_type", "kind", "value").agg(F.sum("n").alias("n"))
    return counts.filter("n <> 0")
