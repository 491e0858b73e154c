"""Bronze tables: append-only loads of day-partitioned Parquet.

A load is written once, to a folder of its own outside the tables, good rows by day and bad ones apart; then its
folders are moved to `ingested_date=<day>/load=<id>`, and a note says which days it has. So readers that know the
days or the loads they want open nothing else. Writing a load again replaces it, so a replayed batch adds no
rows. Each load also adds its part to the index of copies.

While a load is written a marker says so, since tables that merge changes must not count a part of it. One that
is replaced after the hourly fact took it in makes the fact compute the days it is about anew.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import DEAD_LETTER, RAW_EVENTS
from eventmart.sources import copies, files, progress
from eventmart.sources.layout import Layout

_LOAD = [T.StructField("load", T.StringType())]
_DAY = [T.StructField("ingested_date", T.DateType())]
# What a load is written in: rows that decode, by day, and the others.
_GOOD, _BAD = "rows", "dead"
_NO_DAY = "ingested_date=__HIVE_DEFAULT_PARTITION__"


def create_tables(spark: SparkSession, layout: Layout) -> None:
    """Make the bronze directories if they are missing; an empty one is an empty table."""
    for path in (layout.raw_events, layout.dead_letter):
        files.make_directory(spark, path)


# -- writing


def write_load(rows: DataFrame, layout: Layout, load: str, *, rebalance: bool = False) -> None:
    """Write bronze rows as one load, sorted so that row groups can be skipped by type and repo.

    A micro-batch is written without a shuffle. Use `rebalance` for bulk loads that span many days,
    so that every task does not write a file per day.
    """
    dated = rows.select(*RAW_EVENTS.fieldNames(), F.to_date("ingested_at").alias("ingested_date"), F.lit(_GOOD).alias("kind"))
    if rebalance:
        dated = dated.hint("rebalance", "ingested_date")
    _write(dated, layout, load)


def write_batch(decoded: DataFrame, layout: Layout, load: str) -> None:
    """Write decoded messages as one load, in one pass: those with a `reason` to the dead letter table.

    The gold tables lack the load from then on.
    """
    is_good = F.col("reason").isNull()

    def only(condition: Column, names: list[str]) -> list[Column]:
        return [F.when(condition, F.col(n)).alias(n) for n in names]

    rows = decoded.select(
        *only(is_good, RAW_EVENTS.fieldNames()),
        *only(~is_good, DEAD_LETTER.fieldNames()),
        F.when(is_good, F.to_date("ingested_at")).alias("ingested_date"),
        F.when(is_good, _GOOD).otherwise(_BAD).alias("kind"),
    )
    _write(rows, layout, load, pending=True)


def _write(rows: DataFrame, layout: Layout, load: str, pending: bool = False) -> None:
    (
        rows.sortWithinPartitions("kind", "ingested_date", "event_type", "repo_name")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("kind", "ingested_date")
        .parquet(layout.incoming(load))
    )
    _take_in(rows.sparkSession, layout, load, pending)


def _take_in(spark: SparkSession, layout: Layout, load: str, pending: bool) -> None:
    """Move what was written for a load into the tables, in place of an earlier try."""
    written, arriving = layout.incoming(load), f"{layout.arriving}/{load}"
    again = has_load(spark, layout, load)
    if again and load not in progress.pending(spark, layout, progress.FACT):
        # The fact has counted it. The days of all copies of its events are told before it is replaced.
        days = copies.find(read_loads(spark, layout, [load]), layout).select(F.to_date("event_created_at"))
        path = progress.note_days(layout, progress.FACT, days)
        progress.started(spark, layout, progress.FACT, [], [path])
    if again and load not in progress.pending(spark, layout, progress.CHECKS):
        progress.started(spark, layout, progress.CHECKS, [], [progress.EVERYTHING])
    files.write_text(spark, arriving, "")
    days = files.directories_in(spark, f"{written}/kind={_GOOD}")
    earlier = days_of(spark, layout, load)
    # Noted before the first is moved, so that whatever comes of it is found and replaced.
    _note_days(spark, layout, load, sorted({*earlier, *days}))
    for day in earlier:
        files.delete(spark, f"{layout.raw_events}/{day}/load={load}")
    for day in days:
        files.move(spark, f"{written}/kind={_GOOD}/{day}", f"{layout.raw_events}/{day}/load={load}")
    dead = f"{written}/kind={_BAD}/{_NO_DAY}"
    files.delete(spark, f"{layout.dead_letter}/load={load}")
    if files.exists(spark, dead):
        files.move(spark, dead, f"{layout.dead_letter}/load={load}")
    if again:
        copies.remove(spark, layout, load)
    copies.add(read_loads(spark, layout, [load]), layout, load)
    _note_days(spark, layout, load, days)
    files.delete(spark, written)
    if pending:
        for table in progress.TABLES:
            progress.wait(spark, layout, table, load)
    # Last, so that at any time it is known to be on its way, or pending.
    files.delete(spark, arriving)


def _note_days(spark: SparkSession, layout: Layout, load: str, days: list[str]) -> None:
    files.write_text(spark, layout.load_days(load), json.dumps({"days": days}))


def delete_load(spark: SparkSession, layout: Layout, load: str) -> None:
    """Delete the rows of a load, its part of the index, and last the note of it."""
    for day in days_of(spark, layout, load):
        files.delete(spark, f"{layout.raw_events}/{day}/load={load}")
    copies.remove(spark, layout, load)
    files.delete(spark, layout.load_days(load))


# -- reading


def has_load(spark: SparkSession, layout: Layout, load: str) -> bool:
    return files.exists(spark, layout.load_days(load))


def days_of(spark: SparkSession, layout: Layout, load: str) -> list[str]:
    """The day folders a load is in."""
    path = layout.load_days(load)
    return json.loads(files.read_text(spark, path))["days"] if files.exists(spark, path) else []


def read_raw_events(spark: SparkSession, layout: Layout) -> DataFrame:
    """All loads, with the `load` and `ingested_date` partition columns."""
    files.make_directory(spark, layout.raw_events)
    return spark.read.schema(T.StructType(RAW_EVENTS.fields + _DAY + _LOAD)).parquet(layout.raw_events)


def read_parts(spark: SparkSession, layout: Layout, parts: list[str]) -> DataFrame:
    """The rows in some folders below the table; no other folder is listed."""
    schema = T.StructType(RAW_EVENTS.fields + _DAY + _LOAD)
    if not parts:
        return spark.createDataFrame([], schema)
    paths = [f"{layout.raw_events}/{part}" for part in parts]
    return spark.read.schema(schema).option("basePath", layout.raw_events).parquet(*paths)


def read_loads(spark: SparkSession, layout: Layout, loads: list[str]) -> DataFrame:
    """The rows of some loads."""
    parts = [f"{day}/load={load}" for load in loads for day in days_of(spark, layout, load)]
    # One that is being replaced may lack some of its folders.
    return read_parts(spark, layout, [p for p in parts if files.exists(spark, f"{layout.raw_events}/{p}")])


def read_days(spark: SparkSession, layout: Layout, days: list) -> DataFrame:
    """The rows ingested on some days; None stands for rows without a time of ingestion."""
    folders = [_NO_DAY if day is None else f"ingested_date={day.isoformat()}" for day in days]
    return read_parts(spark, layout, [f for f in folders if files.exists(spark, f"{layout.raw_events}/{f}")])


def part_of(day, load: str) -> str:
    """The folder of a load's rows of a day."""
    return f"{_NO_DAY if day is None else f'ingested_date={day.isoformat()}'}/load={load}"


def read_dead_letters(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(T.StructType(DEAD_LETTER.fields + _LOAD)).parquet(layout.dead_letter)
