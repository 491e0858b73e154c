"""What the tables still lack, what was being written, and a log of the runs.

Progress is kept in small marker files, one per load that a table has not taken in yet and one per
write under way. They are deleted when done, so there are few at any time however long the pipeline
has been running.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from eventmart.sources import files
from eventmart.sources.layout import Layout

DIMENSION = "dim_repo_scd2"
FACT = "fct_events_hourly"
CHECKS = "checks"
# What takes in loads one by one.
TABLES = (DIMENSION, FACT, CHECKS)
# Scope of a write of the whole table.
EVERYTHING = "*"

RUN_LOG = "logged_at timestamp, load string, rows_ingested long, dead_letters long, rows_published long"


def loaded(spark: SparkSession, layout: Layout, load: str, rows: int, dead_letters: int) -> None:
    """Note a load that is in bronze: the gold tables lack it, and the run log counts it."""
    for table in TABLES:
        wait(spark, layout, table, load)
    _log(spark, layout, load, rows_ingested=rows, dead_letters=dead_letters)


def wait(spark: SparkSession, layout: Layout, table: str, load: str) -> None:
    """Note that a table lacks a load."""
    files.write_text(spark, f"{layout.pending(table)}/{load}", "")


def published(spark: SparkSession, layout: Layout, batch: str, rows: int) -> None:
    """Note a batch of events that was published."""
    _log(spark, layout, batch, rows_published=rows)


def _log(spark: SparkSession, layout: Layout, load: str, **counts: int) -> None:
    entry = {"logged_at": datetime.now(UTC).isoformat(), "load": load, **counts}
    files.write_text(spark, f"{layout.run_log}/{uuid.uuid4().hex}.json", json.dumps(entry))


def run_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """Loads and published batches with their row counts."""
    files.make_directory(spark, layout.run_log)
    return spark.read.schema(RUN_LOG).json(layout.run_log)


def pending(spark: SparkSession, layout: Layout, table: str) -> list[str]:
    """Loads in bronze the table has not taken in."""
    return files.names_in(spark, layout.pending(table))


def arriving(spark: SparkSession, layout: Layout) -> list[str]:
    """Loads that are being written, or were when a run died."""
    return files.names_in(spark, layout.arriving)


def note_days(layout: Layout, table: str, days: DataFrame) -> str:
    """Write the distinct days of a frame to a folder, whose name can be the scope of a write."""
    path = f"{layout.days(table)}/{uuid.uuid4().hex}"
    days.toDF("day").distinct().coalesce(1).write.parquet(path)
    return path


def started(spark: SparkSession, layout: Layout, table: str, loads: list[str], scope: list) -> None:
    """Note that partitions in `scope` are about to be overwritten for these loads."""
    text = json.dumps({"loads": loads, "scope": scope})
    files.write_text(spark, f"{layout.started(table)}/{uuid.uuid4().hex}.json", text)


def finished(spark: SparkSession, layout: Layout, table: str, loads: list[str]) -> None:
    """Note that the table has taken in these loads and no write is under way."""
    for load in loads:
        files.delete(spark, f"{layout.pending(table)}/{load}")
    files.delete(spark, layout.started(table))


def interrupted(spark: SparkSession, layout: Layout, table: str) -> tuple[list[str], list]:
    """Loads and scope of writes that started and did not finish."""
    loads: set[str] = set()
    scope: set = set()
    for name in files.names_in(spark, layout.started(table)):
        try:
            entry = json.loads(files.read_text(spark, f"{layout.started(table)}/{name}"))
        except ValueError:
            # The note itself was cut short.
            entry = {"loads": [], "scope": [EVERYTHING]}
        loads.update(entry["loads"])
        scope.update(entry["scope"])
    return sorted(loads), sorted(scope, key=str)


def columns(spark: SparkSession, layout: Layout, table: str) -> dict[str, dict[str, str]]:
    """Names of the columns earlier writes gave the table, each with its type and JSON path."""
    return _noted(spark, layout, table).get("columns", {})


def buckets(spark: SparkSession, layout: Layout, table: str) -> int | None:
    """The number of buckets the table was built with."""
    return _noted(spark, layout, table).get("buckets")


def high_water(spark: SparkSession, layout: Layout, table: str) -> datetime | None:
    """The largest time in the table when it was last written."""
    path = f"{layout.columns(table)}-high-water"
    text = files.read_text(spark, path) if files.exists(spark, path) else ""
    return datetime.fromisoformat(text) if text else None


def set_high_water(spark: SparkSession, layout: Layout, table: str, time: datetime | None) -> None:
    files.write_text(spark, f"{layout.columns(table)}-high-water", time.isoformat() if time else "")


def _noted(spark: SparkSession, layout: Layout, table: str) -> dict:
    path = layout.columns(table)
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else {}


def set_columns(spark: SparkSession, layout: Layout, table: str, wanted: dict[str, dict[str, str]], buckets: int) -> None:
    """Note the columns and the number of buckets the table has from now on."""
    noted = {"columns": wanted, "buckets": buckets}
    if _noted(spark, layout, table) != noted:
        files.write_text(spark, layout.columns(table), json.dumps(noted))
