"""The whole pipeline: ingest, then silver and gold, with checks after each layer."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators import quality
from eventmart.operators.silver import event_facts, silver_events
from eventmart.plans.checks import CheckLedger
from eventmart.plans.dimension import DimensionTable
from eventmart.plans.fact import FactTable
from eventmart.session import configure
from eventmart.sources import files, progress
from eventmart.sources.bronze import create_tables, delete_load, has_load, read_loads, read_raw_events, write_load
from eventmart.sources.layout import Layout
from eventmart.sources.messages import Sink, Source
from eventmart.streaming.ingest import drain
from eventmart.streaming.publish import publish

FULL, INCREMENTAL = "full", "incremental"


class ChecksFailed(RuntimeError):
    """A check of severity error failed; the layers after it were not built."""


@dataclass
class Result:
    """What a run did: events published, rows ingested, and one report row per check."""

    published: int = 0
    ingested: int = 0
    report: list[Row] = field(default_factory=list)


def update_gold(spark: SparkSession, layout: Layout, mode: str = INCREMENTAL) -> None:
    """Bring the gold tables up to date with bronze: from scratch, or by the loads they lack."""
    for name, table, path in (
        (progress.DIMENSION, DimensionTable(spark, layout), layout.dimension),
        (progress.FACT, FactTable(spark, layout), layout.fact),
    ):
        if mode == FULL or not files.exists(spark, path):
            table.build()
        elif missing := progress.pending(spark, layout, name):
            table.update(missing)


def refresh_gold(spark: SparkSession, layout: Layout, interval: str = "5 minutes") -> StreamingQuery:
    """Bring gold up to date at an interval of its own, until the query is stopped.

    Ingest only marks loads as pending; each time, all that are pending are taken in as one update, however
    many there are. Nothing is done where there are none. It must be the only writer of the gold tables.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def run(tick: DataFrame, number: int) -> None:
        if files.directories_in(spark, layout.raw_events):
            update_gold(spark, layout)

    writer = ticks.writeStream.option("checkpointLocation", layout.checkpoint("gold")).foreachBatch(run)
    return writer.trigger(processingTime=interval).start()


def compact_bronze(spark: SparkSession, layout: Layout, loads: list[str], into: str) -> None:
    """Write many small loads as one, say once a day, so that files stay few and large.

    `into` is a new name. Loads are deleted only when all their rows are found in the new one. A note is
    kept meanwhile: should it die, the next call finishes deleting, or begins again.
    """
    finish_compaction(spark, layout)
    waiting = {load for table in (progress.DIMENSION, progress.FACT) for load in progress.pending(spark, layout, table)}
    if waiting & set(loads):
        raise ValueError("gold has not taken in all of these loads")
    if into in loads or has_load(spark, layout, into):
        raise ValueError(f"there is a load named {into} already")
    missing = [load for load in loads if not has_load(spark, layout, load)]
    if missing:
        raise ValueError(f"no such loads: {missing}")
    if files.exists(spark, layout.ledger):
        CheckLedger(spark, layout).update()
    else:
        # Nothing is counted yet, so that no load need be counted by itself.
        progress.finished(spark, layout, progress.CHECKS, loads)
    files.write_text(spark, layout.compacting, json.dumps({"loads": loads, "into": into}))
    write_load(read_loads(spark, layout, loads), layout, into, rebalance=True)
    finish_compaction(spark, layout)


def finish_compaction(spark: SparkSession, layout: Layout) -> None:
    """Delete the loads a compaction has written again; undo one that did not write all of them."""
    if not files.exists(spark, layout.compacting):
        return
    try:
        noted = json.loads(files.read_text(spark, layout.compacting))
    except ValueError:
        # The note was cut short: nothing was written, or all of it is checked when tried again.
        return files.delete(spark, layout.compacting)
    loads, into = noted["loads"], noted["into"]
    if not noted.get("checked"):
        # None is deleted yet: only then can the counts be compared.
        kept = read_loads(spark, layout, loads).count()
        if not has_load(spark, layout, into) or read_loads(spark, layout, [into]).count() != kept:
            delete_load(spark, layout, into)
            return files.delete(spark, layout.compacting)
        files.write_text(spark, layout.compacting, json.dumps(noted | {"checked": True}))
    for load in loads:
        delete_load(spark, layout, load)
    return files.delete(spark, layout.compacting)


def register_views(spark: SparkSession, layout: Layout) -> None:
    """Temporary views over the tables, for SQL."""
    raw = read_raw_events(spark, layout).drop("load", "ingested_date")
    raw.createOrReplaceTempView("raw_events")
    silver_events(raw).createOrReplaceTempView("silver_events")
    # The same rows for queries that do not need the payload, which is then not read.
    event_facts(raw).createOrReplaceTempView("silver_facts")
    if files.exists(spark, layout.dimension):
        DimensionTable(spark, layout).read().createOrReplaceTempView("dim_repo_scd2")
    if files.exists(spark, layout.fact):
        FactTable(spark, layout).read().drop("event_date").createOrReplaceTempView("fct_events_hourly")


def _check(result: Result, *reports: DataFrame) -> None:
    rows = [row for report in reports for row in report.collect()]
    result.report += rows
    failed = [f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in rows if r["status"] == "error"]
    if failed:
        raise ChecksFailed("; ".join(failed))


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    source: Source | None = None,
    *,
    events: Source | None = None,
    sink: Sink | None = None,
    mode: str = INCREMENTAL,
    ingest: bool = True,
    now: datetime | None = None,
) -> Result:
    """Publish new events, drain the source into bronze, check, update gold, check.

    An incremental run checks bronze and silver by the loads that are new.

    `events` are published to `sink`, from which `source` reads; without them that step is left out. With `ingest=False` only silver and gold are refreshed. `now` turns on the freshness check of
    bronze. Failed checks of severity error stop the run.
    """
    configure(spark)
    result = Result()
    create_tables(spark, layout)
    finish_compaction(spark, layout)
    if ingest:
        if events is not None and sink is not None:
            result.published = publish(spark, events, sink, layout)
        if source is None:
            raise ValueError("a source is needed to ingest")
        result.ingested = drain(spark, source, layout)

    ledger = CheckLedger(spark, layout)
    ledger.build() if mode == FULL else ledger.update()
    _check(result, ledger.report(now))

    update_gold(spark, layout, mode)
    _check(
        result,
        quality.run_checks(DimensionTable(spark, layout).read(), quality.DIMENSION),
        quality.run_checks(FactTable(spark, layout).read(), quality.FACT),
    )
    return result
