"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.json import normalised
from eventmart.functions.time import hours_ago, lookback_day
from eventmart.operators import quality
from eventmart.operators.decode import bronze_rows, dead_letters, decode
from eventmart.operators.hourly import hourly_fact
from eventmart.operators.publish import as_messages, keyed_events, new_events
from eventmart.operators.scd2 import change_log, dimension
from eventmart.operators.silver import copies_about, entity_events, event_facts, recent_facts, silver_events, typed_events
from eventmart.plans import marts
from eventmart.plans.dimension import DimensionTable
from eventmart.plans.fact import LOOKBACK_HOURS, FactTable
from eventmart.schemas import RAW_EVENTS
from eventmart.session import configure, scratch_dir
from eventmart.sources import fixtures, progress
from eventmart.sources.bronze import create_tables, read_days, write_load
from eventmart.sources.layout import Layout
from eventmart.sources.messages import file_sink, file_source
from eventmart.streaming.ingest import drain
from eventmart.streaming.publish import publish

Query = Callable[[SparkSession, str], DataFrame]

# Fixed inputs of the queries; the oracles state the same.
NOW = datetime(2024, 1, 30, 23, 30)
FRESH_AT = datetime(2024, 1, 31, 0, 20)
SPLIT_AT = datetime(2024, 1, 16)
SCAN_DAY = datetime(2024, 1, 10)
ENTITY = "repo/3"
ACCEPTED = ("click", "view", "purchase", "signup")
BATCHES = 3
# Parts of the index in tables as small as these.
COPY_BUCKETS = 4
# Rows a task may hold in the queries on skewed events.
LARGE = 100

_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    """Register a query under the name of its function."""

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    _QUERIES[run.__name__] = configured
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_events(spark, sf_dir)


def _dimension(raw: DataFrame, **options) -> DataFrame:
    return dimension(entity_events(raw), sizes=raw.select("repo_name"), **options)


# -- ingest


@_query
def bronze_decode(spark, sf_dir):
    messages = fixtures.messages(spark, sf_dir)
    return bronze_rows(decode(messages, F.col("timestamp").cast("timestamp_ntz") + F.make_interval(secs=F.lit(5))))


@_query
def bronze_malformed(spark, sf_dir):
    dead = dead_letters(decode(fixtures.messages(spark, sf_dir)))
    return dead.select(F.col("offset").alias("msg_offset"), F.col("value").cast("string").alias("value"), "reason")


@_query
def bronze_partition_scan(spark, sf_dir):
    layout = Layout(scratch_dir(spark, "bronze"), copy_buckets=COPY_BUCKETS)
    write_load(_raw(spark, sf_dir), layout, "seed", rebalance=True)
    rows = read_days(spark, layout, [SCAN_DAY.date()]).filter(F.col("event_type") == "click")
    return rows.select(*RAW_EVENTS.fieldNames())


@_query
def publish_key_value(spark, sf_dir):
    rows = as_messages(keyed_events(fixtures.messages(spark, sf_dir)))
    return rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@_query
def publish_dedup(spark, sf_dir):
    """Every seventh id has been published before."""
    keyed = keyed_events(fixtures.messages(spark, sf_dir))
    published = fixtures.driver_events(spark, sf_dir).filter("event_id % 7 = 0")
    fresh = new_events(keyed, F.col("offset"), published.select(F.col("event_id").cast("string").alias("event_id")))
    return fresh.select("event_id", F.col("offset").alias("msg_offset"), normalised(F.col("value").cast("string")).alias("event_json"))


@_query
def stream_publish(spark, sf_dir):
    """Published by two jobs: the second finds messages the first has sent, and new ones."""
    root = scratch_dir(spark, "publish")
    layout, sink = Layout(root, published_buckets=COPY_BUCKETS), file_sink(f"{root}/out")
    messages = fixtures.messages(spark, sf_dir)
    early = F.pmod(F.xxhash64("offset"), F.lit(2)) == 0
    for rows in (messages.filter(early), messages.filter(~early)):
        rows.write.mode("append").parquet(f"{root}/in")
        publish(spark, file_source(f"{root}/in"), sink, layout)
    out = spark.read.parquet(f"{root}/out")
    return out.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# -- silver


@_query
def silver_typed(spark, sf_dir):
    return typed_events(_raw(spark, sf_dir))


@_query
def silver_dedup(spark, sf_dir):
    return silver_events(_raw(spark, sf_dir))


@_query
def lookback_filter(spark, sf_dir):
    return recent_facts(_raw(spark, sf_dir), hours_ago(LOOKBACK_HOURS, NOW))


# -- versioned dimension


@_query
def scd2_full(spark, sf_dir):
    return _dimension(_raw(spark, sf_dir))


@_query
def scd2_full_compat(spark, sf_dir):
    return _dimension(_raw(spark, sf_dir), strict=False)


@_query
def scd2_changes(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return change_log(entity_events(raw), sizes=raw.select("repo_name"))


def _skewed(spark: SparkSession, sf_dir: str, strict: bool) -> DataFrame:
    """A third of all events are one repo's, which is more than a task may hold here."""
    raw = fixtures.raw_events(spark, sf_dir, skewed=True)
    return _dimension(raw, strict=strict, max_rows=LARGE)


@_query
def scd2_skewed(spark, sf_dir):
    return _skewed(spark, sf_dir, strict=True)


@_query
def scd2_skewed_compat(spark, sf_dir):
    return _skewed(spark, sf_dir, strict=False)


@_query
def highwater_filter(spark, sf_dir):
    """Events newer than the newest version of a dimension that saw the first half of the month."""
    raw = _raw(spark, sf_dir)
    first_half = raw.filter(F.col("event_created_at") < F.lit(SPLIT_AT))
    opened = change_log(entity_events(first_half), sizes=first_half.select("repo_name"))
    mark = opened.agg(
        F.coalesce(F.max("valid_from"), F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz")).alias("mark")
    )
    events = event_facts(raw).filter(F.col("repo_name").isNotNull())
    return events.filter(F.col("event_created_at") > mark.scalar()).select("event_id", "repo_name", "event_created_at")


# -- hourly fact


@_query
def events_hourly(spark, sf_dir):
    return hourly_fact(event_facts(_raw(spark, sf_dir)))


@_query
def hourly_lookback(spark, sf_dir):
    """The fact for the days the last hours fall on."""
    return hourly_fact(recent_facts(_raw(spark, sf_dir), F.lit(lookback_day(NOW, LOOKBACK_HOURS))))


# -- tables kept up to date


def _batches(spark: SparkSession, sf_dir: str, name: str) -> tuple[Layout, list[DataFrame]]:
    """The raw events in batches, out of order, copies of an event in different ones."""
    layout = Layout(scratch_dir(spark, name), copy_buckets=COPY_BUCKETS)
    create_tables(spark, layout)
    raw = _raw(spark, sf_dir)
    number = F.pmod(F.xxhash64("event_id", "ingested_at"), F.lit(BATCHES))
    return layout, [raw.filter(number == i) for i in range(BATCHES)]


def _load(spark: SparkSession, layout: Layout, rows: DataFrame, load: str) -> None:
    write_load(rows, layout, load, rebalance=True)
    progress.loaded(spark, layout, load, rows=0, dead_letters=0)


@_query
def scd2_incremental(spark, sf_dir):
    layout, batches = _batches(spark, sf_dir, "scd2")
    table = DimensionTable(spark, layout, buckets=8)
    for i, rows in enumerate(batches):
        _load(spark, layout, rows, f"batch-{i}")
        table.update([f"batch-{i}"])
    return table.read()


@_query
def hourly_incremental(spark, sf_dir):
    layout, batches = _batches(spark, sf_dir, "hourly")
    table = FactTable(spark, layout)
    for i, rows in enumerate(batches):
        _load(spark, layout, rows, f"batch-{i}")
        table.update([f"batch-{i}"])
    return table.read().drop("event_date")


def _stream(spark: SparkSession, sf_dir: str, name: str, table_of) -> DataFrame:
    """Messages written as files, read as a stream in batches; gold takes in what is pending when half are there, and at the end."""
    root = scratch_dir(spark, name)
    layout = Layout(root, copy_buckets=COPY_BUCKETS)
    messages = fixtures.messages(spark, sf_dir)
    slices = F.pmod(F.xxhash64("key"), F.lit(BATCHES))
    messages.withColumn("slice", slices).write.partitionBy("slice").parquet(f"{root}/messages")
    files = len(spark.read.parquet(f"{root}/messages").inputFiles())
    table = table_of(layout)
    source = file_source(f"{root}/messages/slice=*", files_per_batch=ceil(files / BATCHES))
    waiting: list[str] = []

    def refresh(load: str) -> None:
        waiting.append(load)
        if len(waiting) > BATCHES // 2:
            table.update(waiting)
            waiting.clear()

    drain(spark, source, layout, after_load=refresh)
    if waiting:
        table.update(waiting)
    return table.read()


@_query
def stream_scd2(spark, sf_dir):
    return _stream(spark, sf_dir, "stream-scd2", lambda layout: DimensionTable(spark, layout, buckets=8))


@_query
def stream_hourly(spark, sf_dir):
    return _stream(spark, sf_dir, "stream-hourly", lambda layout: FactTable(spark, layout)).drop("event_date")


# -- serving


@_query
def overall(spark, sf_dir):
    return marts.overall(event_facts(_raw(spark, sf_dir)))


@_query
def event_types(spark, sf_dir):
    return marts.event_types(event_facts(_raw(spark, sf_dir)))


@_query
def top_repos(spark, sf_dir):
    return marts.top_repos(event_facts(_raw(spark, sf_dir)))


@_query
def hourly_series(spark, sf_dir):
    return marts.hourly_series(events_hourly(spark, sf_dir))


@_query
def entities_current(spark, sf_dir):
    return marts.entities_current(scd2_full(spark, sf_dir))


@_query
def entity_history(spark, sf_dir):
    """The history of one entity, from its own events."""
    return marts.entity_history(_dimension(copies_about(_raw(spark, sf_dir), ENTITY)), ENTITY)


@_query
def versions_per_repo(spark, sf_dir):
    return marts.versions_per_repo(scd2_full(spark, sf_dir))


# -- quality


def _models(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, quality.Checks]]:
    raw = _raw(spark, sf_dir)
    facts = event_facts(raw)
    return [
        (raw, quality.BRONZE),
        (facts, quality.SILVER),
        (_dimension(raw), quality.DIMENSION),
        (hourly_fact(facts), quality.FACT),
    ]


@_query
def dq_not_null(spark, sf_dir):
    reports = [quality.not_null(rows, checks) for rows, checks in _models(spark, sf_dir)]
    return reduce(DataFrame.unionByName, reports)


@_query
def dq_unique(spark, sf_dir):
    reports = [
        quality.unique(rows, checks, column) for rows, checks in _models(spark, sf_dir) for column in checks.unique
    ]
    return reduce(DataFrame.unionByName, reports)


@_query
def dq_accepted_values(spark, sf_dir):
    checks = quality.Checks("silver_events", accepted={"event_type": ACCEPTED})
    return quality.accepted_values(event_facts(_raw(spark, sf_dir)), checks, "event_type")


@_query
def dq_expression(spark, sf_dir):
    return quality.expression_is_true(events_hourly(spark, sf_dir), quality.FACT)


@_query
def dq_freshness(spark, sf_dir):
    return quality.freshness(_raw(spark, sf_dir), quality.BRONZE, "ingested_at", FRESH_AT)
