"""The whole pipeline on the seed history, and its checks."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from eventmart.operators import quality
from eventmart.plans.dimension import DimensionTable
from eventmart.plans.fact import FactTable
from eventmart.plans.pipeline import FULL, ChecksFailed, register_views, run_pipeline
from eventmart.schemas import MESSAGE, RAW_EVENTS
from eventmart.session import configure, scratch_dir
from eventmart.sources import files
from eventmart.sources.layout import Layout
from eventmart.sources.messages import file_sink, file_source
from tests import seed
from tests.seed import events
from tests.worlds import hourly, strict_versions

NOON = datetime(2023, 11, 5, 12)


def send(spark, path, messages):
    rows = [(e["id"].encode(), json.dumps(e).encode(), "t", 0, n, None) for n, e in enumerate(messages)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(path)


def gold(spark, layout):
    return (
        sorted(tuple(r) for r in DimensionTable(spark, layout).read().drop("valid_to").collect()),
        sorted(tuple(r) for r in FactTable(spark, layout).read().collect()),
    )


def test_layout_names():
    assert Layout("/lake").dimension == "/lake/gold/dim_repo_scd2"
    assert Layout("/lake", "ann").raw_events == "/lake/ann_bronze/raw_events"
    assert Layout("/lake/", "ann").layer("gold") == "ann_gold"


def test_run_by_parts_equals_run_in_full(spark):
    root = scratch_dir(spark, "pipeline")
    by_parts, in_full = Layout(f"{root}/lake", "parts"), Layout(f"{root}/lake", "full")
    messages = events()
    topic = f"{root}/topic"
    # The later half comes first, and some of it again with the rest.
    send(spark, topic, messages[19:])
    result = run_pipeline(spark, by_parts, file_source(topic))
    assert result.ingested == seed.SIZE - 19
    send(spark, topic, messages[:19] + messages[30:32])
    result = run_pipeline(spark, by_parts, file_source(topic))
    assert result.ingested == 21
    assert len(result.report) == 19
    bad = [(r["model"], r["check"], r["failures"], r["status"]) for r in result.report if r["status"] != "pass"]
    assert bad == [("raw_events", "unique", 2, "warn")]

    run_pipeline(spark, in_full, file_source(topic), mode=FULL)
    assert gold(spark, by_parts) == gold(spark, in_full)
    dimension, fact = gold(spark, in_full)
    versions, hours = len(strict_versions(seed.rows())), len(hourly(seed.rows()))
    assert (len(dimension), len(fact)) == (versions, hours)

    # Refresh without ingest changes nothing.
    assert run_pipeline(spark, by_parts, ingest=False).ingested == 0
    assert gold(spark, by_parts) == (dimension, fact)

    register_views(spark, in_full)
    count = "SELECT count(*) FROM {}"
    tables = ("raw_events", "silver_events", "dim_repo_scd2", "fct_events_hourly")
    assert [spark.sql(count.format(t)).first()[0] for t in tables] == [seed.SIZE + 2, seed.SIZE, versions, hours]
    own = [v for v in strict_versions(seed.rows()) if v[0] == seed.STATIONS[0]]
    assert DimensionTable(spark, in_full).read_entity(seed.STATIONS[0]).count() == len(own)


def test_publish_is_the_first_step(spark):
    root = scratch_dir(spark, "pipeline")
    layout, topic = Layout(f"{root}/lake"), f"{root}/topic"
    send(spark, f"{root}/events", events()[:5] + events()[:2])
    files.make_directory(spark, topic)
    result = run_pipeline(spark, layout, file_source(topic), events=file_source(f"{root}/events"), sink=file_sink(topic))
    assert (result.published, result.ingested) == (5, 5)


def test_failed_check_stops_the_run(spark):
    root = scratch_dir(spark, "pipeline")
    layout = Layout(f"{root}/lake")
    first, *_ = events()
    send(spark, f"{root}/topic", [first | {"type": None}])
    with pytest.raises(ChecksFailed, match="raw_events.event_type not_null: 1"):
        run_pipeline(spark, layout, file_source(f"{root}/topic"))
    assert not (spark._jvm.java.io.File(layout.dimension)).exists()


def test_a_source_is_needed_to_ingest(spark):
    with pytest.raises(ValueError, match="source"):
        run_pipeline(spark, Layout(scratch_dir(spark, "pipeline")))


@pytest.fixture(scope="module")
def spoiled(spark):
    """Rows that break each check once."""
    configure(spark)
    rows = [
        ("1", "PushEvent", "a", "r", NOON, NOON, "{}"),
        ("1", "PushEvent", "a", "r", NOON, NOON, "{}"),
        (None, "PushEvent", "a", None, NOON, NOON, "{}"),
        (None, "OddEvent", "a", "r", None, NOON, "{}"),
        ("4", "OddEvent", "a", "r", NOON, None, "{}"),
        ("5", None, "a", "r", NOON, NOON, "{}"),
    ]
    return spark.createDataFrame(rows, RAW_EVENTS)


def failures(report):
    return {(r["column"], r["check"]): (r["failures"], r["status"]) for r in report.collect()}


def test_checks_find_spoiled_rows(spoiled):
    assert failures(quality.run_checks(spoiled, quality.BRONZE)) == {
        ("event_id", "not_null"): (2, "error"),
        ("event_type", "not_null"): (1, "error"),
        ("ingested_at", "not_null"): (1, "error"),
        ("event_id", "unique"): (1, "warn"),
    }
    found = failures(quality.run_checks(spoiled, quality.SILVER))
    assert found["event_type", "accepted_values"] == (1, "warn")
    assert found["event_id", "unique"] == (1, "error")
    assert found["repo_name", "not_null"] == (1, "error")
    assert found["event_created_at", "not_null"] == (1, "error")


def test_expression_check(spark):
    rows = spark.createDataFrame([(-1,), (None,), (3,)], "event_count long")
    assert failures(quality.expression_is_true(rows, quality.FACT)) == {
        ("event_count", "expression_is_true"): (1, "error")
    }


@pytest.mark.parametrize(("minutes", "status"), [(0, "pass"), (15, "pass"), (16, "warn"), (60, "warn"), (61, "error")])
def test_freshness(spoiled, minutes, status):
    report = quality.freshness(spoiled, quality.BRONZE, "ingested_at", NOON + timedelta(minutes=minutes))
    assert report.first()["status"] == status


def test_freshness_of_no_rows(spoiled):
    report = quality.freshness(spoiled.limit(0), quality.BRONZE, "ingested_at", NOON)
    assert report.first()["status"] == "error"
