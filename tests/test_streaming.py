"""Streams over files: drain, restart, replay, publishing each id once."""

from __future__ import annotations

import json
import time
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventmart.operators.publish import as_messages, keyed_events, new_events
from eventmart.plans.dimension import DimensionTable
from eventmart.plans.fact import FactTable
from eventmart.plans.pipeline import refresh_gold
from eventmart.schemas import MESSAGE
from eventmart.session import configure, scratch_dir
from eventmart.sources import progress
from eventmart.sources.bronze import read_dead_letters, read_raw_events
from eventmart.sources.layout import Layout
from eventmart.sources.messages import (
    CONTINUOUS_BATCH_ROWS,
    file_sink,
    file_source,
    kafka_sink,
    kafka_source,
)
from eventmart.streaming.ingest import drain, load_batch, run_continuously
from eventmart.streaming.publish import publish, unseen_messages

T0 = datetime(2023, 11, 4, 10, tzinfo=UTC)


def event(event_id, kind="WatchEvent", stars="1", minute=0) -> bytes:
    """A reading of one station, some minutes after ten."""
    state = {"language": "wet", "stargazers_count": stars}
    reading = {"repo": {"name": "delta/silt"}, "payload": {"repository": state}, "actor": {"login": "keeper-3"}}
    at = T0 + timedelta(minutes=minute)
    return json.dumps(reading | {"id": event_id, "type": kind, "created_at": at.isoformat()}).encode()


@pytest.fixture
def topic(spark):
    """A folder of messages, a way to add one file to it, and a layout."""
    configure(spark)
    root = scratch_dir(spark, "topic")
    sent = []

    def send(*values, at=T0):
        rows = [(None, v, "t", 0, len(sent) + n, at) for n, v in enumerate(values)]
        sent.extend(values)
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(f"{root}/in")

    return f"{root}/in", send, Layout(f"{root}/lake", copy_buckets=2, published_buckets=4)


def ids(spark, layout) -> list[str]:
    return sorted(r["event_id"] for r in read_raw_events(spark, layout).select("event_id").collect())


def test_what_is_drained_is_not_drained_again(spark, topic):
    """Each drain takes what has come since the last, in loads of its own; nothing makes no load."""
    path, send, layout = topic
    seen: list[str] = []
    for n, size in enumerate((2, 0, 4, 0, 0, 1)):
        fresh = [f"{n}-{k}" for k in range(size)]
        if fresh:
            send(*[event(i) for i in fresh])
        else:
            loads = read_raw_events(spark, layout).select("load").distinct().count()
        assert drain(spark, file_source(path), layout) == size
        seen += fresh
        assert ids(spark, layout) == sorted(seen)
        if not fresh:
            assert read_raw_events(spark, layout).select("load").distinct().count() == loads
    assert read_raw_events(spark, layout).select("load").distinct().count() == 3


def test_small_batches_take_everything_once(spark, topic):
    path, send, layout = topic
    for n in range(5):
        send(event(f"e{n}"))
    assert drain(spark, file_source(path, files_per_batch=2), layout) == 5
    assert ids(spark, layout) == [f"e{n}" for n in range(5)]
    log = progress.run_log(spark, layout)
    assert sorted(r["rows_ingested"] for r in log.collect()) == [1, 2, 2]


def test_bad_messages_go_to_the_dead_letter_table(spark, topic):
    path, send, layout = topic
    send(b"{not-json", event("ok"), None, b"[1]")
    assert drain(spark, file_source(path), layout) == 1
    dead = {(r["value"] and bytes(r["value"]), r["reason"]) for r in read_dead_letters(spark, layout).collect()}
    assert dead == {(b"{not-json", "malformed"), (None, "null value"), (b"[1]", "not an object")}
    assert progress.run_log(spark, layout).first()["dead_letters"] == 3


def test_a_batch_that_dies_is_run_again_without_extra_rows(spark, topic):
    path, send, layout = topic
    send(event("e0"), event("e1"))
    send(event("e2"))

    def die(load):
        raise RuntimeError("killed after the load was written")

    with pytest.raises(Exception, match="killed after"):
        drain(spark, file_source(path, files_per_batch=1), layout, after_load=die)
    assert len(ids(spark, layout)) > 0
    drain(spark, file_source(path, files_per_batch=1), layout)
    assert ids(spark, layout) == ["e0", "e1", "e2"]


def test_same_load_twice_adds_nothing(spark, topic):
    path, send, layout = topic
    send(event("e0"), event("e1"), b"junk")
    for _ in range(2):
        assert load_batch(spark, layout, file_source(path).read(spark), "load-1") == 2
    assert ids(spark, layout) == ["e0", "e1"]
    assert read_dead_letters(spark, layout).count() == 1


def test_stream_goes_on_to_gold(spark, topic):
    path, send, layout = topic
    table = DimensionTable(spark, layout, buckets=1)
    for stars, minute in (("5", 50), ("1", 5), ("3", 20)):
        send(event(f"e{minute}", stars=stars, minute=minute))
    drain(spark, file_source(path, files_per_batch=1), layout, after_load=lambda load: table.update([load]))
    found = table.read().orderBy("valid_from").collect()
    assert [(r.stargazers_count, r.is_current) for r in found] == [(1, False), (3, False), (5, True)]


def test_continuous_query_loads_until_stopped(spark, topic):
    path, send, layout = topic
    send(event("e0"))
    query = run_continuously(spark, file_source(path), layout, interval="0 seconds")
    try:
        query.processAllAvailable()
        send(event("e1"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert ids(spark, layout) == ["e0", "e1"]


def test_gold_is_refreshed_at_an_interval_of_its_own(spark, topic):
    """All loads that are pending are taken in as one update."""
    path, send, layout = topic
    for n in range(3):
        send(event(f"e{n}", stars=str(n), minute=n))
    drain(spark, file_source(path, files_per_batch=1), layout)
    assert len(progress.pending(spark, layout, progress.DIMENSION)) == 3
    query = refresh_gold(spark, layout, interval="1 second")
    try:
        end = time.time() + 120
        while time.time() < end and any(progress.pending(spark, layout, t) for t in (progress.DIMENSION, progress.FACT)):
            time.sleep(0.5)
    finally:
        query.stop()
    assert DimensionTable(spark, layout).read().count() == 3
    assert FactTable(spark, layout).read().agg(F.sum("event_count")).first()[0] == 3


def test_batch_publish_first_arrival_of_string_ids_not_published_before(spark):
    configure(spark)
    values = [event("a", stars="1"), event("a", stars="2"), event(7), event(None), event("b"), event("c"), b"junk"]
    records = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "position int, value binary")
    published = spark.createDataFrame([("c",)], "event_id string")
    fresh = new_events(keyed_events(records), F.col("position"), published)
    assert sorted((r["event_id"], r["position"]) for r in fresh.collect()) == [("a", 0), ("b", 4)]
    sent = {bytes(r["key"]): json.loads(bytes(r["value"])) for r in as_messages(fresh).collect()}
    assert sent[b"a"] == json.loads(values[0])


def test_stream_publish_sends_each_id_once(spark, topic):
    path, send, layout = topic
    out, checkpoint = f"{layout.root}/out", f"{layout.root}/checkpoint"

    def publish() -> list[str]:
        stream = file_source(path, files_per_batch=1).read_stream(spark)
        query = file_sink(out).write_stream(unseen_messages(stream), checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(bytes(r["key"]).decode() for r in spark.read.parquet(out).collect())

    send(event("1"), event("2"), event("1"), event(5))
    assert publish() == ["1", "2"]
    send(event("2"), event("3"), at=T0 + timedelta(minutes=10))
    assert publish() == ["1", "2", "3"]


def test_a_late_new_id_is_published_and_a_repeated_one_is_not(spark, topic):
    path, send, layout = topic
    for n, (key, hours) in enumerate([("a", 5), ("b", 10), ("late", 0), ("a", 11), ("late", 12)]):
        send(event(key, minute=n), at=T0 + timedelta(hours=hours))
    stream = file_source(path, files_per_batch=1).read_stream(spark)
    sink = file_sink(f"{layout.root}/out")
    sink.write_stream(unseen_messages(stream), f"{layout.root}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted(bytes(r["key"]).decode() for r in spark.read.parquet(f"{layout.root}/out").collect()) == ["a", "b", "late"]


def test_publish_memory_is_bounded_by_time(spark, topic):
    path, send, layout = topic
    send(*[event(f"id{n}") for n in range(300)])
    stream = unseen_messages(file_source(path, files_per_batch=1).read_stream(spark), remember="1 second")
    writer = file_sink(f"{layout.root}/out").write_stream(stream, f"{layout.root}/cp")
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        for n in range(4):
            query.processAllAvailable()
            time.sleep(1.5)
            send(event(f"later{n}"))
        query.processAllAvailable()
        kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    finally:
        query.stop()
    assert max(kept) >= 300 and kept[-1] < 10
    assert spark.read.parquet(f"{layout.root}/out").count() == 304


def test_publish_job_counts_new_ids_and_logs_them(spark, topic):
    path, send, layout = topic
    sink = file_sink(f"{layout.root}/out")
    send(event("a", stars="1"), event("a", stars="2"), event("b"), event(7), b"junk")
    assert publish(spark, file_source(path), sink, layout) == 2
    assert publish(spark, file_source(path), sink, layout) == 0
    send(event("b"), event("c"), at=T0 - timedelta(days=9))
    assert publish(spark, file_source(path), sink, layout) == 1
    sent = {bytes(r["key"]): bytes(r["value"]) for r in spark.read.parquet(f"{layout.root}/out").collect()}
    assert sorted(sent) == [b"a", b"b", b"c"]
    assert json.loads(sent[b"a"]) == json.loads(event("a", stars="1"))
    log = progress.run_log(spark, layout).filter("rows_published is not null")
    assert sorted(r["rows_published"] for r in log.collect()) == [1, 2]


def test_kafka_options():
    """The connector itself is not here to be run."""
    source = kafka_source("broker:9092", "events", CONTINUOUS_BATCH_ROWS)
    assert source.format == "kafka"
    assert source.options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "200",
    }
    assert "maxOffsetsPerTrigger" not in kafka_source("b", "t", None).options
    assert kafka_sink("b", "t").options == {"kafka.bootstrap.servers": "b", "topic": "t", "kafka.linger.ms": "50"}
