"""Versions against plain Python, with entities in one task and split over many."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventmart.functions.keys import version_key
from eventmart.operators import scd2
from eventmart.operators.scd2 import change_log, dimension, large_entities
from eventmart.operators.silver import entity_events
from eventmart.plans import queries as catalog
from eventmart.sources import fixtures
from tests.worlds import compatible_versions, frame, random_rows, raw_row, stored_versions, strict_versions

def test_version_keys(spark):
    """The MD5 of the entity's name and the time as text."""
    cases = [("harbour/tide", datetime(2023, 11, 4, 21, 45)), ("ridge/wind", datetime(2024, 2, 29, 0, 0, 7)), ("é", None)]
    rows = spark.createDataFrame(cases, "entity string, at timestamp_ntz")
    found = {(r.entity, r.at): r.key for r in rows.withColumn("key", version_key("entity", "at")).collect()}
    for entity, at in cases:
        text = entity + ("" if at is None else at.isoformat(sep=" "))
        assert found[entity, at] == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("max_rows", [10**6, 2, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories(spark, seed, max_rows):
    rows = random_rows(random.Random(seed), worlds=60, events=14)
    events = entity_events(frame(spark, rows))
    strict = stored_versions(dimension(events, max_rows=max_rows))
    assert Counter(strict) == Counter(strict_versions(rows))
    compatible = stored_versions(dimension(events, strict=False, max_rows=max_rows))
    assert Counter(compatible) == Counter(compatible_versions(rows))


@pytest.mark.parametrize("strict", [True, False])
def test_without_large_entities_there_is_one_shuffle_of_the_events(spark, strict):
    rows = random_rows(random.Random(3), worlds=40, events=14)
    events = spark.createDataFrame(entity_events(frame(spark, rows)).collect(), entity_events(frame(spark, rows)).schema)
    found = dimension(events, strict=strict, max_rows=None)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    wanted = strict_versions(rows) if strict else compatible_versions(rows)
    assert Counter(stored_versions(found)) == Counter(wanted)


def test_a_hot_entity_is_split_and_others_are_not(spark):
    start = datetime(2024, 1, 1)
    rows = [
        raw_row(f"h{i:04d}", "hot", start + timedelta(minutes=i // 3), start + timedelta(seconds=i), stars=str(i // 7))
        for i in range(400)
    ] + [raw_row(f"c{i}", f"cold{i}", start, start) for i in range(20)]
    events = entity_events(frame(spark, rows))
    assert [r["repo_name"] for r in large_entities(events, 50).collect()] == ["hot"]
    found = stored_versions(dimension(events, max_rows=50))
    assert Counter(found) == Counter(strict_versions(rows))


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_rows_of_a_hot_entity_are_dealt_to_tasks_by_piece(spark, monkeypatch, strict, broadcast):
    """Whether or not the list of large entities is broadcast."""
    start, tasks, hours = datetime(2024, 1, 1), 16, 60
    rows = [raw_row(f"h{i:05d}", "hot", start + timedelta(minutes=i), start, stars=str(i // 7)) for i in range(60 * hours)]
    rows += [raw_row(f"c{i}", f"cold{i}", start, start) for i in range(20)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": broadcast, "spark.sql.shuffle.partitions": str(tasks),
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = dimension(entity_events(frame(spark, rows)), strict=strict, max_rows=500)
        text = found._jdf.queryExecution().executedPlan().toString()
        # What the events in pieces are sorted for the first window by, and what deals them out for it.
        lines = text.splitlines()
        [first] = [i for i in range(len(lines)) if "max(_is_large" in lines[i] and "Window" in lines[i]][-1:]
        below = [line for line in lines[first:] if "Exchange" in line][0]
        assert re.search(r"hashpartitioning\(repo_name#\d+, _piece#\d+", below)
        large = large_entities(entity_events(frame(spark, rows)), 500)
        pieces = scd2._in_pieces(entity_events(frame(spark, rows)), large).repartition("repo_name", "_piece")
        counts = [r["count"] for r in pieces.groupBy(F.spark_partition_id()).count().collect()]
        assert len(counts) > tasks // 2 and max(counts) < len(rows) / 3
        wanted = strict_versions(rows) if strict else compatible_versions(rows)
        assert Counter(stored_versions(found)) == Counter(wanted)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_large_entity_with_rows_without_a_time(spark):
    start = datetime(2024, 1, 1)
    rows = [
        raw_row(f"h{i}", "hot", None if i % 5 == 0 else start + timedelta(minutes=50 * i), start + timedelta(seconds=i), stars=str(i // 2))
        for i in range(40)
    ]
    events = entity_events(frame(spark, rows))
    for max_rows in (3, 100):
        assert Counter(stored_versions(dimension(events, max_rows=max_rows))) == Counter(strict_versions(rows))
        found = stored_versions(dimension(events, strict=False, max_rows=max_rows))
        assert Counter(found) == Counter(compatible_versions(rows))


def test_building_a_query_starts_no_job(spark, sf_dir):
    tracker = spark.sparkContext.statusTracker()
    for name in ("scd2_full", "dq_not_null", "versions_per_repo", "scd2_skewed"):
        fixtures.driver_events(spark, sf_dir)
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        catalog.queries()[name](spark, sf_dir)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # One job reads the schema of the table.
        assert len(jobs) <= (2 if name.startswith("dq") else 1), name


def test_null_attribute_opens_once_in_strict_and_each_time_in_compatible(spark):
    at = datetime(2024, 1, 1)
    rows = [raw_row(str(i), "r", at + timedelta(hours=i), at, language=None) for i in range(3)]
    events = entity_events(frame(spark, rows))
    assert change_log(events).count() == 1
    assert change_log(events, strict=False).count() == 3


def test_same_time_counts_once_last_id_wins(spark):
    at = datetime(2024, 1, 1)
    rows = [raw_row("a", "r", at, at, stars="1"), raw_row("b", "r", at, at, stars="2")]
    events = entity_events(frame(spark, rows))
    for max_rows in (100, 1):
        found = change_log(events, max_rows=max_rows).collect()
        assert [r["stargazers_count"] for r in found] == [2]
