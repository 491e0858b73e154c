"""Physical plans: what is read, what is shuffled, and how."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.operators.decode import bronze_rows, decode
from eventmart.operators.hourly import hourly_fact
from eventmart.operators.publish import keyed_events, new_events
from eventmart.operators.scd2 import dimension
from eventmart.operators.silver import entity_events, event_facts, silver_events
from eventmart.plans import marts
from eventmart.plans import queries as catalog
from eventmart.plans.dimension import DimensionTable
from eventmart.session import configure, scratch_dir
from eventmart.sources import fixtures, progress
from eventmart.sources.bronze import read_raw_events, write_load
from eventmart.sources.layout import Layout

TABLES_ON_DISK = {"scd2_incremental", "hourly_incremental", "stream_scd2", "stream_hourly", "bronze_partition_scan"}


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    configure(spark)
    layout = Layout(scratch_dir(spark, "lake"))
    write_load(fixtures.raw_events(spark, sf_dir), layout, "seed", rebalance=True)
    progress.loaded(spark, layout, "seed", 0, 0)
    return layout


@pytest.fixture(scope="module")
def raw(spark, lake):
    return read_raw_events(spark, lake)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def nodes(text: str, name: str) -> list[str]:
    return [line for line in text.splitlines() if re.search(rf"(^|[ +\-:]){name}\b", line)]


def test_dimension_parses_once_and_does_not_shuffle_the_payload(spark, raw):
    """Whatever is computed from the events in pieces shares one scan and one shuffle of them."""
    rows = dimension(entity_events(raw))
    rows.write.format("noop").mode("overwrite").save()
    text = rows._jdf.queryExecution().executedPlan().toString()
    calls = r"from_json\(.*payload#\d+, Some\(UTC\), true\)|xxhash64\(payload#\d+, 42\)"
    for projected in (line for line in nodes(text, "Project") if "from_json" in line):
        assert "payload#" not in re.sub(calls, "", projected)


def test_copies_are_dropped_before_the_shuffle(raw):
    for frame in (silver_events(raw), event_facts(raw), entity_events(raw)):
        lines = plan(frame).splitlines()
        [partial] = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
        [exchange] = [i for i, line in enumerate(lines) if "Exchange" in line]
        assert partial > exchange


def test_published_copies_are_dropped_before_the_shuffle(spark, sf_dir):
    keyed = keyed_events(fixtures.messages(spark, sf_dir))
    assert "Partial" in "".join(nodes(plan(new_events(keyed, F.col("offset"))), "WindowGroupLimit"))


def test_fact_does_not_read_the_payload(raw):
    for frame in (hourly_fact(event_facts(raw)), marts.overall(event_facts(raw)), marts.top_repos(event_facts(raw))):
        assert "payload" not in plan(frame)


def test_distinct_counts_are_aggregated_before_each_shuffle(raw):
    text = plan(hourly_fact(event_facts(raw)))
    assert len(nodes(text, "Exchange")) == 3
    assert len(nodes(text, "HashAggregate")) == 4


def test_bronze_filters_reach_the_scan(raw):
    day = F.col("ingested_date") == F.lit(datetime(2024, 1, 10).date())
    [scan] = nodes(plan(raw.filter(day & (F.col("event_type") == "click")).select("event_id")), "FileScan")
    assert "isnotnull(ingested_date" in scan and "EqualTo(event_type,click)" in scan
    assert re.search(r"ReadSchema: struct<event_id:string,event_type:string>", scan)


def test_one_entity_is_read_from_its_bucket(spark, lake):
    table = DimensionTable(spark, lake, buckets=8)
    table.build()
    rows = table.read_entity("repo/3")
    [scan] = nodes(plan(rows), "FileScan")
    assert "PartitionFilters: [isnotnull(bucket" in scan
    assert len(rows.inputFiles()) > 0
    assert rows.count() == table.read().filter("repo_name = 'repo/3'").count() > 0


def test_decode_parses_each_message_once_without_a_shuffle(spark, sf_dir):
    path = scratch_dir(spark, "messages")
    fixtures.messages(spark, sf_dir).write.parquet(path)
    text = plan(bronze_rows(decode(spark.read.parquet(path))))
    assert text.count("from_json") == 1
    assert not nodes(text, "Exchange")


@pytest.mark.parametrize("name", sorted(catalog.queries().keys() - TABLES_ON_DISK))
def test_no_join_without_keys(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
