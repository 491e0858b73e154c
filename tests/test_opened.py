"""What an update opens and writes: index buckets, named folders, touched keys; nothing else."""

from __future__ import annotations

import os
from datetime import datetime, timedelta
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from eventmart.operators import quality
from eventmart.operators.silver import event_facts
from eventmart.plans import checks, dimension, fact
from eventmart.plans.checks import CheckLedger
from eventmart.sources import bronze, copies, files, progress
from eventmart.sources.bronze import days_of, read_days, read_loads, write_load
from eventmart.session import scratch_dir
from eventmart.sources.layout import Layout
from eventmart.sources.messages import file_sink, file_source
from eventmart.streaming import publish as publishing
from eventmart.streaming.ingest import load_batch
from tests.test_incremental import Tables, at
from tests.test_streaming import event, topic  # noqa: F401
from tests.worlds import frame, raw_row


class Opened:
    """Records the folders that readers are asked to open."""

    def __init__(self, monkeypatch):
        self.bronze: set[str] = set()
        self.index: set[str] = set()
        read_parts, read_index = bronze.read_parts, copies._read

        def parts(spark, layout, folders):
            self.bronze |= set(folders)
            return read_parts(spark, layout, folders)

        def index(spark, layout, folders):
            self.index |= set(folders)
            return read_index(spark, layout, folders)

        monkeypatch.setattr(bronze, "read_parts", parts)
        monkeypatch.setattr(dimension, "read_parts", parts)
        monkeypatch.setattr(copies, "_read", index)
        for module in (dimension, fact):
            monkeypatch.setattr(module, "read_raw_events", lambda *_: pytest.fail("all of bronze is read"))


def all_files(path: str) -> set[str]:
    root = urlparse(path).path
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))}


@pytest.fixture
def lake(spark):
    """Five loads of five days, each with events of an entity and of others."""
    tables = Tables(spark, buckets=8)
    tables.layout = Layout(scratch_dir(spark, "lake"), copy_buckets=16)
    tables.dimension = dimension.DimensionTable(spark, tables.layout, buckets=8)
    tables.fact = fact.FactTable(spark, tables.layout)
    rows = []
    for day in range(5):
        rows = [raw_row(f"{day}-{i}", f"r{i}", at(24 * day + i), at(24 * day + i), stars=str(day)) for i in range(3)]
        rows.append(raw_row(f"own-{day}", "own", at(24 * day), at(24 * day), stars=str(day)))
        write_load(frame(spark, rows), tables.layout, f"load-{day}")
        progress.loaded(spark, tables.layout, f"load-{day}", 0, 0)
        tables.rows += rows
    tables.dimension.build()
    tables.fact.build()
    tables.check()
    return tables


def folders(tables, load: str) -> set[str]:
    return {f"{day}/load={load}" for day in days_of(tables.spark, tables.layout, load)}


def test_one_late_event_opens_index_buckets_and_named_folders(lake, monkeypatch):
    opened = Opened(monkeypatch)
    rows = [raw_row("late", "own", at(24 * 3 + 1), at(24 * 9), stars="77")]
    write_load(frame(lake.spark, rows), lake.layout, "late")
    progress.loaded(lake.spark, lake.layout, "late", 1, 0)
    lake.rows += rows
    opened.bronze.clear()
    lake.dimension.update(["late"])
    # Its own load, and the folder of the one event of the entity that comes after it.
    assert opened.bronze == folders(lake, "late") | folders(lake, "load-4")
    ids = {f for f in opened.index if f.startswith("kind=id")}
    entities = {f for f in opened.index if f.startswith("kind=entity")}
    assert 1 <= len(ids) <= 2 and len({f.split("/")[1] for f in entities}) == 1
    opened.bronze.clear()
    opened.index.clear()
    lake.fact.update(["late"])
    assert opened.bronze == folders(lake, "late")
    assert len(opened.index) == 1
    lake.check()


def test_events_with_the_same_attributes_rewrite_no_file(lake):
    before = all_files(lake.layout.dimension)
    # Another event, and a copy of one, which change no version.
    rows = [raw_row("new", "own", at(24 * 3 + 1), at(24 * 9), stars="3"), raw_row("2-1", "r1", at(49), at(24 * 9), stars="2")]
    load = "same"
    write_load(frame(lake.spark, rows), lake.layout, load)
    progress.loaded(lake.spark, lake.layout, load, 2, 0)
    lake.rows += rows
    lake.dimension.update([load])
    assert all_files(lake.layout.dimension) == before
    lake.fact.update([load])
    lake.check()


def test_a_batch_touches_its_own_days_and_keys_of_the_fact(lake, monkeypatch):
    computed = []
    of = fact.fact_of

    def recorded(counts):
        rows = of(counts)
        computed.extend((r["event_hour"], r["event_type"]) for r in rows.collect())
        return rows

    monkeypatch.setattr(fact, "fact_of", recorded)
    before, references = all_files(lake.layout.fact), all_files(lake.layout.references)
    hour = at(24 * 2 + 3).replace(minute=0)
    rows = [raw_row("moved", "r1", hour + timedelta(minutes=5), at(300)), raw_row("1-2", "r2", hour, at(300), stars="1")]
    write_load(frame(lake.spark, rows), lake.layout, "few")
    progress.loaded(lake.spark, lake.layout, "few", 2, 0)
    lake.rows += rows
    lake.fact.update(["few"])
    # The copy's old hour and the new one.
    assert set(computed) <= {(hour, "PushEvent"), (at(24 + 2), "PushEvent")}
    touched = {f"event_date={d.date()}" for d in (hour, at(24 + 2))}
    kept = {f for f in before if not any(t in f for t in touched)}
    assert kept <= all_files(lake.layout.fact)
    added = all_files(lake.layout.references) - references
    assert references <= all_files(lake.layout.references) and all(any(t in f for t in touched) for f in added)
    lake.dimension.update(["few"])
    lake.check()


def test_checks_read_new_loads_only_and_report_the_same(lake, monkeypatch):
    ledger = CheckLedger(lake.spark, lake.layout)

    def full():
        raw = bronze.read_raw_events(lake.spark, lake.layout)
        return [
            *quality.run_checks(raw, quality.BRONZE).collect(),
            *quality.freshness(raw, quality.BRONZE, "ingested_at", at(24 * 9 + 10.4)).collect(),
            *quality.run_checks(event_facts(raw), quality.SILVER).collect(),
        ]

    def check():
        assert sorted(ledger.report(at(24 * 9 + 10.4)).collect()) == sorted(full())

    ledger.update()
    check()
    monkeypatch.setattr(checks, "read_raw_events", lambda *_: pytest.fail("all of bronze is read"))
    odd = [
        [raw_row("0-0", None, at(0), at(24 * 8)), raw_row("n", "r", None, at(24 * 8), kind="Odd"), raw_row(None, "r", at(1), at(24 * 8))],
        [raw_row("0-0", "r0", at(0), at(24 * 9)), raw_row("n", "r", at(1), at(24 * 9), kind="Odder"), raw_row("n", "r", at(1), at(24 * 9))],
        [raw_row("2-1", "r1", at(49), at(24 * 9 + 10), kind=None), raw_row(None, None, at(1), at(24 * 9 + 10)), raw_row("m", "r", at(1), None)],
    ]
    for n, rows in enumerate(odd):
        write_load(frame(lake.spark, rows), lake.layout, f"odd-{n}")
        progress.loaded(lake.spark, lake.layout, f"odd-{n}", len(rows), 0)
        ledger.update()
        check()
    ledger.update()
    check()
    assert {r["status"] for r in ledger.report().collect()} == {"pass", "warn", "error"}


def test_parts_of_reference_counts_are_put_together(lake):
    for n in range(3):
        rows = [raw_row("again", f"r{n}", at(24 * n), at(400 + n), actor=f"a{n}")]
        write_load(frame(lake.spark, rows), lake.layout, f"n{n}")
        progress.loaded(lake.spark, lake.layout, f"n{n}", 1, 0)
        lake.rows += rows
        lake.fact.update([f"n{n}"])
    lake.fact.compact([at(24 * d).date() for d in range(3)])
    day = f"{lake.layout.references}/event_date={at(0).date()}"
    assert len(files.directories_in(lake.spark, day)) == 1
    rows = [raw_row("again", "r9", at(0), at(500), actor="b")]
    write_load(frame(lake.spark, rows), lake.layout, "last")
    progress.loaded(lake.spark, lake.layout, "last", 1, 0)
    lake.rows += rows
    lake.fact.update(["last"])
    lake.dimension.update(["n0", "n1", "n2", "last"])
    lake.check()


def test_a_load_is_merged_once_and_counted_anew_when_it_is_replaced(lake):
    """A batch may be run again after the fact has taken it in."""
    rows = [raw_row("x", "r1", at(5), at(600), actor="z"), raw_row("3-1", "r8", at(70), at(600))]
    for _ in range(2):
        write_load(frame(lake.spark, rows), lake.layout, "twice")
        progress.loaded(lake.spark, lake.layout, "twice", 2, 0)
        lake.fact.update(["twice"])
        lake.fact.update(["twice"])
        lake.dimension.update(["twice"])
    lake.rows += rows
    lake.check()
    changed = [raw_row("x", "r1", at(5), at(700), actor="q")]
    write_load(frame(lake.spark, changed), lake.layout, "twice")
    progress.loaded(lake.spark, lake.layout, "twice", 1, 0)
    lake.fact.update(["twice"])
    lake.dimension.build()
    lake.rows = [r for r in lake.rows if r not in rows] + changed
    lake.check()


def test_one_day_is_listed(lake):
    rows = read_days(lake.spark, lake.layout, [at(24).date()])
    assert {f.split("ingested_date=")[1][:10] for f in rows.inputFiles()} == {str(at(24).date())}
    assert "1 paths" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == sum(r[5].date() == at(24).date() for r in lake.rows)
    assert read_days(lake.spark, lake.layout, [datetime(1999, 1, 1).date(), None]).count() == 0


def test_rows_without_a_time_of_ingestion_have_a_folder(spark):
    layout = Layout(scratch_dir(spark, "bronze"), copy_buckets=2)
    write_load(frame(spark, [raw_row("1", "r", at(0), None), raw_row("2", "r", at(0), at(0))]), layout, "a")
    assert read_loads(spark, layout, ["a"]).count() == 2
    assert [r["event_id"] for r in read_days(spark, layout, [None]).collect()] == ["1"]


def test_a_message_is_read_and_decoded_once(spark, topic):  # noqa: F811
    path, send, layout = topic
    send(event("a"), b"junk", event("b"), None)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    messages = spark.read.parquet(path)
    assert load_batch(spark, layout, messages.mapInArrow(counted, messages.schema), "one") == 2
    assert read.value == 4
    assert bronze.read_dead_letters(spark, layout).count() == 2
    assert read_loads(spark, layout, ["one"]).count() == 2


def test_published_ids_are_read_by_bucket(spark, topic, monkeypatch):  # noqa: F811
    path, send, layout = topic
    out = file_sink(f"{layout.root}/out")
    asked = []
    own = publishing.published_ids

    def recorded(spark, layout, buckets=None):
        asked.append(buckets)
        return own(spark, layout, buckets)

    monkeypatch.setattr(publishing, "published_ids", recorded)
    send(*[event(f"e{n}") for n in range(40)])
    assert publishing.publish(spark, file_source(path), out, layout) == 40
    send(event("e3"))
    assert publishing.publish(spark, file_source(path), out, layout) == 0
    assert len(asked[0]) == 4 and len(asked[2]) == 1
    send(event("f"), event("e4"))
    assert publishing.publish(spark, file_source(path), out, layout) == 1
    ids = sorted(r["event_id"] for r in own(spark, layout).collect())
    publishing.compact_published(spark, layout)
    assert sorted(r["event_id"] for r in own(spark, layout).collect()) == ids
    send(event("e5"), event("g"))
    assert publishing.publish(spark, file_source(path), out, layout) == 1


def test_an_update_shuffles_snapshots_once_and_no_stored_version(lake, monkeypatch):
    """As where tables are too large for a broadcast: what a staged frame's plan, or the comparison's, shuffles."""
    plans, own, changed = {}, dimension.stage, dimension.DimensionTable._changed

    def plan(rows):
        return rows._jdf.queryExecution().executedPlan().toString().splitlines()

    def recorded(rows, name, **metrics):
        plans[name] = plan(rows)
        return own(rows, name, **metrics)

    def compared(old, new):
        # As they are read, without the join that picks them.
        plans["changed"] = plan(changed(new, new))
        return changed(old, new)

    monkeypatch.setattr(dimension, "stage", recorded)
    monkeypatch.setattr(dimension.DimensionTable, "_changed", staticmethod(compared))
    rows = [raw_row(None, "own", at(24 * 3 + 1), at(24 * 9), stars="5"), raw_row("late", "own", at(24), at(24 * 9), stars="6")]
    write_load(frame(lake.spark, rows), lake.layout, "late")
    progress.loaded(lake.spark, lake.layout, "late", 2, 0)
    lake.rows += rows
    threshold = lake.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    lake.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake.dimension.update(["late"])
    finally:
        lake.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lake.fact.update(["late"])
    lake.check()

    def exchanges(name):
        return [line.split("Exchange ")[1] for line in plans[name] if "Exchange " in line]

    # The copies and the ids for the join, then both sides of the join with the touched entities; none for the window.
    assert [e.split("#")[0] for e in exchanges("events")] == [
        "hashpartitioning(repo_name", "hashpartitioning(_id", "hashpartitioning(_id", "hashpartitioning(repo_name"]
    # Payloads are parsed below that shuffle.
    lines = plans["events"]
    parsed = max(i for i, line in enumerate(lines) if "from_json" in line)
    assert [i for i, line in enumerate(lines) if "Exchange hashpartitioning(_id" in line][0] < parsed
    assert [e.split("#")[0] for e in exchanges("fresh")] == ["hashpartitioning(repo_name"]
    assert [e.split("#")[0] for e in exchanges("changed")] == ["hashpartitioning(part"]


def test_partitions_that_differ_are_told_by_nulls_and_microseconds_as_well(spark, lake):
    table = lake.dimension
    stored = table._stored().filter("repo_name = 'own'")
    assert stored.count() == 5 and table._changed(stored, stored).collect() == []
    parts = {r["part"] for r in stored.select(dimension._partition().alias("part")).collect()}
    moved = {
        "repo_description": "cast(null as string)",
        "repo_language": "repo_description",
        "valid_from": "valid_from + interval 1 microsecond",
        "stargazers_count": "stargazers_count + 1",
    }
    for column, value in moved.items():
        other = stored.withColumn(column, F.expr(value))
        assert {r["part"] for r in table._changed(stored, other).collect()} == parts, column
    # The same values where others are null.
    left = stored.withColumn("repo_language", F.lit(None).cast("string")).withColumn("repo_description", F.lit("a"))
    right = stored.withColumn("repo_language", F.lit("a")).withColumn("repo_description", F.lit(None).cast("string"))
    assert {r["part"] for r in table._changed(left, right).collect()} == parts
    none = stored.limit(0)
    assert {(r["part"], r["is_fresh"]) for r in table._changed(stored, none).collect()} == {(p, False) for p in parts}
    assert {(r["part"], r["is_fresh"]) for r in table._changed(none, stored).collect()} == {(p, True) for p in parts}
