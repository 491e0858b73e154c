"""Tables kept up to date load by load equal those built in full."""

from __future__ import annotations

import json
import os
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.plans.dimension import DimensionTable
from eventmart.plans.fact import FactTable
from eventmart.plans.pipeline import compact_bronze, finish_compaction
from eventmart.schemas import ENTITY_ATTRIBUTES, Attribute
from eventmart.session import scratch_dir
from eventmart.sources import files, progress
from eventmart.sources.bronze import create_tables, read_raw_events, write_load
from eventmart.sources.layout import Layout
from tests.worlds import frame, hourly, random_rows, raw_row, stored_versions, strict_versions

AT = datetime(2024, 1, 31, 12)
# Each takes some twenty seconds; more for a release: PROPERTY_EXAMPLES=25.
EXAMPLES = int(os.environ.get("PROPERTY_EXAMPLES", "2"))


def at(hours: float) -> datetime:
    return AT + timedelta(hours=hours)


class Tables:
    """Both gold tables over one bronze table, and what they should hold."""

    def __init__(self, spark, max_rows=10**6, buckets=2):
        self.spark = spark
        self.layout = Layout(scratch_dir(spark, "tables"), copy_buckets=2)
        self.dimension = DimensionTable(spark, self.layout, buckets=buckets, max_rows=max_rows)
        self.fact = FactTable(spark, self.layout)
        self.rows: list[tuple] = []
        create_tables(spark, self.layout)

    def land(self, rows: list[tuple]) -> str:
        load = f"load-{len(self.rows)}"
        write_load(frame(self.spark, rows), self.layout, load)
        progress.loaded(self.spark, self.layout, load, len(rows), 0)
        self.rows = self.rows + rows
        return load

    def add(self, rows: list[tuple]) -> None:
        load = self.land(rows)
        self.dimension.update([load])
        self.fact.update([load])
        self.check()

    def check(self) -> None:
        stored = stored_versions(self.dimension.read())
        assert Counter(stored) == Counter(strict_versions(self.rows))
        opened = [v[4] for v in stored]
        assert self.dimension.high_water() == max(opened, default=None)
        current = stored_versions(self.dimension.read_current())
        assert Counter(current) == Counter(v for v in stored if v[5] is None)
        stored = [tuple(r) for r in self.fact.read().drop("event_date").collect()]
        assert Counter(stored) == Counter(hourly(self.rows))
        for name in (progress.DIMENSION, progress.FACT):
            assert not progress.pending(self.spark, self.layout, name)


@settings(max_examples=EXAMPLES, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10**6), batches=st.integers(2, 4), max_rows=st.sampled_from([3, 10**6]))
def test_any_split_and_order(spark, seed, batches, max_rows):
    """Many small histories at once, their rows dealt out to batches at random."""
    rng = random.Random(seed)
    dealt: list[list[tuple]] = [[] for _ in range(batches)]
    for row in random_rows(rng, worlds=80):
        rng.choice(dealt).append(row)
    tables = Tables(spark, max_rows=max_rows)
    for rows in dealt:
        tables.add(rows)


def test_late_event_before_all_versions_and_between(spark):
    tables = Tables(spark)
    tables.add([raw_row("1", "r", at(0), at(0), stars="1"), raw_row("2", "r", at(4), at(4), stars="2")])
    tables.add([raw_row("3", "r", at(-900), at(5), stars="9"), raw_row("4", "r", at(2), at(5), stars="5")])


def test_copy_moves_an_event_and_empties_its_partitions(spark):
    """The old day, and the old entity's bucket and month, are left without rows."""
    tables = Tables(spark, buckets=8)
    tables.add([raw_row("1", "r", at(0), at(0)), raw_row("2", "s", at(0), at(0))])
    tables.add([raw_row("1", "t", at(48), at(1)), raw_row("2", "t", at(72), at(1))])
    assert tables.fact.read().select("event_date").distinct().count() == 2


def test_copy_replaces_the_event_that_opened_the_current_version(spark):
    tables = Tables(spark)
    tables.add([raw_row("1", "r", at(0), at(0), stars="1"), raw_row("2", "r", at(4), at(4), stars="2")])
    tables.add([raw_row("2", "r", at(4), at(6), stars="1"), raw_row("3", "r", at(8), at(8), stars="1")])


def test_rows_without_entity_or_time_or_id(spark):
    tables = Tables(spark)
    tables.add([raw_row("1", None, at(0), at(0)), raw_row("2", "r", None, at(0))])
    tables.add([raw_row(None, "r", at(0), at(1)), raw_row("3", None, None, at(1))])
    tables.add([raw_row(None, "s", at(30), at(2)), raw_row("2", "r", at(1), at(3))])


def test_old_versions_of_a_busy_entity_are_not_rewritten(spark):
    tables = Tables(spark, buckets=1)
    tables.add([raw_row(str(i), "r", at(24 * 20 * i), at(0), stars=str(i)) for i in range(6)])
    path = tables.layout.dimension + "/state=past/bucket=0/valid_month=202401"
    before = files.names_in(spark, path)
    tables.add([raw_row("9", "r", at(24 * 110), at(1), stars="77")])
    assert files.names_in(spark, path) == before


@pytest.mark.parametrize("broken", ["missing", "cut short"])
def test_update_repairs_what_a_died_one_left(spark, broken):
    tables = Tables(spark)
    tables.add([raw_row(str(i), f"r{i}", at(i), at(i)) for i in range(8)])
    load = tables.land([raw_row(str(i), f"r{i - 4}", at(i + 40), at(i), stars="7") for i in range(8, 12)])
    # The writes of that load died: the notes are there, partitions are gone.
    progress.started(spark, tables.layout, progress.DIMENSION, [load], [0, 1])
    days = f"{tables.layout.days(progress.FACT)}/died"
    spark.createDataFrame([(date(2024, 2, 2),)], "day date").write.parquet(days)
    progress.started(spark, tables.layout, progress.FACT, [load], [days])
    files.delete(spark, f"{tables.layout.dimension}/state=past/bucket=1")
    files.delete(spark, f"{tables.layout.dimension}/state=in_force/bucket=1")
    files.delete(spark, f"{tables.layout.fact}/event_date=2024-02-02")
    if broken == "cut short":
        for name in (progress.DIMENSION, progress.FACT):
            files.write_text(spark, f"{tables.layout.started(name)}/x.json", '{"lo')
            files.delete(spark, f"{tables.layout.root}/gold/{name}")
            files.make_directory(spark, f"{tables.layout.root}/gold/{name}")
    tables.add([raw_row("99", "r0", at(90), at(90), stars="8")])


def test_look_back_rewrites_whole_days(spark):
    tables = Tables(spark)
    tables.add([raw_row(str(i), "r", at(i - 12), at(i)) for i in range(15)])
    # A load the fact has not seen, with an event early on the day the look-back begins in.
    load = tables.land([raw_row("x", "s", at(-11.5), at(20)), raw_row("y", "s", at(2), at(20))])
    tables.dimension.update([load])
    tables.fact.look_back(at(2.5), hours=3)
    progress.finished(spark, tables.layout, progress.FACT, [load])
    tables.check()


def test_compaction_changes_no_result(spark):
    tables = Tables(spark)
    tables.add([raw_row("1", "r", at(0), at(0)), raw_row("2", "s", at(0), at(30))])
    tables.add([raw_row("1", "r", at(1), at(2), stars="4")])
    load = tables.land([raw_row("3", "r", at(3), at(3), stars="5")])
    with pytest.raises(ValueError, match="not taken in"):
        compact_bronze(spark, tables.layout, ["load-0", load], "day-1")
    compact_bronze(spark, tables.layout, ["load-0", "load-2"], "day-1")
    raw = read_raw_events(spark, tables.layout)
    assert {r["load"] for r in raw.select("load").distinct().collect()} == {"day-1", load}
    assert raw.count() == 4
    tables.dimension.update([load])
    tables.fact.update([load])
    tables.check()


def test_compaction_refuses_names_in_use_and_loses_no_row(spark):
    tables = Tables(spark)
    for n in range(3):
        tables.add([raw_row(str(n), "r", at(n), at(n))])
    for loads, into in ((["load-0", "load-1"], "load-0"), (["load-0", "load-1"], "load-2"), (["gone"], "day-1")):
        with pytest.raises(ValueError, match="load"):
            compact_bronze(spark, tables.layout, loads, into)
        assert read_raw_events(spark, tables.layout).count() == 3


@pytest.mark.parametrize("written", ["nothing", "some", "all"])
def test_a_compaction_that_died_is_finished_or_undone(spark, written):
    tables = Tables(spark)
    for n in range(3):
        tables.add([raw_row(str(n), "r", at(n), at(n))])
    note = json.dumps({"loads": ["load-0", "load-1"], "into": "day-1"})
    files.write_text(spark, tables.layout.compacting, note)
    if written != "nothing":
        kept = tables.rows[:2] if written == "all" else tables.rows[:1]
        write_load(frame(spark, kept), tables.layout, "day-1")
    finish_compaction(spark, tables.layout)
    raw = read_raw_events(spark, tables.layout)
    assert sorted(r["event_id"] for r in raw.collect()) == ["0", "1", "2"]
    left = {r["load"] for r in raw.select("load").distinct().collect()}
    assert left == ({"day-1", "load-2"} if written == "all" else {"load-0", "load-1", "load-2"})
    assert not files.exists(spark, tables.layout.compacting)


def test_another_number_of_buckets_is_refused(spark):
    tables = Tables(spark, buckets=8)
    tables.add([raw_row(str(i), f"r{i}", at(i), at(i)) for i in range(6)])
    other = DimensionTable(spark, tables.layout)
    load = tables.land([raw_row("9", "r1", at(9), at(9), stars="5")])
    with pytest.raises(ValueError, match="8 buckets"):
        other.update([load])
    with pytest.raises(ValueError, match="8 buckets"):
        other.read_entity("r1")
    tables.dimension.update([load])
    tables.fact.update([load])
    tables.check()


def test_recovery_fills_columns_of_an_earlier_schema(spark):
    tables = Tables(spark)
    wider = (*ENTITY_ATTRIBUTES, Attribute("source_id", "$.id", tracked=False))
    load = tables.land([raw_row(str(i), f"r{i}", at(i), at(i)) for i in range(4)])
    DimensionTable(spark, tables.layout, wider, buckets=2).update([load])
    tables.fact.update([load])
    progress.started(spark, tables.layout, progress.DIMENSION, [], [0, 1])
    tables.dimension.recover()
    found = {(r.repo_name, r.source_id) for r in tables.dimension.read().collect()}
    assert found == {(f"r{i}", str(i)) for i in range(4)}


def test_an_update_leaves_no_staged_folder(spark):
    tables = Tables(spark)
    tables.add([raw_row("1", "r", at(0), at(0))])
    shared = os.path.dirname(scratch_dir(spark, "any"))
    before = set(os.listdir(shared))
    tables.add([raw_row("2", "r", at(3), at(3), stars="4")])
    assert set(os.listdir(shared)) == before


def test_many_days_in_one_load_stay_an_update(spark, monkeypatch):
    tables = Tables(spark)
    tables.add([raw_row("0", "r", at(0), at(0))])
    monkeypatch.setattr(FactTable, "build", lambda *_: pytest.fail("built anew"))
    rows = [raw_row(str(n + 1), "r", datetime(2000, 1, 1) + timedelta(days=n), at(1)) for n in range(60)]
    load = tables.land(rows)
    tables.fact.update([load])
    assert tables.fact.read().count() == 61


def test_new_columns_are_appended(spark):
    """Rows from before the change read null; a column that is dropped later stays."""
    tables = Tables(spark)
    tables.add([raw_row("1", "r", at(0), at(0)), raw_row("2", "s", at(0), at(0))])
    wider = (*ENTITY_ATTRIBUTES, Attribute("source_id", "$.id", tracked=False))
    load = tables.land([raw_row("3", "r", at(5), at(5), stars="5")])
    DimensionTable(spark, tables.layout, wider, buckets=2).update([load])
    table = DimensionTable(spark, tables.layout, wider, buckets=2).read()
    assert {(r.repo_name, r.stargazers_count, r.source_id) for r in table.collect()} == {
        ("r", 1, None),
        ("s", 1, None),
        ("r", 5, "3"),
    }
    load = tables.land([raw_row("4", "r", at(9), at(9), stars="9")])
    tables.dimension.update([load])
    table = tables.dimension.read()
    assert {(r.repo_name, r.stargazers_count, r.source_id) for r in table.collect()} == {
        ("r", 1, None),
        ("s", 1, None),
        ("r", 5, "3"),
        ("r", 9, None),
    }
