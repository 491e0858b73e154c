"""A seed file through silver, gold and the serving queries, against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventmart.operators.hourly import hourly_fact
from eventmart.operators.scd2 import dimension
from eventmart.operators.silver import entity_events, event_facts, silver_events
from eventmart.plans import marts
from eventmart.schemas import RAW_EVENTS
from eventmart.sources.seed import read_seed
from tests import seed
from tests.worlds import compatible_versions, hourly, stored_versions, strict_versions


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return read_seed(spark, seed.write_csv(tmp_path_factory.mktemp("seed") / "raw_events.csv")).cache()


def test_rows_are_read_as_they_were_written(raw):
    assert raw.schema == RAW_EVENTS
    assert sorted(tuple(r) for r in raw.collect()) == sorted(seed.rows())


def test_silver(raw):
    counts = silver_events(raw).agg(F.count("*"), *[F.count(c) for c in ("action", "ref", "is_public")])
    actions = sum(e["payload"]["action"] is not None for e in seed.events())
    assert tuple(counts.first()) == (seed.SIZE, actions, 0, seed.SIZE)


def test_overall_and_counts(raw):
    events, facts = seed.events(), event_facts(raw)
    kinds = Counter(e["type"] for e in events)
    keepers = {e["actor"]["login"] for e in events}
    by_station = defaultdict(list)
    for e in events:
        by_station[e["repo"]["name"]].append(e)
    assert tuple(marts.overall(facts).first()) == (seed.SIZE, len(keepers), len(by_station), len(kinds))
    assert [tuple(r) for r in marts.event_types(facts).collect()] == sorted(kinds.items(), key=lambda x: (-x[1], x[0]))
    expected = [
        (name, len(own), len({e["actor"]["login"] for e in own}), len({e["type"] for e in own}))
        for name, own in by_station.items()
    ]
    assert [tuple(r) for r in marts.top_repos(facts).collect()] == sorted(expected, key=lambda x: (-x[1], x[0]))


def test_hourly_fact(raw):
    fact = hourly_fact(event_facts(raw))
    assert {tuple(r) for r in fact.collect()} == hourly(seed.rows())
    series = [tuple(r) for r in marts.hourly_series(fact).collect()]
    assert series == sorted((hour, kind, n) for hour, kind, n, _, _ in hourly(seed.rows()))


@pytest.mark.parametrize("max_rows", [10**6, 5])
def test_dimension(raw, max_rows):
    strict = dimension(entity_events(raw), max_rows=max_rows).cache()
    assert set(stored_versions(strict)) == strict_versions(seed.rows())
    for r in strict.collect():
        text = f"{r.repo_name}{r.valid_from.isoformat(sep=' ')}"
        assert r.repo_version_key == hashlib.md5(text.encode()).hexdigest()
        assert r.is_current == (r.valid_to is None)
    compatible = dimension(entity_events(raw), strict=False, max_rows=max_rows)
    assert Counter(stored_versions(compatible)) == Counter(compatible_versions(seed.rows()))


def test_serving_the_dimension(raw):
    table = dimension(entity_events(raw))
    versions = strict_versions(seed.rows())
    counts = Counter(v[0] for v in versions)
    assert [tuple(r) for r in marts.versions_per_repo(table).collect()] == sorted(
        counts.items(), key=lambda x: (-x[1], x[0])
    )
    current = sorted((v for v in versions if v[5] is None), key=lambda v: (-v[3], v[0]))
    assert [tuple(r) for r in marts.entities_current(table).collect()] == [v[:5] for v in current]
    station = seed.STATIONS[1]
    history = sorted((v[4], *v[1:4], "" if v[5] else "current") for v in versions if v[0] == station)
    assert [tuple(r) for r in marts.entity_history(table, station).collect()] == history
