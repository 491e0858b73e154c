"""Small random event histories, and what they come to, in plain Python."""

from __future__ import annotations

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from eventmart.schemas import RAW_EVENTS

START = datetime(2024, 3, 30, 22)


def payload(event_id, language, description, stars, repo_id="1") -> str:
    repository = {"language": language, "description": description, "stargazers_count": stars}
    return json.dumps({"id": event_id, "repo": {"id": repo_id}, "payload": {"repository": repository}})


def raw_row(event_id, repo, created, ingested, language="x", description="d", stars="1", kind="PushEvent", actor="a"):
    text = payload(event_id, language, description, stars)
    return (event_id, kind, actor, repo, created, ingested, text)


def random_rows(rng: random.Random, worlds: int, events: int = 7) -> list[tuple]:
    """Rows of many histories that share nothing: ties, nulls, copies that agree and that do not.

    Rows come in the order of ingestion; no two rows are ingested at the same time.
    """
    rows = []
    clock = datetime(2024, 5, 1)
    for world in range(worlds):
        copies: list[tuple] = []
        for n in range(rng.randint(1, events)):
            again = copies and rng.random() < 0.35
            old = rng.choice(copies) if again else None
            clock += timedelta(seconds=1)
            if old is not None and rng.random() < 0.4:
                row = (*old[:5], clock, old[6])
            else:
                event_id = old[0] if old is not None else f"{world}-{n}"
                row = raw_row(
                    event_id,
                    rng.choice([f"{world}/a", f"{world}/b", f"{world}/a", None]),
                    rng.choice([None, *[START + timedelta(hours=rng.randint(0, 8) * 5)] * 9]),
                    clock,
                    rng.choice(["x", "y", None]),
                    rng.choice(["d", None]),
                    rng.choice(["1", "2", "junk", None]),
                    rng.choice(["PushEvent", "ForkEvent"]),
                    rng.choice(["a", "b", None]),
                )
            copies.append(row)
        rows += copies
    return rows


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RAW_EVENTS)


def latest(rows: list[tuple]) -> list[tuple]:
    newest: dict = {}
    for row in rows:
        if row[0] not in newest or row[5] > newest[row[0]][5]:
            newest[row[0]] = row
    return list(newest.values())


def _snapshot(text: str) -> tuple:
    event = json.loads(text)
    repository = event["payload"]["repository"]
    stars = repository["stargazers_count"]
    stars = int(stars) if stars is not None and stars.isdigit() else None
    return repository["language"], repository["description"], stars


def strict_versions(rows: list[tuple]) -> set[tuple]:
    """(repo, language, description, stars, valid_from, valid_to)"""
    timelines: dict = defaultdict(dict)
    for row in sorted(latest(rows), key=lambda r: r[0] or ""):
        if row[3] is not None and row[4] is not None:
            timelines[row[3]][row[4]] = _snapshot(row[6])
    found = set()
    for repo, timeline in timelines.items():
        opened = []
        for when in sorted(timeline):
            if not opened or opened[-1][1] != timeline[when]:
                opened.append((when, timeline[when]))
        ends = [when for when, _ in opened[1:]] + [None]
        found |= {(repo, *what, when, end) for (when, what), end in zip(opened, ends, strict=True)}
    return found


def compatible_versions(rows: list[tuple]) -> list[tuple]:
    timelines: dict = defaultdict(list)
    for row in latest(rows):
        if row[3] is not None:
            timelines[row[3]].append(row)
    found = []
    for repo, timeline in timelines.items():
        timeline.sort(key=lambda r: (r[4] is None, r[4] or START, r[0] or ""))
        opened, previous = [], (None, None, None)
        for row in timeline:
            what = _snapshot(row[6])
            if previous[0] is None or what != previous:
                opened.append((row[4], what))
            previous = what
        ends = [when for when, _ in opened[1:]] + [None]
        found += [(repo, *what, when, end) for (when, what), end in zip(opened, ends, strict=True)]
    return found


def hourly(rows: list[tuple]) -> set[tuple]:
    groups: dict = defaultdict(list)
    for row in latest(rows):
        hour = None if row[4] is None else row[4].replace(minute=0, second=0)
        groups[hour, row[1]].append(row)
    return {
        (hour, kind, len(g), len({r[2] for r in g} - {None}), len({r[3] for r in g} - {None}))
        for (hour, kind), g in groups.items()
    }


VERSION_COLUMNS = ("repo_name", "repo_language", "repo_description", "stargazers_count", "valid_from", "valid_to")


def stored_versions(table: DataFrame) -> list[tuple]:
    return [tuple(r) for r in table.select(*VERSION_COLUMNS).collect()]
