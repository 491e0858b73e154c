"""A generated history: measuring stations that report, change their state and are read by keepers."""

from __future__ import annotations

import csv
import json
import random
from datetime import datetime, timedelta
from pathlib import Path

BEGIN = datetime(2023, 11, 4, 21, 30)
STATIONS = ("harbour/tide", "ridge/wind", "valley/rain", "delta/silt")
KINDS = ("ForkEvent", "GollumEvent", "MemberEvent", "PublicEvent", "WatchEvent")
STATES = ("dry", "wet", "frozen")
SIZE = 48


def events() -> list[dict]:
    """The events as messages, each at a time of its own."""
    rng = random.Random(20231104)
    state = {s: [rng.choice(STATES), f"{s} at rest", rng.randint(1, 90)] for s in STATIONS}
    found, clock = [], BEGIN
    for n in range(SIZE):
        clock += timedelta(minutes=rng.randint(1, 11), seconds=rng.randint(0, 59))
        station = rng.choice(STATIONS)
        own = state[station]
        change = rng.random()
        if change < 0.3:
            own[2] += rng.randint(1, 5)
        elif change < 0.45:
            own[0] = rng.choice(STATES)
        elif change < 0.55:
            own[1] = f"{station} after {n} readings"
        found.append(
            {
                "id": f"reading-{n:02d}",
                "type": rng.choice(KINDS),
                "actor": {"login": f"keeper-{rng.randint(1, 9)}"},
                "repo": {"id": str(STATIONS.index(station)), "name": station},
                "created_at": clock.strftime("%Y-%m-%dT%H:%M:%SZ"),
                "payload": {
                    "action": rng.choice([None, "read", "reset"]),
                    "repository": {"language": own[0], "description": own[1], "stargazers_count": str(own[2])},
                },
                "public": True,
            }
        )
    return found


def created(event: dict) -> datetime:
    return datetime.strptime(event["created_at"], "%Y-%m-%dT%H:%M:%SZ")


def rows() -> list[tuple]:
    """The events as bronze rows, taken in twenty seconds after they happened."""
    return [
        (
            e["id"], e["type"], e["actor"]["login"], e["repo"]["name"], created(e),
            created(e) + timedelta(seconds=20), json.dumps(e),
        )
        for e in events()
    ]


def write_csv(path: Path) -> str:
    """The rows as a seed file: a header, times with a zone, and JSON quoted with doubled quotes."""
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow("event_id event_type actor_login repo_name event_created_at ingested_at payload".split())
        for *names, at, taken, text in rows():
            writer.writerow([*names, f"{at.isoformat()}Z", f"{taken.isoformat()}Z", text])
    return str(path)
