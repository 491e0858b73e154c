"""Messages to bronze or dead letter."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.operators.decode import bronze_rows, decode
from eventmart.schemas import RAW_EVENTS
from eventmart.session import configure


def event(**changes) -> dict:
    """A reading of a station, with some fields changed."""
    station = {"name": "ridge/wind", "id": "1"}
    reading = {"repository": {"language": "dry", "stargazers_count": "7"}}
    base = {"public": False, "payload": reading, "repo": station, "actor": {"login": "keeper"}}
    return base | {"created_at": "2023-11-04T22:10:05Z", "type": "GollumEvent", "id": "r-7"} | changes


def without(key: str) -> dict:
    return {k: v for k, v in event().items() if k != key}


def as_bytes(value) -> bytes:
    return json.dumps(value).encode()


CREATED = datetime(2023, 11, 4, 22, 10, 5)
GOOD = ("r-7", "GollumEvent", "keeper", "ridge/wind", CREATED)

ROWS = {
    "well formed": (as_bytes(event()), GOOD),
    "parents null": (as_bytes(event(actor=None, repo=None)), ("r-7", "GollumEvent", None, None, CREATED)),
    "type null": (as_bytes(event(type=None)), ("r-7", None, "keeper", "ridge/wind", CREATED)),
    "type a number": (as_bytes(event(type=7)), ("r-7", None, "keeper", "ridge/wind", CREATED)),
    "actor a scalar": (as_bytes(event(actor="someone")), ("r-7", "GollumEvent", None, "ridge/wind", CREATED)),
    "actor an array": (as_bytes(event(actor=[{"login": "x"}])), ("r-7", "GollumEvent", None, "ridge/wind", CREATED)),
    "login an object": (as_bytes(event(actor={"login": {}})), ("r-7", "GollumEvent", None, "ridge/wind", CREATED)),
    "no time": (as_bytes(without("created_at")), (*GOOD[:4], None)),
    "time a number": (as_bytes(event(created_at=5)), (*GOOD[:4], None)),
    "time with offset": (as_bytes(event(created_at="2023-11-05T00:10:05+02:00")), GOOD),
    "space around": (b" \n\t" + as_bytes(event()) + b"\r\n ", GOOD),
    "inner key twice": (b'{"id": "r-7", "actor": {"login": "a", "login": "b"}}', ("r-7", None, "b", None, None)),
    "empty strings": (as_bytes(event(type="", actor={"login": ""})), ("r-7", "", "", "ridge/wind", CREATED)),
    "escapes": (as_bytes(event(type='a"\\\n\u00e9')), ("r-7", 'a"\\\n\u00e9', "keeper", "ridge/wind", CREATED)),
    "key twice": (b'{"id": "1", "id": "r-7"}', ("r-7", None, None, None, None)),
    "no letters but ascii": (as_bytes(event(type="Ünï")), ("r-7", "Ünï", "keeper", "ridge/wind", CREATED)),
}

DEAD = {
    "tombstone": (None, "null value"),
    "broken utf-8": (b'{"id": "a\xff"}', "encoding"),
    "not json": (b"{not-json", "malformed"),
    "empty": (b"", "malformed"),
    "text after the event": (as_bytes(event()) + b" xyz", "malformed"),
    "two events": (as_bytes(event()) + as_bytes(event()), "malformed"),
    "two events and a comma": (as_bytes(event()) + b"," + as_bytes(event()), "malformed"),
    "bracket after the event": (as_bytes(event()) + b"],[{}", "malformed"),
    "fields after the event": (as_bytes(event()) + b',"x":1', "malformed"),
    "broken inside": (b'{"id": "r-7", "payload": {"a": tru}}', "malformed"),
    "empty object": (b"{}", "id"),
    "broken array": (b"[1", "malformed"),
    "cut short": (as_bytes(event())[:-1], "malformed"),
    "array": (b"[1]", "not an object"),
    "array of events": (as_bytes([event()]), "not an object"),
    "number": (b"42", "not an object"),
    "string": (b'"x"', "not an object"),
    "null": (b"null", "not an object"),
    "number id": (as_bytes(event(id=42, type=None)), "id"),
    "null id": (as_bytes(event(id=None)), "id"),
    "no id": (as_bytes(without("id")), "id"),
    "bad time": (as_bytes(event(created_at="nope")), "timestamp"),
    "time of day": (as_bytes(event(created_at="12:30")), "timestamp"),
    "year": (as_bytes(event(created_at="2024")), "timestamp"),
    "month": (as_bytes(event(created_at="2024-05")), "timestamp"),
    "date and words": (as_bytes(event(created_at="2024-05-01 or so")), "timestamp"),
    "forged end mark": (as_bytes(event()) + b',{"end-of-text":true}]garbage', "malformed"),
    "forged text mark": (as_bytes(event()) + b',"end-of-text"]garbage', "malformed"),
    "forged digest": (as_bytes(event()) + b',{"end-of-text":"d41d8cd98f00b204e9800998ecf8427e"}]', "malformed"),
}


@pytest.fixture(scope="module")
def decoded(spark):
    configure(spark)
    cases = [(name, value) for name, (value, _) in (ROWS | DEAD).items()]
    messages = spark.createDataFrame(cases, "name string, value binary")
    return decode(messages, F.lit(datetime(2026, 2, 2)).cast("timestamp_ntz"))


@pytest.mark.parametrize("name", ROWS)
def test_bronze(decoded, name):
    row = decoded.filter(F.col("name") == name).first()
    assert row["reason"] is None
    assert tuple(row[c] for c in RAW_EVENTS.fieldNames()[:5]) == ROWS[name][1]
    assert row["ingested_at"] == datetime(2026, 2, 2)


@pytest.mark.parametrize("name", DEAD)
def test_dead_letter(decoded, name):
    row = decoded.filter(F.col("name") == name).first()
    assert row["reason"] == DEAD[name][1]


def test_payload_holds_the_whole_event(decoded):
    row = decoded.filter(F.col("name") == "well formed").first()
    assert json.loads(row["payload"]) == event()


def test_bronze_schema(decoded):
    assert bronze_rows(decoded).schema.names == RAW_EVENTS.names
    assert [f.dataType for f in bronze_rows(decoded).schema] == [f.dataType for f in RAW_EVENTS]
    assert bronze_rows(decoded).count() == len(ROWS)
