"""Silver: typed events, one row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.json import at_path, parse_paths, select_paths
from eventmart.operators.dedup import PAYLOAD_HASH, RANKING, latest_copies, latest_copies_of
from eventmart.schemas import ENTITY_ATTRIBUTES, SILVER_FIELDS, Attribute

_COLUMNS = ("event_id", "event_type", "actor_login", "repo_name", "event_created_at", "ingested_at")


def typed_events(raw: DataFrame) -> DataFrame:
    """Bronze rows with the payload fields as text columns; copies are kept."""
    return raw.select(
        *_COLUMNS,
        parse_paths("payload", list(SILVER_FIELDS.values())).alias("_fields"),
        "payload",
    ).select(*_COLUMNS, *select_paths("_fields", SILVER_FIELDS), "payload")


def silver_events(raw: DataFrame) -> DataFrame:
    """The silver view: the latest copy of each event, with its payload. Only that copy is parsed."""
    hashed = raw.select(*_COLUMNS, "payload", F.xxhash64("payload").alias(PAYLOAD_HASH))
    return typed_events(latest_copies(hashed))


def event_facts(raw: DataFrame) -> DataFrame:
    """Silver without payload columns: neither read from the scan nor shuffled."""
    return latest_copies(raw.select("event_id", *RANKING))


def recent_facts(raw: DataFrame, since: Column) -> DataFrame:
    """Silver facts from a time on, without a dedup of all there is.

    Copies of an event may name other times: first come the ids with any copy in reach, then all copies of
    those, then the dedup.
    """
    recent = F.col("event_created_at") >= since
    ids = raw.filter(recent & F.col("event_id").isNotNull()).select("event_id").distinct()
    wanted = ids.select(F.col("event_id").alias("_wanted"))
    copies = raw.join(wanted, F.col("event_id") == F.col("_wanted"), "left_semi")
    # Rows without an id count as copies of each other.
    copies = copies.unionByName(raw.filter("event_id is null"))
    return event_facts(copies).filter(recent)


def copies_about(raw: DataFrame, entity: str) -> DataFrame:
    """All copies of the events that any copy says to be one of an entity: enough for the entity's history.

    The payload is read of these alone.
    """
    ids = raw.filter((F.col("repo_name") == entity) & F.col("event_id").isNotNull()).select("event_id").distinct()
    wanted = ids.select(F.col("event_id").alias("_wanted"))
    found = raw.join(wanted, F.col("event_id") == F.col("_wanted"), "left_semi")
    # Rows without an id count as copies of each other.
    return found.unionByName(raw.filter("event_id is null"))


def entity_events(raw: DataFrame, attributes: tuple[Attribute, ...] = ENTITY_ATTRIBUTES) -> DataFrame:
    """The entity snapshot each silver event carries.

    The payload is parsed and hashed before the dedup, so only the snapshot is shuffled.
    """
    return _about_entities(latest_copies(_snapshots(raw, attributes)), attributes)


def entity_events_of(
    raw: DataFrame, ids: DataFrame, lowest: str | None, highest: str | None, attributes: tuple[Attribute, ...]
) -> DataFrame:
    """`entity_events` of the events in `ids`, which holds each id once, with the bounds of these."""
    return _about_entities(latest_copies_of(_snapshots(raw, attributes), ids, lowest, highest), attributes)


def _snapshots(raw: DataFrame, attributes: tuple[Attribute, ...]) -> DataFrame:
    return raw.select(
        "event_id",
        *RANKING,
        F.xxhash64("payload").alias(PAYLOAD_HASH),
        parse_paths("payload", [a.path for a in attributes]).alias("_snapshot"),
    )


def _about_entities(latest: DataFrame, attributes: tuple[Attribute, ...]) -> DataFrame:
    return latest.filter(F.col("repo_name").isNotNull()).select(
        "repo_name",
        "event_created_at",
        "event_id",
        *[at_path("_snapshot", a.path).try_cast(a.type).alias(a.name) for a in attributes],
    )
