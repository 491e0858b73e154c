"""Declared schemas, and the fixed values of the event model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Message contract, the same as that of Spark's Kafka source.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("actor_login", T.StringType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("event_created_at", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("payload", T.StringType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

HOURLY_FACT = T.StructType(
    [
        T.StructField("event_hour", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("unique_actors", T.LongType()),
        T.StructField("unique_repos", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Attribute:
    """One column of the versioned dimension, read from the event payload.

    A change in a tracked attribute opens a new version; the others are carried along.
    """

    name: str
    path: str
    type: str = "string"
    tracked: bool = True


# The entity snapshot inside an event payload. The first tracked attribute is the one
# the compatible change rule tests for null.
ENTITY_ATTRIBUTES = (
    Attribute("repo_id", "$.repo.id", tracked=False),
    Attribute("repo_language", "$.payload.repository.language"),
    Attribute("repo_description", "$.payload.repository.description"),
    Attribute("stargazers_count", "$.payload.repository.stargazers_count", "bigint"),
)

# Payload fields typed in silver.
SILVER_FIELDS = {
    "action": "$.payload.action",
    "ref": "$.payload.ref",
    "ref_type": "$.payload.ref_type",
    "is_public": "$.public",
}

# The event types a feed may carry.
EVENT_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "IssueCommentEvent",
    "WatchEvent",
    "ForkEvent",
    "CreateEvent",
    "DeleteEvent",
    "ReleaseEvent",
    "PublicEvent",
    "MemberEvent",
    "CommitCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "GollumEvent",
)


def dimension_schema(attributes: tuple[Attribute, ...] = ENTITY_ATTRIBUTES) -> T.StructType:
    """Columns of the versioned dimension for a set of attributes."""
    fields = [T.StructField("repo_version_key", T.StringType()), T.StructField("repo_name", T.StringType())]
    fields += [T.StructField(a.name, T.DataType.fromDDL(a.type)) for a in attributes]
    fields += [
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
        T.StructField("is_current", T.BooleanType()),
    ]
    return T.StructType(fields)
