"""From message bytes to bronze rows, or to the dead letter table with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.json import is_whole_json, normalised, with_strings
from eventmart.functions.time import utc_now
from eventmart.schemas import RAW_EVENTS

# Where the bronze columns are in an event.
_STRINGS = {
    "event_id": "$.id",
    "event_type": "$.type",
    "actor_login": "$.actor.login",
    "repo_name": "$.repo.name",
    "created_at": "$.created_at",
}


# Fixed value: a time begins with a full date (ISO 8601). The parser alone would take a time of day for today's.
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}([T ]|$)"


def decode(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add the bronze columns and a `reason`, which is null on rows that decode.

    Only JSON strings are taken over: a number, an object or a missing parent gives null. The payload
    is the whole event as JSON text.
    """
    kept = messages.columns
    texts = messages.withColumn("_text", F.col("value").cast("string"))
    created_at = F.when(F.col("created_at").rlike(_ISO_DATE), F.try_to_timestamp("created_at"))
    return with_strings(texts, "_text", _STRINGS, "_is_object").select(
        *kept,
        "event_id",
        "event_type",
        "actor_login",
        "repo_name",
        created_at.cast("timestamp_ntz").alias("event_created_at"),
        (utc_now() if ingested_at is None else ingested_at).alias("ingested_at"),
        normalised("_text").alias("payload"),
        F.when(F.col("_is_object") & F.col("event_id").isNull(), "id")
        .when(F.col("_is_object") & F.col("created_at").isNotNull() & created_at.isNull(), "timestamp")
        .when(F.col("_is_object"), None)
        .when(F.col("value").isNull(), "null value")
        .when(~F.is_valid_utf8("_text"), "encoding")
        .when(~is_whole_json("_text"), "malformed")
        .otherwise("not an object")
        .alias("reason"),
    )


def bronze_rows(decoded: DataFrame) -> DataFrame:
    """The decoded rows, in the bronze schema."""
    return decoded.filter(F.col("reason").isNull()).select(*RAW_EVENTS.fieldNames())


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The messages that did not decode, with the reason."""
    return decoded.filter(F.col("reason").isNotNull())
