"""Events as keyed messages, each id once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.json import normalised, with_strings


def keyed_events(records: DataFrame) -> DataFrame:
    """Add the `event_id` of the event in `value`, as JSON text or bytes.

    Records without a string id are left out.
    """
    texts = records.withColumn("_text", F.col("value").cast("string"))
    keyed = with_strings(texts, "_text", {"event_id": "$.id"}, "_is_object")
    return keyed.drop("_text", "_is_object").filter(F.col("event_id").isNotNull())


def new_events(keyed: DataFrame, arrival: Column, published: DataFrame | None = None) -> DataFrame:
    """The first arrival of each id that is not among the `event_id`s of `published`.

    Copies are dropped before the join, and before the shuffle within each task.
    """
    first = Window.partitionBy("event_id").orderBy(arrival)
    fresh = keyed.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    if published is not None:
        fresh = fresh.join(published.select("event_id"), "event_id", "left_anti")
    return fresh


def as_messages(keyed: DataFrame) -> DataFrame:
    """Key and value as the message sink takes them: the id, and the event as JSON text."""
    return keyed.select(
        F.col("event_id").cast("binary").alias("key"),
        normalised(F.col("value").cast("string")).cast("binary").alias("value"),
    )
