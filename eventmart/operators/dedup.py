"""Latest copy of each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Copies of one event are ranked on these, so that every reader picks the same copy. Rows that tie
# on all of them differ only in the payload, whose hash is ranked last where the payload is read.
RANKING = ("ingested_at", "event_created_at", "repo_name", "event_type", "actor_login")
PAYLOAD_HASH = "_payload_hash"


def latest_copies(rows: DataFrame, by: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Keep the copy of each event_id that was ingested last.

    Catalyst turns `row_number() = 1` into a group limit before the shuffle, so an id with very many
    copies sends one row per task.
    """
    ranking = [*RANKING, *([PAYLOAD_HASH] if PAYLOAD_HASH in rows.columns else [])]
    latest_first = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in ranking])
    return rows.withColumn("_rank", F.row_number().over(latest_first)).filter("_rank = 1").drop("_rank")


def copies_of(rows: DataFrame, ids: DataFrame, lowest: str | None, highest: str | None) -> DataFrame:
    """All rows whose event_id is in `ids`, whatever else they hold.

    `lowest` and `highest` bound the ids. They reach the Parquet scan, where they skip row groups if
    ids grow with time, and are harmless if not.
    """
    wanted = ids.select(F.col("event_id").alias("_wanted"))
    within = rows.filter(_in_bounds(lowest, highest))
    return within.join(wanted, F.col("event_id").eqNullSafe(F.col("_wanted")), "left_semi")


def _in_bounds(lowest: str | None, highest: str | None) -> Column:
    nulls = F.col("event_id").isNull()
    return nulls if lowest is None else nulls | F.col("event_id").between(lowest, highest)


def _key() -> dict[str, Column]:
    """The id of an event as a key that is never null, so that a join and a window on it need one shuffle."""
    return {"_id": F.coalesce("event_id", F.lit("")), "_has_id": F.col("event_id").isNotNull()}


def latest_copies_of(rows: DataFrame, ids: DataFrame, lowest: str | None, highest: str | None) -> DataFrame:
    """The latest copy of each event in `ids`, which holds each id once; bounds as for `copies_of`.

    A semi-join would be moved below what makes `rows` narrow, and shuffle whole payloads. If the ids are too many
    for a broadcast, rows are shuffled for the join, and lie right for the window.
    """
    key = _key()
    keyed = rows.filter(_in_bounds(lowest, highest)).withColumns(key).drop("event_id")
    wanted = ids.select(*[column.alias(name) for name, column in key.items()])
    found = latest_copies(keyed.join(wanted, list(key)), by=tuple(key))
    return found.withColumn("event_id", F.when(F.col("_has_id"), F.col("_id"))).drop(*key)
