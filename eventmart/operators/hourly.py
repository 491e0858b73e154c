"""Hourly fact: counts and exact distinct counts per hour and event type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.time import trunc_hour


def hourly_fact(facts: DataFrame) -> DataFrame:
    """Aggregate silver events, as from `event_facts`.

    Distinct counts are shuffled by (hour, type, value) after a partial aggregate, so a hot hour or
    type spreads over its values.
    """
    return facts.groupBy(trunc_hour("event_created_at").alias("event_hour"), "event_type").agg(
        F.count("*").alias("event_count"),
        F.countDistinct("actor_login").alias("unique_actors"),
        F.countDistinct("repo_name").alias("unique_repos"),
    )


# How often an hour and type name something: events as such, an actor, or an entity.
_EVENT, _ACTOR, _ENTITY = "event", "actor", "entity"
REFERENCES = T.StructType(
    [
        T.StructField("event_hour", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def references(facts: DataFrame, times: Column) -> DataFrame:
    """Reference counts of silver events that each count some times; those that come to nothing are left out.

    They can be added up, which the fact itself cannot.
    """

    def named(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    all_ = F.array(named(_EVENT, F.lit(None)), named(_ACTOR, F.col("actor_login")), named(_ENTITY, F.col("repo_name")))
    # An event without an actor or an entity adds nothing to their count.
    found = F.filter(all_, lambda r: (r["kind"] == _EVENT) | r["value"].isNotNull())
    rows = facts.select(
        trunc_hour("event_created_at").alias("event_hour"), "event_type", F.explode(found).alias("r"), times.alias("_times")
    )
    counts = rows.groupBy("event_hour", "event_type", "r.kind", "r.value").agg(F.sum("_times").cast("long").alias("n"))
    return counts.filter("n <> 0")


def fact_of(counts: DataFrame) -> DataFrame:
    """The fact's rows from reference counts."""

    def number(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & (F.col("n") > 0))

    events = F.coalesce(F.sum(F.when(F.col("kind") == _EVENT, F.col("n"))), F.lit(0).cast("long"))
    return (
        counts.groupBy("event_hour", "event_type")
        .agg(events.alias("event_count"), number(_ACTOR).alias("unique_actors"), number(_ENTITY).alias("unique_repos"))
        .filter("event_count > 0")
    )
