"""The driver's `events` table seen as raw events and as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Messages of these kinds, by event_id modulo 50, are odd on purpose.
NOT_JSON, NUMBER_ID, NO_ACTOR, SCALAR_ACTOR, NOT_OBJECT, FORGED_END, NO_DATE = range(7)


def driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _event_json(actor: Column, id_: Column, created_at: Column | None = None) -> Column:
    """The event as JSON text, keys in order, nulls kept."""
    if created_at is None:
        created_at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    k = F.get_json_object("props", "$.k").cast("int")
    event = F.struct(
        actor.alias("actor"),
        created_at.alias("created_at"),
        id_.alias("id"),
        F.struct(
            F.col("event_type").alias("action"),
            F.lit(None).cast("string").alias("ref"),
            F.struct(
                F.concat(F.lit("d"), (k % 2).cast("string")).alias("description"),
                F.when(F.col("event_type") != "error", F.col("event_type")).alias("language"),
                (k % 2).cast("string").alias("stargazers_count"),
            ).alias("repository"),
        ).alias("payload"),
        F.lit(True).alias("public"),
        F.struct(F.col("user_id").cast("string").alias("id"), _repo().alias("name")).alias("repo"),
        F.col("event_type").alias("type"),
    )
    return F.to_json(event, {"ignoreNullFields": "false"})


def _repo() -> Column:
    return F.concat(F.lit("repo/"), F.col("user_id").cast("string"))


def _actor() -> Column:
    return F.concat(F.lit("actor/"), (F.col("event_id") % 211).cast("string"))


def raw_events(spark: SparkSession, sf_dir: str, skewed: bool = False) -> DataFrame:
    """Raw events, every tenth delivered twice.

    `skewed` moves a third of all events to one repo.
    """
    events = driver_events(spark, sf_dir)
    if skewed:
        events = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    id_ = F.col("event_id").cast("string")
    rows = events.select(
        id_.alias("event_id"),
        "event_type",
        _actor().alias("actor_login"),
        _repo().alias("repo_name"),
        F.col("ts").alias("event_created_at"),
        # Second deliveries arrive a minute later.
        F.explode(
            F.when(F.col("event_id") % 10 == 0, F.array(F.lit(5), F.lit(65))).otherwise(F.array(F.lit(5)))
        ).alias("_delay"),
        _event_json(F.struct(_actor().alias("login")), id_).alias("payload"),
    )
    ingested_at = F.col("event_created_at") + F.make_interval(secs=F.col("_delay"))
    return rows.withColumn("ingested_at", ingested_at).select(
        "event_id", "event_type", "actor_login", "repo_name", "event_created_at", "ingested_at", "payload"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as messages: one in ten delivered twice, seven in fifty odd in some way."""
    events = driver_events(spark, sf_dir)
    id_ = F.col("event_id").cast("string")
    kind = F.col("event_id") % 50
    login = F.struct(_actor().alias("login"))
    value = (
        F.when(kind == NOT_JSON, F.lit("{not-json"))
        .when(kind == NUMBER_ID, _event_json(login, F.col("event_id")))
        .when(kind == NO_ACTOR, _event_json(F.lit(None).cast("string"), id_))
        .when(kind == SCALAR_ACTOR, _event_json(F.lit("someone"), id_))
        .when(kind == NOT_OBJECT, F.lit("[1]"))
        .when(kind == FORGED_END, F.concat(_event_json(login, id_), F.lit(',{"end-of-text":true}]garbage')))
        .when(kind == NO_DATE, _event_json(login, id_, F.lit("12:30")))
        .otherwise(_event_json(login, id_))
    )
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.select("event_id", "ts", id_.alias("_id"), value.alias("_value"), F.explode(copies).alias("_copy"))
    return rows.select(
        F.col("_id").cast("binary").alias("key"),
        F.col("_value").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("event_id") * 2 + F.col("_copy")).alias("offset"),
        (F.col("ts") + F.make_interval(secs=F.col("_copy") * 60)).cast("timestamp").alias("timestamp"),
    )
