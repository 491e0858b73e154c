"""Serving queries over silver events and the gold tables.

Sort keys end in a unique column, so that equal counts come out in one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overall(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("total_events"),
        F.countDistinct("actor_login").alias("unique_actors"),
        F.countDistinct("repo_name").alias("unique_repos"),
        F.countDistinct("event_type").alias("event_types"),
    )


def event_types(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy("event_type").agg(F.count("*").alias("events"))
    return counts.orderBy(F.desc("events"), F.asc_nulls_last("event_type"))


def top_repos(silver: DataFrame) -> DataFrame:
    """All repos, busiest first."""
    counts = silver.groupBy("repo_name").agg(
        F.count("*").alias("events"),
        F.countDistinct("actor_login").alias("unique_actors"),
        F.countDistinct("event_type").alias("event_types"),
    )
    return counts.orderBy(F.desc("events"), F.asc_nulls_last("repo_name"))


def hourly_series(fact: DataFrame) -> DataFrame:
    return fact.select("event_hour", "event_type", "event_count").orderBy(
        F.asc_nulls_last("event_hour"), F.asc_nulls_last("event_type")
    )


def entities_current(dimension: DataFrame) -> DataFrame:
    """The version of each entity now in force, most stars first."""
    return (
        dimension.filter("is_current")
        .select(
            "repo_name",
            "repo_language",
            "repo_description",
            "stargazers_count",
            F.col("valid_from").alias("first_seen"),
        )
        .orderBy(F.desc_nulls_last("stargazers_count"), "repo_name")
    )


def entity_history(dimension: DataFrame, entity: str) -> DataFrame:
    """All versions of one entity, oldest first."""
    return (
        dimension.filter(F.col("repo_name") == entity)
        .select(
            "valid_from",
            F.col("repo_language").alias("language"),
            F.col("repo_description").alias("description"),
            F.col("stargazers_count").alias("stars"),
            F.when(F.col("is_current"), "current").otherwise("").alias("flag"),
        )
        .orderBy("valid_from")
    )


def versions_per_repo(dimension: DataFrame) -> DataFrame:
    counts = dimension.groupBy("repo_name").agg(F.count("*").alias("version_count"))
    return counts.orderBy(F.desc("version_count"), "repo_name")
