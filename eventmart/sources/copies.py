"""The index of copies: which loads and days hold copies of an event, or events of an entity.

Every load adds narrow rows in two orders: by a bucket of the event's id, with all that copies are ranked and
counted on, and by a bucket of the entity and the month of the event. An update asks for the buckets of the few
ids and entities it is about, and opens nothing else of the index; of bronze, only the folders the index names.
"""

from __future__ import annotations

import json
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.keys import bucket_of
from eventmart.operators.dedup import RANKING, copies_of
from eventmart.schemas import RAW_EVENTS
from eventmart.sources import files
from eventmart.sources.layout import Layout
from eventmart.sources.staging import stage

_BY_ID, _BY_ENTITY = "id", "entity"
_COLUMNS = ["event_id", *RANKING, "ingested_date"]
_PARTITION = ["kind", "bucket", "month", "load"]
_SCHEMA = T.StructType(
    [
        *[RAW_EVENTS[c] for c in ("event_id", *RANKING)],
        T.StructField("ingested_date", T.DateType()),
        T.StructField("kind", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("load", T.StringType()),
    ]
)


def _month(time: str) -> Column:
    return F.year(time) * 100 + F.month(time)


def _buckets(spark: SparkSession, layout: Layout) -> int:
    """The number of buckets of the index, noted with the first load."""
    path = f"{layout.copies}-buckets.json"
    if not files.exists(spark, path):
        files.write_text(spark, path, json.dumps(layout.copy_buckets))
    return json.loads(files.read_text(spark, path))


# -- writing


def add(rows: DataFrame, layout: Layout, load: str) -> None:
    """Index the rows of a load, in place of an earlier try."""
    spark = rows.sparkSession
    buckets = _buckets(spark, layout)
    kept = [F.col(c) for c in _COLUMNS]
    by_id = F.struct(*kept, F.lit(_BY_ID).alias("kind"), bucket_of("event_id", buckets).alias("bucket"), F.lit(0).alias("month"))
    needed = ("event_id", "repo_name", "event_created_at")
    by_entity = F.struct(
        *[F.col(c) if c in needed else F.lit(None).cast(_SCHEMA[c].dataType).alias(c) for c in _COLUMNS],
        F.lit(_BY_ENTITY).alias("kind"), bucket_of("repo_name", buckets).alias("bucket"), _month("event_created_at").alias("month"),
    )
    timed = F.col("repo_name").isNotNull() & F.col("event_created_at").isNotNull()
    both = rows.select(F.explode(F.when(timed, F.array(by_id, by_entity)).otherwise(F.array(by_id))).alias("r")).select("r.*")
    (
        both.hint("rebalance", "kind", "bucket", "month")
        .withColumn("load", F.lit(load))
        .sortWithinPartitions("kind", "bucket", "month", "event_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PARTITION)
        .parquet(layout.copies)
    )


def remove(spark: SparkSession, layout: Layout, load: str) -> None:
    """Forget a load, whose rows are in another one."""
    for kind in files.directories_in(spark, layout.copies):
        for bucket in files.directories_in(spark, f"{layout.copies}/{kind}"):
            for month in files.directories_in(spark, f"{layout.copies}/{kind}/{bucket}"):
                files.delete(spark, f"{layout.copies}/{kind}/{bucket}/{month}/load={load}")


# -- reading


def _read(spark: SparkSession, layout: Layout, folders: list[str]) -> DataFrame:
    """The rows in some folders of the index; no other one is listed."""
    if not folders:
        return spark.createDataFrame([], _SCHEMA)
    paths = [f"{layout.copies}/{folder}" for folder in folders]
    return spark.read.schema(_SCHEMA).option("basePath", layout.copies).parquet(*paths)


def find(rows: DataFrame, layout: Layout) -> DataFrame:
    """All copies of the events whose ids `rows` has, with the day and load each is in."""
    return find_ids(*ids_of(rows, layout), layout)


def ids_of(rows: DataFrame, layout: Layout) -> tuple[DataFrame, dict[str, Any]]:
    """The ids `rows` has, each once and staged, with the lowest and highest and their buckets."""
    ids = rows.select("event_id").distinct().withColumn("bucket", bucket_of("event_id", _buckets(rows.sparkSession, layout)))
    # One number for each bucket at most.
    return stage(ids, "ids", low=F.min("event_id"), high=F.max("event_id"), buckets=F.collect_set("bucket"))


def find_ids(ids: DataFrame, seen: dict[str, Any], layout: Layout) -> DataFrame:
    """All copies of the events in what `ids_of` gave."""
    spark = ids.sparkSession
    wanted = [f"kind={_BY_ID}/bucket={b}" for b in sorted(seen["buckets"])]
    folders = [f for f in wanted if files.exists(spark, f"{layout.copies}/{f}")]
    return copies_of(_read(spark, layout, folders), ids, seen["low"], seen["high"]).drop("kind", "bucket", "month")


def bucket(entity: str, spark: SparkSession, layout: Layout) -> Column:
    """The bucket of the index that an entity's events are in."""
    return bucket_of(entity, _buckets(spark, layout))


def since(touched: DataFrame, layout: Layout, earliest: datetime, buckets: list[int]) -> DataFrame:
    """The ids of events that any copy says to be one of a touched entity, at or after its time `since`.

    `touched` has one row for each entity; `earliest` is the first of their times, `buckets` theirs in the index.
    """
    spark = touched.sparkSession
    folders = []
    for number in sorted(buckets):
        folder = f"kind={_BY_ENTITY}/bucket={number}"
        months = files.directories_in(spark, f"{layout.copies}/{folder}")
        folders += [f"{folder}/{m}" for m in months if int(m.removeprefix("month=")) >= earliest.year * 100 + earliest.month]
    events = _read(spark, layout, folders).filter(F.col("event_created_at") >= F.lit(earliest))
    wanted = touched.select(F.col("repo_name").alias("_name"), "since")
    same = (F.col("repo_name") == F.col("_name")) & (F.col("event_created_at") >= F.col("since"))
    return events.join(wanted, same, "left_semi").select("event_id")
