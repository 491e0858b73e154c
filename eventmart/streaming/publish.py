"""Publish events as keyed messages, each id once: as a stream, or as a job that drains the source."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.keys import bucket_of
from eventmart.operators.publish import as_messages, keyed_events, new_events
from eventmart.session import configure
from eventmart.sources import files, progress
from eventmart.sources.layout import Layout
from eventmart.sources.messages import Sink, Source
from eventmart.sources.staging import dropped_after, stage
from eventmart.streaming.ingest import query_id

STREAM = "publish"


def unseen_messages(records: DataFrame, remember: str = "1 hour") -> DataFrame:
    """Messages for records whose id did not arrive within `remember`.

    What has been seen is kept as streaming state, and dropped as time passes: memory is bounded by
    time. The watermark is on arrival, so no record is ever late, whatever time it bears.
    """
    arrived = keyed_events(records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember))
    return as_messages(arrived.dropDuplicatesWithinWatermark(["event_id"]))


def _buckets(spark: SparkSession, layout: Layout) -> int:
    """The number of parts published ids are kept in, noted with the first batch."""
    path = f"{layout.published}-buckets.json"
    if not files.exists(spark, path):
        files.write_text(spark, path, json.dumps(layout.published_buckets))
    return json.loads(files.read_text(spark, path))


_PUBLISHED = "event_id string, bucket int, batch string"


def published_ids(spark: SparkSession, layout: Layout, buckets: list[int] | None = None) -> DataFrame:
    """Ids that earlier jobs have published: all, or those in some buckets, which are the only ones opened."""
    if buckets is None:
        files.make_directory(spark, layout.published)
        return spark.read.schema(_PUBLISHED).parquet(layout.published)
    paths = [p for p in (f"{layout.published}/bucket={b}" for b in buckets) if files.exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], _PUBLISHED)
    return spark.read.schema(_PUBLISHED).option("basePath", layout.published).parquet(*paths)


def _new_in_batch(batch: DataFrame, layout: Layout, label: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """The first message of each id in a batch, the ids among them that no other batch has published, and their buckets."""
    spark = batch.sparkSession
    first = new_events(keyed_events(batch), F.struct("timestamp", "partition", "offset"))
    first, seen = stage(
        first.withColumn("bucket", bucket_of("event_id", _buckets(spark, layout))),
        "arrived", low=F.min("event_id"), high=F.max("event_id"), buckets=F.collect_set("bucket"),
    )
    ids = first.select("event_id", "bucket")
    # One number for each bucket at most.
    earlier = published_ids(spark, layout, sorted(seen["buckets"]))
    # Files are sorted by id: the bounds skip row groups where ids grow with time.
    earlier = earlier.filter(F.col("event_id").between(seen["low"], seen["high"]) & (F.col("batch") != label))
    return first, ids.join(earlier.select("event_id"), "event_id", "left_anti"), sorted(seen["buckets"])


def publish(spark: SparkSession, source: Source, sink: Sink, layout: Layout) -> int:
    """Publish what the source has and no job has published, and return how many events that were.

    Each batch's ids are written below its name before its messages are sent, and those of a batch that
    is run again are not counted as published: an event may be sent twice after a crash, never not at
    all.
    """
    configure(spark)
    checkpoint = layout.checkpoint(STREAM)
    name: list[str] = []
    sent: list[int] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not name:
            name.append(query_id(spark, checkpoint))
        label = f"{name[0]}-{batch_id:010d}"
        with dropped_after(spark):
            first, ids, buckets = _new_in_batch(batch, layout, label)
            (
                ids.withColumn("batch", F.lit(label))
                .hint("rebalance", "bucket")
                .sortWithinPartitions("bucket", "event_id")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("bucket", "batch")
                .parquet(layout.published)
            )
            fresh = published_ids(spark, layout, buckets).filter(F.col("batch") == label).select("event_id")
            n = fresh.count()
            if n:
                sink.write(as_messages(first.join(fresh, "event_id", "left_semi")))
        progress.published(spark, layout, label, n)
        sent.append(n)

    stream = source.read_stream(spark).writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    stream.trigger(availableNow=True).start().awaitTermination()
    return sum(sent)


# The name of what is put together begins with this, which no query's does.
_COMPACTED = "all-"


def compact_published(spark: SparkSession, layout: Layout) -> None:
    """Put the batches of each bucket together as one, say once a day, but the last of each query.

    That one may be run again. Should this die between writing and deleting, ids are there twice, which changes
    nothing.
    """
    rows = published_ids(spark, layout)
    last: dict[str, str] = {}
    batches = sorted(r["batch"] for r in rows.select("batch").distinct().collect())
    for batch in batches:
        if not batch.startswith(_COMPACTED):
            last[batch.rsplit("-", 1)[0]] = batch
    old = [b for b in batches if b not in last.values()]
    if len(old) < 2:
        return
    (
        rows.filter(F.col("batch").isin(old))
        .select("event_id", "bucket", F.lit(f"{_COMPACTED}{uuid.uuid4().hex}").alias("batch"))
        .distinct()
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "event_id")
        .write.mode("append")
        .partitionBy("bucket", "batch")
        .parquet(layout.published)
    )
    for bucket in files.directories_in(spark, layout.published):
        for batch in old:
            files.delete(spark, f"{layout.published}/{bucket}/batch={batch}")
