"""Messages to bronze, and on to gold, with Structured Streaming.

Each micro-batch becomes one bronze load named after the query and the batch, so a batch that is run
again after a crash replaces its load. Offsets are committed, in the checkpoint, after the batch
function returns.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventmart.operators.decode import decode
from eventmart.sources import files, progress
from eventmart.sources.bronze import create_tables, write_batch
from eventmart.sources.layout import Layout
from eventmart.sources.messages import CONTINUOUS_INTERVAL, Source
from eventmart.sources.staging import observed

STREAM = "ingest"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of a streaming query: it stays over restarts, and is new with a new checkpoint."""
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


def load_batch(
    spark: SparkSession,
    layout: Layout,
    messages: DataFrame,
    load: str,
    batch_id: int = 0,
    ingested_at: Column | None = None,
) -> int:
    """Decode messages and write them as one load, bad ones to the dead letter table, in one pass.

    Returns the number of bronze rows.
    """
    decoded = decode(messages, ingested_at).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    seen, is_good = Observation(), F.col("reason").isNull()
    counts = F.count_if(is_good).alias("rows"), F.count_if(~is_good).alias("dead")
    write_batch(decoded.observe(seen, *counts), layout, load)
    found = observed(seen)
    rows, dead = found.get("rows") or 0, found.get("dead") or 0
    progress.loaded(spark, layout, load, rows, dead)
    return rows


def _writer(
    spark: SparkSession,
    source: Source,
    layout: Layout,
    ingested_at: Column | None,
    after_load: Callable[[str], None] | None,
    loaded: list[int],
) -> DataStreamWriter:
    create_tables(spark, layout)
    checkpoint = layout.checkpoint(STREAM)
    query: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not query:
            query.append(query_id(spark, checkpoint))
        load = f"{query[0]}-{batch_id:010d}"
        loaded.append(load_batch(spark, layout, batch, load, batch_id, ingested_at))
        if after_load is not None:
            after_load(load)

    stream = source.read_stream(spark)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def drain(
    spark: SparkSession,
    source: Source,
    layout: Layout,
    *,
    ingested_at: Column | None = None,
    after_load: Callable[[str], None] | None = None,
) -> int:
    """Load all there is, in batches as large as the source allows, and stop.

    Returns the number of bronze rows.
    """
    loaded: list[int] = []
    query = _writer(spark, source, layout, ingested_at, after_load, loaded).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(loaded)


def run_continuously(
    spark: SparkSession,
    source: Source,
    layout: Layout,
    *,
    interval: str = CONTINUOUS_INTERVAL,
    after_load: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """Load as messages come, until the query is stopped."""
    return _writer(spark, source, layout, None, after_load, []).trigger(processingTime=interval).start()
