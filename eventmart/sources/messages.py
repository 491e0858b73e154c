"""Message sources and sinks: Kafka on a cluster, files anywhere.

Either gives the columns of Spark's Kafka source. The Kafka connector is a package the cluster has
to provide; here it is only named in options.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from eventmart.schemas import MESSAGE

# The longest wait between loads of the continuous loader, its rows per load at a few
# events a second, and the producer's linger time.
CONTINUOUS_INTERVAL = "5 seconds"
CONTINUOUS_BATCH_ROWS = 200
LINGER_MS = 50


@dataclass(frozen=True)
class Source:
    """A message source: format, options and, for files, the path."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None

    def read_stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format(self.format).options(**self.options)
        if self.format != "kafka":
            reader = reader.schema(MESSAGE)
        return reader.load(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The messages there are now, as a batch."""
        reader = spark.read.format(self.format).options(**self.options)
        if self.format != "kafka":
            reader = reader.schema(MESSAGE)
        return reader.load(self.path)


def kafka_source(bootstrap: str, topic: str, batch_rows: int | None = None) -> Source:
    """Subscribe from the earliest offset; progress is kept in the stream's checkpoint.

    `batch_rows` caps a micro-batch, not the whole run. Each batch costs the same few jobs, so at scale
    leave it out, or set it to what the cluster takes in a minute or so.
    """
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": "earliest"}
    if batch_rows is not None:
        options["maxOffsetsPerTrigger"] = str(batch_rows)
    return Source("kafka", options)


def file_source(path: str, files_per_batch: int | None = None, format: str = "parquet") -> Source:
    """Files that hold messages in the same columns."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}
    return Source(format, options, path)


@dataclass(frozen=True)
class Sink:
    """A message sink for rows of (key, value)."""

    format: str
    options: dict[str, str] = field(default_factory=dict)

    def write(self, messages: DataFrame) -> None:
        messages.write.format(self.format).options(**self.options).mode("append").save()

    def write_stream(self, messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        writer = messages.writeStream.format(self.format).options(**self.options).outputMode("append")
        return writer.option("checkpointLocation", checkpoint)


def kafka_sink(bootstrap: str, topic: str) -> Sink:
    return Sink("kafka", {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.linger.ms": str(LINGER_MS)})


def file_sink(path: str, format: str = "parquet") -> Sink:
    return Sink(format, {"path": path})
