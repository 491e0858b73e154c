"""Seed files: CSV with a header, declared types, and JSON quoted with doubled quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import RAW_EVENTS


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV of raw events. Timestamps carry a zone, and are stored in UTC."""
    zoned = T.StructType(
        [
            T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
            for f in RAW_EVENTS.fields
        ]
    )
    rows = spark.read.schema(zoned).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in RAW_EVENTS.fields])
