from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a table of documents from (id, text) pairs or longer rows."""

    def make(rows, parts=3):
        full = [(*row, *(None, None)[len(row) - 2 :]) if len(row) < 4 else row for row in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def small(spark, sf_dir):
    """(id, text) of the small table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]
