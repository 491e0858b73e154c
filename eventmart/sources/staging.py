"""Staged tables: intermediate results written to the shared folder and read back.

They cut the lineage, survive lost executors, and give sizes and bounds for free with the write.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from eventmart.session import scratch_dir
from eventmart.sources import files

# Folders staged since the innermost `dropped_after` began.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside, when it is done: for jobs that keep no frame on it."""
    outer, paths = _STAGED.get(), []
    _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.set(outer)
        for path in paths:
            files.delete(spark, path)


def observed(observation: Observation) -> dict[str, Any]:
    """What was observed while writing; nothing where Spark found out that there is nothing to write."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def stage(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, Any]]:
    """Write `rows`, and return them as read back, with the metrics observed while writing."""
    spark = rows.sparkSession
    path = scratch_dir(spark, name)
    if (staged := _STAGED.get()) is not None:
        staged.append(path)
    seen: dict[str, Any] = dict.fromkeys(metrics)
    named = [c.alias(k) for k, c in metrics.items()]
    if not named:
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path), seen
    observation = Observation()
    rows.observe(observation, *named).write.parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    return staged, seen | (observed(observation) or staged.agg(*named).first().asDict())
