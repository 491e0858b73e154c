"""Session settings the results depend on, and a builder that applies them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Needed for right results, whoever built the session.
RUNTIME_CONF = {
    # Stored timestamps are TIMESTAMP_NTZ in UTC; casts go through the session zone.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object with a repeated key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Streaming dedup state is kept off-heap, on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "eventmart", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, pass your own to `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in (RUNTIME_CONF | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share, for staged tables.

    The folder is `spark.checkpoint.dir`. A machine-local folder is used only where that is unset
    and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "eventmart")
    return f"{base.rstrip('/')}/eventmart-{name}-{uuid.uuid4().hex}"
