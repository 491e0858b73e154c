"""Row keys and partition numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_md5(column: str | Column) -> Column:
    """MD5 of a text as 32 hex digits."""
    return F.md5(column)


def version_key(entity: str, valid_from: str) -> Column:
    """Key of one version: MD5 of the entity name followed by the timestamp as text.

    A null timestamp adds nothing to the text.
    """
    return hex_md5(F.concat(F.col(entity), F.coalesce(F.col(valid_from).cast("string"), F.lit(""))))


def bucket_of(entity: str | Column, buckets: int) -> Column:
    """Stable bucket number of an entity."""
    return F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")
