"""The few file-system calls Spark's readers and writers do not cover.

They go through Hadoop's file system, so any path Spark can use will do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _resolve(spark, path)
    return files.exists(target)


def make_directory(spark: SparkSession, path: str) -> None:
    files, target = _resolve(spark, path)
    files.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a directory of a table; nothing happens if it is not there."""
    files, target = _resolve(spark, path)
    files.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a directory, sorted; none if it is not there."""
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target) if status.isFile())


def directories_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories in a directory, sorted; none if it is not there."""
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target) if status.isDirectory())


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or a directory another name, which must not be in use, in the same file system."""
    files, target = _resolve(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(_resolve(spark, path)[1], target):
        raise OSError(f"cannot move {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing one that is there."""
    files, target = _resolve(spark, path)
    stream = files.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _resolve(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
