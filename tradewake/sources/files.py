"""The few file-system calls Spark's reader and writer do not cover (Hadoop FS, any store)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def has_data(spark: SparkSession, path: str) -> bool:
    """True if the folder holds at least one data file or partition folder."""
    return any(not name.startswith(("_", ".")) for name in names(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def drop_partition(spark: SparkSession, table_path: str, column: str, value: object) -> None:
    """Remove one partition folder (of a date or a plain word) of a table."""
    delete(spark, f"{table_path}/{column}={NO_VALUE if value is None else value}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under its name at once: no reader sees half of it."""
    fs, hadoop_path = _resolve(spark, path)
    _, draft = _resolve(spark, f"{path}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(hadoop_path, False)
    if not fs.rename(draft, hadoop_path):
        raise OSError(f"could not write {path}")


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole, unless there is one of its name: then False.

    The check is as exact as the store's rename: HDFS and its like refuse to replace a file.
    """
    fs, hadoop_path = _resolve(spark, path)
    _, draft = _resolve(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.exists(hadoop_path) and fs.rename(draft, hadoop_path):
        return True
    fs.delete(draft, False)
    return False


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if it is missing."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
