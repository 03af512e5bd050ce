"""Session settings and the shared folder that jobs may write scratch tables to."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tradewake.sources import files

# Runtime settings every job relies on. Shuffle width is left to the cluster and AQE.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

_scratch: list[str] = []


def build_session(app_name: str = "tradewake", master: str | None = None,
                  **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or else ``setCheckpointDir()``.

    It must be given. The driver cannot know which of its folders executors share, so there is
    no default.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return root.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and continue from there.

    Used where several jobs need the same small result of a long lineage: it is computed once,
    and a lost executor costs a re-read instead of a recomputation.
    """
    path = run_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of independent steps, whose jobs run at once: cores that one leaves idle serve another.

    All come to their end; then the first one, in their order, that failed raises.
    """
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in begun]


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared one, remembered as scratch."""
    path = f"{shared_folder(spark)}/tradewake/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has made. Frames read from them end with it."""
    cleared = len(_scratch)
    while _scratch:
        files.delete(spark, _scratch.pop())
    return cleared
