"""Stored product versions.

The table is partitioned by ``closed_at``: one folder of open versions, one folder per snapshot
that closed versions. A snapshot therefore reads and rewrites the open folder and writes its own
closing folder; older history is never touched, however long it gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.operators.incremental import write_partitioned
from tradewake.operators.scd2 import VERSION_COLUMNS, step_versions
from tradewake.session import stored
from tradewake.sources import files

OPEN = "open"
SCHEMA = ("product_id bigint, model_name string, brand string, grade string, unit_cost double, "
          "list_price double, valid_from timestamp, valid_to timestamp")


def _folder_name(closed: Column) -> Column:
    return F.coalesce(F.date_format(closed, "yyyyMMdd'T'HHmmss.SSSSSS"), F.lit(OPEN))


def _table(spark: SparkSession, path: str) -> DataFrame:
    """The table with its declared columns, which an empty folder has too."""
    if not files.has_data(spark, path):
        return spark.createDataFrame([], f"{SCHEMA}, closed_at string")
    return spark.read.schema(f"{SCHEMA}, closed_at string").parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path).select(*VERSION_COLUMNS)


def take_snapshot(source: DataFrame, path: str, snapshot_ts: str) -> None:
    """Bring the version table up to ``source`` as of ``snapshot_ts`` (UTC text).

    A snapshot that was taken before is taken back first: what it closed is open again, what it
    opened is forgotten. So repeating one, with the same or a corrected source, or after it was
    interrupted, ends where a single right one ends. An empty source closes every product.
    """
    spark = source.sparkSession
    at = F.lit(snapshot_ts).cast("timestamp")
    closing = spark.range(1).select(_folder_name(at)).first()[0]
    table = _table(spark, path)
    still_open = table.filter(F.col("closed_at") == OPEN).select(*VERSION_COLUMNS)
    if not still_open.filter(F.col("valid_from") > at).isEmpty():
        raise ValueError(f"there are open versions newer than {snapshot_ts}")
    reopened = table.filter(F.col("closed_at") == closing).select(*VERSION_COLUMNS) \
        .withColumn("valid_to", F.lit(None).cast("timestamp"))
    before = still_open.filter(F.col("valid_from") < at).unionByName(reopened).distinct()
    after = stored(step_versions(before, source, at)
                   .withColumn("closed_at", _folder_name(F.col("valid_to"))), "versions")
    write_partitioned(after, path, "closed_at")
    filled = {row[0] for row in after.select("closed_at").distinct().collect()}  # two at most
    for folder in {OPEN, closing} - filled:
        files.drop_partition(spark, path, "closed_at", folder)
