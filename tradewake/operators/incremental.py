"""Incremental loads: select the delta of a source, replace its keys in the target.

Facts are day tables, whose ``replace_keys`` opens only files that may hold one of the delta's
keys. ``upsert_in_table`` serves tables in folders whose name is a function of the key.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delta_strict(source: DataFrame, watermark: str | None, column: str) -> DataFrame:
    """Source rows beyond the target's high watermark, a date as text.

    Rows that arrive late for a loaded day are skipped, and an empty target (no watermark)
    yields nothing: first loads are full loads. Use ``delta_lookback`` to heal late rows.
    """
    return source.filter(F.col(column) > F.lit(watermark).cast("date"))


def day_before(day: str | None, days: int) -> str | None:
    """The day so many days earlier, as text."""
    return None if day is None else date.fromordinal(
        max(date.fromisoformat(day).toordinal() - days, 1)).isoformat()


def delta_lookback(source: DataFrame, watermark: str | None, column: str, days: int) -> DataFrame:
    """Source rows from ``days`` before the high watermark on; everything if there is none."""
    if watermark is None:
        return source.filter(F.col(column).isNotNull())
    return source.filter(F.col(column) >= F.lit(day_before(watermark, days)).cast("date"))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows that have a key of the changes, plus these; NULL equals NULL."""
    changed = changes.select(*[F.col(k).alias(f"changed_{k}") for k in keys])
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"changed_{k}")) for k in keys])
    return target.join(changed, same, "left_anti").unionByName(changes)


def is_one_of(column: str, values: list) -> Column:
    """Membership that counts NULL as a value; never NULL itself."""
    present = [F.col(column).isin([v for v in values if v is not None])] \
        if any(v is not None for v in values) else []
    missing = [F.col(column).isNull()] if None in values else []
    member = reduce(lambda a, b: a | b, present + missing, F.lit(False))
    return F.coalesce(member, F.lit(False))


def write_partitioned(frame: DataFrame, path: str, column: str) -> None:
    """Write (or replace) just the partitions present in ``frame``.

    Rebalancing gathers a partition's rows so that small days give one file, packs small days
    together, and splits a day that outgrows the advisory size over several tasks and files.
    """
    frame.hint("rebalance", column).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_full(frame: DataFrame, path: str) -> None:
    """Replace a whole table that is not kept by day."""
    frame.write.mode("overwrite").parquet(path)


def _partition_values(frame: DataFrame, column: str) -> list:
    """Distinct partition values: at most one per folder of the table, never per row."""
    return [row[0] for row in frame.select(column).distinct().collect()]


def upsert_in_table(changes: DataFrame, path: str, keys: list[str], column: str) -> None:
    """Upsert into a table whose partition column is a function of the key.

    Then only the partitions named in ``changes`` can hold an old version of a row.
    """
    spark = changes.sparkSession
    target = spark.read.schema(changes.schema).parquet(path)
    touched = _partition_values(changes, column)
    merged = upsert(target.filter(is_one_of(column, touched)), changes, keys)
    write_partitioned(merged.select(*changes.columns), path, column)
