"""Proof of exactly-once landing: the runs of offsets that every source partition has landed.

A partition that was landed once and whole is one run without repeats. A lost message ends a run and
begins another; one landed twice shows as a repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Offsets of one source partition that are looked at together.
OFFSETS = 1 << 20


def offset_runs(events: DataFrame, offsets: int = OFFSETS) -> DataFrame:
    """(kafka_partition, first_offset, last_offset, messages, repeats) of every run of offsets.

    ``messages`` counts distinct offsets, ``repeats`` further events with the same coordinates.
    Offsets are grouped by blocks, in which runs are found; the blocks' runs, a few rows each, are then
    joined where one ends right before another begins. So a group is never larger than a block,
    however long a partition is. Events without coordinates are not counted.
    """
    seen = events.filter("kafka_partition IS NOT NULL AND kafka_offset IS NOT NULL") \
        .groupBy("kafka_partition", "kafka_offset").agg(F.count("*").alias("n")) \
        .withColumn("block", F.floor(F.col("kafka_offset") / offsets))
    inside = Window.partitionBy("kafka_partition", "block").orderBy("kafka_offset")
    pieces = seen.withColumn("run", F.col("kafka_offset") - F.row_number().over(inside)) \
        .groupBy("kafka_partition", "block", "run").agg(
            F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"),
            F.count("*").alias("messages"), F.sum(F.col("n") - 1).alias("repeats"))
    along = Window.partitionBy("kafka_partition").orderBy("low")
    begins = F.coalesce(F.col("low") != F.lag("high").over(along) + 1, F.lit(True))
    return pieces.withColumn("begins", begins) \
        .withColumn("nth", F.sum(F.col("begins").cast("int")).over(along)) \
        .groupBy("kafka_partition", "nth").agg(
            F.min("low").alias("first_offset"), F.max("high").alias("last_offset"),
            F.sum("messages").alias("messages"), F.sum("repeats").alias("repeats")).drop("nth")
