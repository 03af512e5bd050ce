"""Message sources: a Kafka topic, or a folder of message files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewake.schemas import MESSAGE


def from_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Unbounded read of a topic from its earliest offset.

    Needs Spark's Kafka connector on the class path (``spark.jars.packages``). Options such as
    ``maxOffsetsPerTrigger`` or ``minPartitions`` are passed on.
    """
    reader = spark.readStream.format("kafka") \
        .option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topic) \
        .option("startingOffsets", "earliest")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


def from_files(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Unbounded read of Parquet files with the message columns, new files as they appear."""
    reader = spark.readStream.schema(MESSAGE)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.parquet(folder)
