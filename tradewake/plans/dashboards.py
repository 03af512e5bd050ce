"""The queries behind the two dashboards: reconciliation tiles and time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions.money import cents


def reconciliation_tiles(recon: DataFrame) -> DataFrame:
    """All four tiles in one pass over the mart."""
    def total(column: str, only_settled: bool = False) -> Column:
        value = cents(column)
        return F.sum(F.when(F.col("is_settled"), value) if only_settled else value) \
            .cast("double")

    return recon.agg(
        total("booked_usd").alias("booked"),
        total("net_received_usd", only_settled=True).alias("settled"),
        total("fees_usd", only_settled=True).alias("fees"),
        total("gap_usd").alias("residual"))


def gap_split(recon: DataFrame) -> DataFrame:
    """The residual in its two parts: currency drift of settled orders, cash not collected."""
    gap = cents("gap_usd")
    return recon.groupBy("source").agg(
        F.sum(F.when(F.col("is_settled"), gap).otherwise(0)).cast("double").alias("fx_drift_usd"),
        F.sum(F.when(~F.col("is_settled"), gap).otherwise(0)).cast("double")
        .alias("uncollected_usd"),
        F.count_if("is_settled").alias("settled_orders"),
        F.count_if(~F.col("is_settled")).alias("uncollected_orders"))


def daily_series(rollup: DataFrame, measure: str) -> DataFrame:
    """Chart series of one measure of the daily rollup, in time order."""
    return rollup.select(F.col("order_date").cast("timestamp").alias("time"),
                         F.col("channel_name").alias("metric"),
                         F.col(measure).alias("value")).orderBy("time", "metric")


def live_tiles(live: DataFrame, as_of: Column) -> DataFrame:
    """Orders and units of the 15 minutes up to ``as_of`` (the dashboard passes now())."""
    recent = F.col("window_start") > as_of - F.expr("interval 15 minutes")
    return live.filter(recent).agg(F.sum("orders").alias("orders"), F.sum("units").alias("units"))


def live_series(live: DataFrame, measure: str) -> DataFrame:
    return live.select(F.col("window_start").alias("time"), F.col("channel").alias("metric"),
                       F.col(measure).alias("value")).orderBy("time", "metric")
