"""Star schema and marts as DataFrame plans over the conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions.dates import iso_weekday
from tradewake.functions.keys import channel_key, product_version_key
from tradewake.functions.money import cents, share_pct
from tradewake.operators.lookups import Lookup
from tradewake.session import stored

# Display name and marketplace fee rate per channel, settleable states.
CHANNEL_FACTS = {"amazon": ("Amazon", 0.15), "backmarket": ("BackMarket", 0.12)}
SETTLEABLE = ("DELIVERED", "SHIPPED")
RETURNED = "RETURNED"


def dim_channel(sales: DataFrame) -> DataFrame:
    """Channels seen in sales; an unknown one keeps its own name and has no fee rate."""
    display, fee = F.col("channel"), F.lit(None).cast("double")
    for channel, (name, rate) in CHANNEL_FACTS.items():
        is_it = F.col("channel") == channel
        display = F.when(is_it, name).otherwise(display)
        fee = F.when(is_it, F.lit(rate)).otherwise(fee)
    return sales.select(F.col("source").alias("channel")).distinct().select(
        channel_key("channel").alias("channel_sk"), "channel",
        display.alias("channel_name"), fee.alias("fee_rate"))


def dim_date(sales: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last sale, with its parts."""
    span = sales.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    day = F.col("date_key")
    return span.select(F.explode(F.sequence("first", "last")).alias("date_key")).select(
        day,
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("long").alias("day_of_month"),
        iso_weekday(day).cast("long").alias("iso_day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (iso_weekday(day) >= 6).alias("is_weekend"))


def dim_product(versions: DataFrame) -> DataFrame:
    return versions.select(
        product_version_key("product_id", "valid_from").alias("product_sk"),
        "product_id", "model_name", "brand", "grade", "unit_cost", "list_price",
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def current_products(products: DataFrame) -> DataFrame:
    return products.filter("is_current").select("product_id", "product_sk")


def channel_keys(channels: DataFrame) -> DataFrame:
    return channels.select("channel", "channel_sk")


def fct_sales(sales: DataFrame, channels: Lookup, products: Lookup) -> DataFrame:
    """Order grain, with the key of the product version current at load time.

    ``unit_price`` stays in the channel's currency; only ``revenue_usd`` is converted.
    """
    keyed = channels.map(lambda d: d.withColumnRenamed("channel", "source")) \
        .left_join(sales, "source")
    keyed = products.left_join(keyed, "product_id")
    status = F.col("canonical_status")
    return keyed.select(
        "order_id", "order_date", "channel_sk", "product_sk", "source", "canonical_status",
        (status == RETURNED).alias("is_returned"),
        status.isin(*SETTLEABLE).alias("is_settleable"),
        "quantity", "unit_price", "revenue_usd")


def fct_settlement(settlements: DataFrame, channels: Lookup) -> DataFrame:
    """Remittance grain."""
    return channels.left_join(settlements, "channel").select(
        "settlement_id", "order_ref", "channel_sk", "channel", "payout_date",
        "gross_usd", "fees_usd", "net_usd")


def mart_reconciliation(sales: DataFrame, settlements: DataFrame) -> DataFrame:
    """Booked revenue against cash received, per fulfilled order.

    Remittances are summed to order grain first, so the join is one to one. Order ids should be
    unique, but a broken feed may repeat one (or none) for much of its rows, and the gate comes
    later. The sums are stored and never broadcast, so that both sides of the join come straight
    from a shuffle: then adaptive execution splits the partition of any such id, however many rows
    it has, and the driver gets none of the sums.
    """
    received = stored(settlements.filter(F.col("order_ref").isNotNull()).groupBy("order_ref").agg(
        F.sum(cents("net_usd")).alias("net"), F.sum(cents("fees_usd")).alias("fees")), "received")
    fulfilled = sales.filter("is_settleable").select(
        "order_id", "source", "order_date", "canonical_status", "revenue_usd")
    zero = F.lit(0).cast("decimal(28,2)")
    gap = cents("revenue_usd") - F.coalesce("net", zero) - F.coalesce("fees", zero)
    joined = fulfilled.join(received.hint("merge"), F.col("order_id") == F.col("order_ref"), "left")
    return joined.select(
        "order_id", "source", "order_date", "canonical_status",
        F.col("revenue_usd").alias("booked_usd"),
        F.col("net").cast("double").alias("net_received_usd"),
        F.col("fees").cast("double").alias("fees_usd"),
        F.col("order_ref").isNotNull().alias("is_settled"),
        gap.cast("double").alias("gap_usd"))


def agg_channel_daily(sales: DataFrame, channels: Lookup) -> DataFrame:
    """Daily channel rollup. ``booked_usd`` covers all statuses, cancelled orders included.

    Sales are summed by key first and named afterwards, so the dimension joins a few rows per
    day instead of every order. Two channels under one display name are still one row.
    """
    per_key = sales.groupBy("channel_sk", "order_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quantity").alias("units"),
        F.sum(cents("revenue_usd")).alias("booked"),
        F.count_if("is_returned").alias("returned"))
    named = channels.map(lambda d: d.select("channel_sk", "channel_name")) \
        .inner_join(per_key, "channel_sk")
    return named.groupBy("channel_name", "order_date").agg(
        F.sum("n").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("booked").cast("double").alias("booked_usd"),
        F.sum("returned").alias("returned_orders"),
    ).withColumn("return_rate_pct", share_pct(F.col("returned_orders"), F.col("orders")))
