"""Conform differently shaped feeds to one vocabulary, one currency and one date type."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions.dates import parse_day, utc_day
from tradewake.functions.money import amount, gross, to_usd
from tradewake.operators.lookups import BROADCAST_BUDGET, Lookup, measure
from tradewake.schemas import PRODUCT_COLUMNS, SALES_COLUMNS, SETTLEMENT_COLUMNS


@dataclass(frozen=True)
class ChannelFeed:
    """How one channel spells the common sales columns."""

    channel: str
    date_pattern: str
    columns: Mapping[str, str] = field(hash=False)


# The channels' own column names and date formats.
FEED_A = ChannelFeed("amazon", "yyyy/MM/dd", {
    "order_id": "amazon_order_id", "source_sku": "asin", "quantity": "qty",
    "unit_price": "item_price", "currency": "currency", "raw_status": "order_status",
    "sold_on": "purchase_date"})
FEED_B = ChannelFeed("backmarket", "dd-MM-yyyy", {
    "order_id": "bm_order_ref", "source_sku": "product_sku", "quantity": "quantity",
    "unit_price": "unit_amount", "currency": "devise", "raw_status": "state",
    "sold_on": "date_commande"})


@dataclass(frozen=True)
class References:
    """The three lookups of a conform run, each with its measured size class."""

    sku_map: Lookup
    status_map: Lookup
    fx: Lookup


def references(sku_map: DataFrame, status_map: DataFrame, fx: DataFrame,
               budget: int = BROADCAST_BUDGET) -> References:
    frames = {
        "sku_map": sku_map.select("channel", "source_sku", "product_id"),
        "status_map": status_map.select("channel", "raw_status", "canonical_status"),
        "fx": fx.select("rate_to_usd", parse_day("rate_date").alias("fx_date"),
                        F.col("currency").alias("fx_currency")),
    }
    return References(**measure(frames, budget))


def with_rate(rows: DataFrame, fx: Lookup, currency: str, day: str) -> DataFrame:
    """Add the day's ``rate_to_usd``; NULL if there is none. One join serves all amounts."""
    return fx.left_join(rows, (F.col(currency) == F.col("fx_currency"))
                        & (F.col(day) == F.col("fx_date")))


def conform_channel(raw: DataFrame, feed: ChannelFeed, refs: References) -> DataFrame:
    """One channel's export in the common sales contract."""
    spelled = raw.select(*[F.col(theirs).alias(ours) for ours, theirs in feed.columns.items()])
    rows = spelled.withColumns({
        "source": F.lit(feed.channel),
        "raw_status": F.col("raw_status").cast("string"),
        "order_date": parse_day("sold_on", feed.date_pattern),
    })

    def own(maps: DataFrame) -> DataFrame:
        return maps.filter(F.col("channel") == feed.channel).drop("channel")

    rows = refs.sku_map.map(own).left_join(rows, "source_sku")
    rows = refs.status_map.map(own).left_join(rows, "raw_status")
    return _priced_sales(rows, refs.fx)


def _priced_sales(rows: DataFrame, fx: Lookup) -> DataFrame:
    rated = with_rate(rows, fx, "currency", "order_date")
    usd = to_usd(gross("quantity", "unit_price"), "rate_to_usd")
    return rated.withColumn("revenue_usd", usd).select(*SALES_COLUMNS)


def conform_sales(channel_a: DataFrame, channel_b: DataFrame, refs: References) -> DataFrame:
    """Both channels, same grain and contract, stacked by column name."""
    return conform_channel(channel_a, FEED_A, refs).unionByName(
        conform_channel(channel_b, FEED_B, refs))


def sources(raw_sales: Mapping[ChannelFeed, DataFrame]) -> DataFrame:
    """The ``source`` column of the conformed sales, read without conforming them."""
    tagged = [raw.select(F.lit(feed.channel).alias("source"))
              for feed, raw in raw_sales.items()]
    return reduce(DataFrame.unionByName, tagged)


def conform_events(events: DataFrame, refs: References) -> DataFrame:
    """Landed order events in the sales contract: the live lane meets the batch lane here.

    Events name their channel per row, so the maps are joined on (channel, code). An event
    that could not be parsed has no order id and is left in Bronze.
    """
    rows = events.filter(F.col("order_id").isNotNull()).select(
        "order_id", F.col("channel").alias("source"), F.col("sku").alias("source_sku"),
        F.col("qty").alias("quantity"), "unit_price", "currency",
        F.col("status").alias("raw_status"), F.to_date("event_ts").alias("order_date"))

    def by_source(maps: DataFrame) -> DataFrame:
        return maps.withColumnRenamed("channel", "source")

    rows = refs.sku_map.map(by_source).left_join(rows, ["source", "source_sku"])
    rows = refs.status_map.map(by_source).left_join(rows, ["source", "raw_status"])
    return _priced_sales(rows, refs.fx)


def latest_events(events: DataFrame) -> DataFrame:
    """One landed event per order: the last by its time, then by its source coordinates.

    An order's events are reduced before the shuffle, so a hot order id arrives as a few rows.
    """
    order = ["event_ts", "kafka_ts", "kafka_partition", "kafka_offset"]
    rest = [c for c in events.columns if c not in (*order, "order_id")]
    return events.filter(F.col("order_id").isNotNull()).groupBy("order_id") \
        .agg(F.max(F.struct(*order, *rest)).alias("last")).select("order_id", "last.*")


def both_lanes(batch: DataFrame, live: DataFrame) -> DataFrame:
    """Sales of the batch feeds, and those of the live lane that no feed has brought yet.

    The feeds are the channels' own records and come with the settlements, so an order known
    from both lanes is taken from the feed.
    """
    known = batch.select("order_id").filter(F.col("order_id").isNotNull()).distinct()
    return batch.unionByName(live.join(known, "order_id", "left_anti").select(*batch.columns))


def conform_settlements(raw: DataFrame, fx: Lookup) -> DataFrame:
    """Remittances at their own grain, in USD at the payout day's rate."""
    dated = raw.withColumn("payout_date", utc_day("payout_ts"))
    rated = with_rate(dated, fx, "payout_currency", "payout_date")
    fees = amount("marketplace_fee") + amount("shipping_fee")
    return rated.withColumns({
        "gross_usd": to_usd(amount("gross_amount"), "rate_to_usd"),
        "fees_usd": to_usd(fees, "rate_to_usd"),
        "net_usd": to_usd(amount("net_paid"), "rate_to_usd"),
    }).select(*SETTLEMENT_COLUMNS)


def conform_products(raw: DataFrame) -> DataFrame:
    """One row per product. Of several rows the smallest one (by column order) survives.

    An aggregation rather than a ranking window: duplicates collapse before the shuffle, so a
    product repeated very often does not end up in one task's sort.
    """
    typed = raw.select(
        "product_id", "model_name", "brand", "grade",
        F.col("unit_cost").cast("double").alias("unit_cost"),
        F.col("list_price").cast("double").alias("list_price"))
    rest = [c for c in PRODUCT_COLUMNS if c != "product_id"]
    survivors = typed.groupBy("product_id").agg(F.min(F.struct(*rest)).alias("row"))
    return survivors.select("product_id", "row.*")


def status_coverage(raw_sales: Mapping[ChannelFeed, DataFrame],
                    status_map: Lookup) -> DataFrame:
    """How often each channel's raw status occurs and what it maps to (NULL: unmapped)."""
    counts = [raw.groupBy(
        F.lit(feed.channel).alias("channel"),
        F.col(feed.columns["raw_status"]).cast("string").alias("raw_status")
    ).agg(F.count(F.lit(1)).alias("orders")) for feed, raw in raw_sales.items()]
    return status_map.left_join(reduce(DataFrame.unionByName, counts), ["channel", "raw_status"]) \
        .select("channel", "raw_status", "canonical_status", "orders")
