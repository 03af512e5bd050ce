"""Raw feeds derived from the order, part and event tables.

The given tables hold no marketplace exports, so the feeds the jobs expect are computed from
them, without random numbers: every order becomes one sale in exactly one channel, every
shipped or delivered order may get remittances, every part is a product, every event an order
event. Irregular cases are planted on purpose (unmapped SKUs, unsettled orders, split
remittances, gaps beyond tolerance, malformed messages). `FIXTURES.md` lists the rules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.functions.money import amount

T = TypeVar("T")

# The channels' names, status vocabularies and fee rates.
CHANNEL_A, CHANNEL_B = "amazon", "backmarket"
STATUS_WORDS = ("Pending", "Shipped", "Delivered", "Cancelled", "Returned")
CANONICAL = ("PENDING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
FEE_RATE_A, FEE_RATE_B = "0.15", "0.12"

# Days between an order and its latest possible payout.
LAST_PAYOUT_LAG = 31
FX_EPOCH = "1995-01-01"


def _decimal(text: str) -> Column:
    return F.lit(text).cast("decimal(10,2)")


def _status_word(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in STATUS_WORDS]), code)


def sku_a(key: Column) -> Column:
    return F.format_string("B0%08d", key)


def sku_b(key: Column) -> Column:
    return F.format_string("SKU%07d", key)


@dataclass(frozen=True, eq=False)
class DerivedFeeds:
    spark: SparkSession
    folder: str
    _built: dict = field(default_factory=dict, repr=False)

    def once(self, build: Callable[[DerivedFeeds], T]) -> T:
        """Build a plan once for this set of feeds, however many steps refer to it."""
        if build not in self._built:
            self._built[build] = build(self)
        return self._built[build]

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._built[name]

    def feed(self, entity: str) -> DataFrame:
        return getattr(self, entity)()

    def _part_count(self) -> Column:
        return self.table("part").select(F.count(F.lit(1))).scalar()

    def _orders(self) -> DataFrame:
        mix = F.col("o_custkey") % 25
        status = (F.when(mix < 2, 1).when(mix < 5, 2).when(mix < 21, 3).when(mix < 23, 4)
                  .otherwise(5))
        return self.table("orders").select(
            F.col("o_orderkey").alias("k"),
            F.col("o_orderdate").cast("date").alias("day"),
            F.col("o_totalprice").alias("price"),
            (1 + F.col("o_orderkey") % 3).cast("int").alias("qty"),
            (F.col("o_orderkey") % 100 < 78).alias("in_channel_a"),
            status.alias("status"))

    def sales_amazon(self) -> DataFrame:
        return self._orders().filter("in_channel_a").select(
            F.format_string("111-%010d", "k").alias("amazon_order_id"),
            sku_a(F.col("k") % self._part_count()).alias("asin"),
            "qty",
            F.col("price").alias("item_price"),
            F.lit("USD").alias("currency"),
            _status_word(F.col("status")).alias("order_status"),
            F.date_format("day", "yyyy/MM/dd").alias("purchase_date"))

    def sales_backmarket(self) -> DataFrame:
        return self._orders().filter("not in_channel_a").select(
            F.format_string("BM-%09d", "k").alias("bm_order_ref"),
            sku_b(F.col("k") % self._part_count()).alias("product_sku"),
            F.col("qty").alias("quantity"),
            F.col("price").alias("unit_amount"),
            F.lit("EUR").alias("devise"),
            F.col("status").alias("state"),
            F.date_format("day", "dd-MM-yyyy").alias("date_commande"))

    def settlements_oms(self) -> DataFrame:
        k = F.col("k")
        split = k % 10 == 1
        remitted = self._orders().filter("status in (2, 3)").filter(k % 20 != 0).select(
            "k", "in_channel_a", "day",
            (F.col("qty") * amount("price")).cast("decimal(18,4)").alias("order_gross"),
            F.explode(F.when(split, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
            .alias("part"))
        first = F.round(F.col("order_gross") * _decimal("0.60"), 2).cast("decimal(18,4)")
        priced = remitted.withColumn(
            "gross",
            F.when(~split, F.col("order_gross")).when(F.col("part") == 1, first)
            .otherwise(F.col("order_gross") - first).cast("decimal(18,4)"))
        rate = F.when(F.col("in_channel_a"), _decimal(FEE_RATE_A)).otherwise(_decimal(FEE_RATE_B))
        charged = priced.withColumn(
            "fee", F.round(F.col("gross") * rate, 2).cast("decimal(18,4)")
        ).withColumn("shipping", (2 + k % 11).cast("decimal(10,0)"))
        paid = F.when(k % 500 == 3, _decimal("0.80")).otherwise(_decimal("1.00"))
        net = (F.col("gross") - F.col("fee") - F.col("shipping")).cast("decimal(18,4)") * paid
        return charged.select(
            F.format_string("STL-%010d-%d", "k", "part").alias("settlement_id"),
            F.when(F.col("in_channel_a"), CHANNEL_A).otherwise(CHANNEL_B).alias("channel"),
            F.when(F.col("in_channel_a"), F.format_string("111-%010d", "k"))
            .otherwise(F.format_string("BM-%09d", "k")).alias("order_ref"),
            F.col("gross").cast("double").alias("gross_amount"),
            F.col("fee").cast("double").alias("marketplace_fee"),
            F.col("shipping").cast("double").alias("shipping_fee"),
            F.round(net, 2).cast("double").alias("net_paid"),
            F.when(F.col("in_channel_a"), "USD").otherwise("EUR").alias("payout_currency"),
            ((F.unix_date("day") + 2 + k % 30) * 86400).cast("long").alias("payout_ts"))

    def ref_sku_map(self) -> DataFrame:
        key = F.col("p_partkey")
        listed = self.table("part").select(
            key, F.explode(F.when(key % 20 == 19, F.array(F.lit(CHANNEL_A)))
                           .otherwise(F.array(F.lit(CHANNEL_A), F.lit(CHANNEL_B))))
            .alias("channel"))
        return listed.select(
            "channel",
            F.when(F.col("channel") == CHANNEL_A, sku_a(key)).otherwise(sku_b(key))
            .alias("source_sku"),
            key.alias("product_id"))

    def ref_status_map(self) -> DataFrame:
        words = [(CHANNEL_A, raw, canon)
                 for raw, canon in zip(STATUS_WORDS, CANONICAL, strict=True)]
        codes = [(CHANNEL_B, str(i), canon) for i, canon in enumerate(CANONICAL, start=1)]
        rows = ", ".join(str(row) for row in words + codes)
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} AS t(channel, raw_status, canonical_status)")

    def ref_product(self) -> DataFrame:
        price = F.col("p_retailprice")
        grade = F.when(F.col("p_size") <= 22, "A").when(F.col("p_size") <= 42, "B").otherwise("C")
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("model_name"),
            F.col("p_brand").alias("brand"),
            grade.alias("grade"),
            F.round(amount(price) * _decimal("0.70"), 2).cast("double").alias("unit_cost"),
            price.alias("list_price"))

    def ref_product_v2(self) -> DataFrame:
        """The master one month later: repriced, regraded, delisted and new products."""
        key = F.col("product_id")
        raised = F.round(amount("list_price") * _decimal("1.10"), 2).cast("double")
        first = self.ref_product()
        changed = first.filter(key % 97 != 5).withColumns({
            "list_price": F.when(key % 12 == 0, raised).otherwise(F.col("list_price")),
            "grade": F.when(key % 33 == 0, "C").otherwise(F.col("grade"))})
        added = first.filter(key % 200 == 0).withColumn("product_id", -1 - key)
        return changed.unionByName(added)

    def ref_fx(self) -> DataFrame:
        """Daily rates for every day an order, a payout or an event can fall on."""
        order_days = self.table("orders").select(
            F.min("o_orderdate").cast("date").alias("lo"),
            F.date_add(F.max("o_orderdate").cast("date"), LAST_PAYOUT_LAG).alias("hi"))
        event_days = self.table("events").select(
            F.min("ts").cast("date").alias("lo"), F.max("ts").cast("date").alias("hi"))
        days = order_days.unionAll(event_days).select(
            F.explode(F.sequence("lo", "hi")).alias("day")).distinct()
        i = F.datediff("day", F.lit(FX_EPOCH).cast("date"))

        def wobble(base: str, step: int) -> Column:
            ticks = (i * step) % 101 - 50
            return _decimal(base) + ticks.cast("decimal(10,0)") * F.lit("0.0001").cast("decimal(8,4)")

        def quoted(currency: str, rate: Column) -> Column:
            return F.struct(F.lit(currency).alias("currency"),
                            rate.cast("double").alias("rate_to_usd"))

        rates = F.array(quoted("USD", F.lit(1)), quoted("EUR", wobble("1.08", 37)),
                        quoted("GBP", wobble("1.27", 53)))
        return days.select(F.col("day").cast("string").alias("rate_date"),
                           F.explode(rates).alias("r")) \
            .select("rate_date", "r.currency", "r.rate_to_usd")

    def order_events(self) -> DataFrame:
        """Order events as typed rows, ``ts`` being the event time (zone UTC)."""
        e = F.col("event_id")
        in_a = e % 100 < 78
        status = (e % 5 + 1).cast("int")
        slot = e % self._part_count()
        return self.table("events").select(
            e.alias("seq"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.concat(F.lit("EV-"), e.cast("string")).alias("event_id"),
            F.format_string("111-%010d", e).alias("order_id"),
            F.when(in_a, CHANNEL_A).otherwise(CHANNEL_B).alias("channel"),
            F.when(in_a, sku_a(slot)).otherwise(sku_b(slot)).alias("sku"),
            (1 + e % 3).cast("int").alias("qty"),
            F.col("value").alias("unit_price"),
            F.when(in_a, "USD").otherwise("EUR").alias("currency"),
            F.when(in_a, _status_word(status)).otherwise(status.cast("string")).alias("status"))

    def order_messages(self) -> DataFrame:
        """The events as JSON messages with source coordinates; some payloads are broken."""
        payload = F.to_json(F.struct(
            "event_id", "order_id", "channel", "sku", "qty", "unit_price", "currency", "status",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_ts")))
        value = F.when(F.col("seq") % 997 == 13, F.lit("{bad")).otherwise(payload)
        return self.order_events().select(
            F.col("order_id").cast("binary").alias("key"),
            value.cast("binary").alias("value"),
            (F.col("seq") % 4).cast("int").alias("partition"),
            F.floor(F.col("seq") / 4).cast("long").alias("offset"),
            F.col("ts").alias("timestamp"),
            "seq")
