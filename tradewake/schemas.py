"""Column contracts of the raw feeds and of the order event."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()

# Names, types and order of the feeds' columns.
RAW_SCHEMAS: dict[str, StructType] = {
    "sales_amazon": _struct(
        amazon_order_id=_TEXT, asin=_TEXT, qty=_INT, item_price=_DOUBLE, currency=_TEXT,
        order_status=_TEXT, purchase_date=_TEXT),
    "sales_backmarket": _struct(
        bm_order_ref=_TEXT, product_sku=_TEXT, quantity=_INT, unit_amount=_DOUBLE,
        devise=_TEXT, state=_INT, date_commande=_TEXT),
    "settlements_oms": _struct(
        settlement_id=_TEXT, channel=_TEXT, order_ref=_TEXT, gross_amount=_DOUBLE,
        marketplace_fee=_DOUBLE, shipping_fee=_DOUBLE, net_paid=_DOUBLE,
        payout_currency=_TEXT, payout_ts=_LONG),
    "ref_sku_map": _struct(channel=_TEXT, source_sku=_TEXT, product_id=_LONG),
    "ref_product": _struct(
        product_id=_LONG, model_name=_TEXT, brand=_TEXT, grade=_TEXT,
        unit_cost=_DOUBLE, list_price=_DOUBLE),
    "ref_fx": _struct(rate_date=_TEXT, currency=_TEXT, rate_to_usd=_DOUBLE),
    "ref_status_map": _struct(channel=_TEXT, raw_status=_TEXT, canonical_status=_TEXT),
}

# The JSON payload of one live order event.
ORDER_EVENT = _struct(
    event_id=_TEXT, order_id=_TEXT, channel=_TEXT, sku=_TEXT, qty=_INT, unit_price=_DOUBLE,
    currency=_TEXT, status=_TEXT, event_ts=_TEXT)

# Which field of a message becomes which source coordinate of the landed event.
LINEAGE = {"partition": "kafka_partition", "offset": "kafka_offset", "timestamp": "kafka_ts"}

# What a message source hands over, whether it is a Kafka topic or a folder of files.
MESSAGE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# The conformed contracts.
SALES_COLUMNS = ("order_id", "source", "product_id", "quantity", "unit_price",
                 "canonical_status", "order_date", "revenue_usd")
SETTLEMENT_COLUMNS = ("settlement_id", "channel", "order_ref", "payout_date",
                      "gross_usd", "fees_usd", "net_usd")
PRODUCT_COLUMNS = ("product_id", "model_name", "brand", "grade", "unit_cost", "list_price")
