"""Zones of the lake and the scans over them.

A lake is a folder with one sub-folder per zone (raw, bronze, silver, snapshots, gold, serving)
and one Parquet dataset per table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewake.schemas import RAW_SCHEMAS
from tradewake.sources import files
from tradewake.sources.day_table import DayTable

# Versioned tables: column of the day, key, and the columns that rows are looked up by.
DAY_TABLES: dict[tuple[str, str], tuple[str, str, tuple[str, ...]]] = {
    ("silver", "sales"): ("order_date", "order_id", ()),
    ("silver", "settlements"): ("payout_date", "settlement_id", ()),
    ("gold", "fct_sales"): ("order_date", "order_id", ("order_id",)),
    ("gold", "fct_settlement"): ("payout_date", "settlement_id", ("settlement_id", "order_ref")),
    ("gold", "mart_reconciliation"): ("order_date", "order_id", ("order_id",)),
    ("gold", "agg_channel_daily"): ("order_date", "channel_name", ()),
}


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, zone: str, table: str) -> str:
        suffix = ".parquet" if zone in ("raw", "bronze") else ""
        return f"{self.root}/{zone}/{table}{suffix}"

    def events_path(self) -> str:
        """Where the live lane lands its order events."""
        return f"{self.root}/bronze_stream/orders"

    def exists(self, zone: str, table: str) -> bool:
        return files.exists(self.spark, self.path(zone, table))

    def raw(self, entity: str) -> DataFrame:
        """Raw feed with its declared schema, so a drifted file fails instead of being guessed."""
        return self.spark.read.schema(RAW_SCHEMAS[entity]).parquet(self.path("raw", entity))

    def day_table(self, zone: str, table: str) -> DayTable:
        return DayTable(self.spark, self.path(zone, table), *DAY_TABLES[zone, table])

    def read(self, zone: str, table: str, after: str | None = None) -> DataFrame:
        """Dataset of a zone; of a versioned table also the days after one, other files unopened."""
        if (zone, table) in DAY_TABLES:
            return self.day_table(zone, table).read(after)
        return self.spark.read.parquet(self.path(zone, table))

    def silver_sales(self, after: str | None = None) -> DataFrame:
        """Typed view of Silver sales."""
        return self.read("silver", "sales", after).selectExpr(
            "order_id", "source", "cast(product_id as bigint) as product_id",
            "cast(quantity as int) as quantity", "cast(unit_price as double) as unit_price",
            "canonical_status", "cast(revenue_usd as double) as revenue_usd",
            "cast(order_date as date) as order_date")

    def silver_settlements(self, after: str | None = None) -> DataFrame:
        return self.read("silver", "settlements", after).selectExpr(
            "settlement_id", "channel", "order_ref", "cast(gross_usd as double) as gross_usd",
            "cast(fees_usd as double) as fees_usd", "cast(net_usd as double) as net_usd",
            "cast(payout_date as date) as payout_date")

    def silver_products(self) -> DataFrame:
        return self.read("silver", "products").selectExpr(
            "cast(product_id as bigint) as product_id", "model_name", "brand", "grade",
            "cast(unit_cost as double) as unit_cost", "cast(list_price as double) as list_price")

    def staged(self, table: str, view: str) -> DataFrame:
        """Typed scan of a Silver table, also as a view of the session."""
        frame = getattr(self, f"silver_{table}")()
        frame.createOrReplaceTempView(view)
        return frame

    def create_staging_views(self) -> None:
        """Expose the typed Silver scans to SQL users."""
        for table in ("sales", "settlements", "products"):
            self.staged(table, f"stg_{table}")
