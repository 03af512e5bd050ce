"""Publish the serving marts, to Parquet or to a database, and prove the copy matches Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradewake.operators import quality
from tradewake.operators.incremental import write_full
from tradewake.sources.jdbc import Database
from tradewake.sources.lake import Lake

SERVED_MARTS = ("agg_channel_daily", "mart_reconciliation")


def publish(lake: Lake, database: Database | None = None) -> None:
    """Replace each served mart in full."""
    for name in SERVED_MARTS:
        mart = lake.read("gold", name)
        if database:
            database.publish(mart, name)
        else:
            write_full(mart, lake.path("serving", name))


def served(lake: Lake, name: str, database: Database | None = None) -> DataFrame | None:
    if database:
        return database.read(name) if database.exists(name) else None
    return lake.read("serving", name) if lake.exists("serving", name) else None


def parity(lake: Lake, database: Database | None = None) -> DataFrame:
    gold = {name: lake.read("gold", name) for name in SERVED_MARTS}
    return quality.served_parity(
        gold, {name: served(lake, name, database) for name in SERVED_MARTS})


def verify(lake: Lake, database: Database | None = None) -> None:
    quality.enforce(parity(lake, database))
