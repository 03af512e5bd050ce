"""The daily run: bronze, silver, product snapshot, gold, tests, gate, in one Spark session.

Each stage writes its zone and the next one reads it back, so a restarted run repeats whole
stages and every stage replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradewake.operators import conform, incremental, quality, snapshot_table
from tradewake.operators.lookups import Lookup, measure
from tradewake.plans import gate as gate_plan
from tradewake.plans import gold
from tradewake.schemas import RAW_SCHEMAS
from tradewake.session import stored, together
from tradewake.sources import files
from tradewake.sources.day_table import Replaced
from tradewake.sources.lake import Lake

ENTITIES = tuple(RAW_SCHEMAS)
FACTS = ("fct_sales", "fct_settlement")
MARTS = ("mart_reconciliation", "agg_channel_daily")
GOLD_TABLES = ("dim_channel", "dim_product", "dim_date", "fct_sales", "fct_settlement",
               "mart_reconciliation", "agg_channel_daily")


@dataclass
class Landed:
    """Entities that were there and their rows, and those that were not."""

    rows: dict[str, int] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    @property
    def loaded(self) -> list[str]:
        return list(self.rows)


def land_bronze(lake: Lake, entities: tuple[str, ...] = ENTITIES) -> Landed:
    """Copy every raw entity with its load time; a missing one is reported, not an error."""
    def land(entity: str) -> int:
        counted = Observation(entity)
        lake.raw(entity).withColumn("_loaded_at", F.current_timestamp()) \
            .observe(counted, F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").parquet(lake.path("bronze", entity))
        return counted.get["rows"]

    there = [entity for entity in entities if lake.exists("raw", entity)]
    rows = together(lake.spark, *(partial(land, entity) for entity in there))
    return Landed(dict(zip(there, rows, strict=True)), [e for e in entities if e not in there])


def build_silver(lake: Lake, with_stream: bool = False) -> None:
    """``with_stream`` adds the orders that only the live lane knows (``conform.both_lanes``).

    Conformed rows are stored first: dealing them to files goes through them twice.
    """
    refs = conform.references(*(lake.read("bronze", name)
                                for name in ("ref_sku_map", "ref_status_map", "ref_fx")))
    sales = conform.conform_sales(lake.read("bronze", "sales_amazon"),
                                  lake.read("bronze", "sales_backmarket"), refs)
    if with_stream and files.has_data(lake.spark, lake.events_path()):
        events = conform.latest_events(lake.spark.read.parquet(lake.events_path()))
        sales = conform.both_lanes(sales, conform.conform_events(events, refs))
    settlements = conform.conform_settlements(lake.read("bronze", "settlements_oms"), refs.fx)
    products = conform.conform_products(lake.read("bronze", "ref_product"))
    together(
        lake.spark,
        lambda: lake.day_table("silver", "sales").replace_all(stored(sales, "conformed-sales")),
        lambda: lake.day_table("silver", "settlements").replace_all(
            stored(settlements, "conformed-settlements")),
        lambda: incremental.write_full(products, lake.path("silver", "products")))


def snapshot_products(lake: Lake, snapshot_ts: str) -> None:
    snapshot_table.take_snapshot(lake.silver_products(), lake.path("snapshots", "products"),
                                 snapshot_ts)


def _sale_days(lake: Lake) -> DataFrame:
    """First and last day of Silver sales, from the manifest."""
    days = [(d,) for d in lake.day_table("silver", "sales").days() if d is not None]
    return lake.spark.createDataFrame(days, "d string").select(F.to_date("d").alias("order_date"))


def build_dimensions(lake: Lake) -> None:
    sales = lake.silver_sales()
    versions = snapshot_table.read_versions(lake.spark, lake.path("snapshots", "products"))
    dims = {"dim_channel": gold.dim_channel(sales), "dim_date": gold.dim_date(_sale_days(lake)),
            "dim_product": gold.dim_product(versions)}
    together(lake.spark, *(partial(incremental.write_full, dim, lake.path("gold", name))
                           for name, dim in dims.items()))


def fact_lookups(lake: Lake) -> dict[str, Lookup]:
    return measure({
        "channels": gold.channel_keys(lake.read("gold", "dim_channel")),
        "products": gold.current_products(lake.read("gold", "dim_product")),
    })


def _refresh(lake: Lake, table: str, source: Callable[[str | None], DataFrame],
             build: Callable[[DataFrame], DataFrame], full_refresh: bool,
             lookback_days: int | None) -> Replaced | None:
    """``source`` gives the rows after a day, or all: files of earlier days are not opened."""
    target = lake.day_table("gold", table)
    if full_refresh or not target.exists():
        target.replace_all(build(source(None)))
        return None
    watermark = target.loaded_to()
    if lookback_days is None:
        delta = incremental.delta_strict(source(watermark), watermark, target.day)
    else:
        delta = incremental.delta_lookback(
            source(incremental.day_before(watermark, lookback_days + 1)), watermark, target.day,
            lookback_days)
    return target.replace_keys(build(delta))


def refresh_fct_sales(lake: Lake, full_refresh: bool = False,
                      lookback_days: int | None = None) -> Replaced | None:
    """Load new sales days, or rebuild. ``lookback_days`` also reloads that many old days."""
    dims = fact_lookups(lake)
    return _refresh(lake, "fct_sales", lake.silver_sales,
                    lambda rows: gold.fct_sales(rows, dims["channels"], dims["products"]),
                    full_refresh, lookback_days)


def refresh_fct_settlement(lake: Lake, full_refresh: bool = False,
                           lookback_days: int | None = None) -> Replaced | None:
    channels = fact_lookups(lake)["channels"]
    return _refresh(lake, "fct_settlement", lake.silver_settlements,
                    lambda rows: gold.fct_settlement(rows, channels), full_refresh, lookback_days)


@dataclass(frozen=True)
class Changed:
    """Order ids whose reconciliation, and days whose rollup, no longer hold."""

    order_ids: DataFrame
    days: set[str | None]


def changed_since(lake: Lake, sources: Mapping[str, int]) -> Changed | None:
    """What changed in the facts since those versions; None if that cannot be told.

    It cannot if a version is not kept any more, or if rows without an order id changed: these
    have no key to replace them by. Moved and rewritten rows that are as they were are no changes.
    """
    changes = {name: lake.day_table("gold", name).changes(sources.get(name, 0)) for name in FACTS}
    if any(frame is None for frame in changes.values()):
        return None
    sales = stored(changes["fct_sales"].select("order_id", "order_date"), "changed-sales")
    if not sales.filter("order_id IS NULL").isEmpty():
        return None
    ids = sales.select("order_id").unionAll(
        changes["fct_settlement"].select("order_ref").filter("order_ref IS NOT NULL")).distinct()
    days = sales.select(F.col("order_date").cast("string")).distinct().collect()  # at most all days
    return Changed(stored(ids, "changed-orders"), {r[0] for r in days})


def build_marts(lake: Lake, full_refresh: bool = False) -> Changed | None:
    """Bring both marts up to the facts: what changed in them alone, or everything.

    A mart names the versions of the facts it was made from, so that nothing is missed or counted
    twice, in whatever order increments came, and whether or not a run in between was cut off.
    """
    sales, settlements = (lake.day_table("gold", name) for name in FACTS)
    recon, rollup = (lake.day_table("gold", name) for name in MARTS)
    sources = {name: lake.day_table("gold", name).manifest().number for name in FACTS}
    built = [mart.manifest() for mart in (recon, rollup)]
    changed = None
    if not full_refresh and all(m is not None for m in built) and built[0].sources == built[1].sources:
        changed = changed_since(lake, built[0].sources)
    channels = measure({"channels": lake.read("gold", "dim_channel")})["channels"]
    if changed is None:
        together(
            lake.spark,
            lambda: recon.replace_all(stored(gold.mart_reconciliation(sales.read(), settlements.read()),
                                             "reconciled"), sources),
            lambda: rollup.replace_all(gold.agg_channel_daily(sales.read(), channels), sources))
        return None
    def reconcile() -> None:
        fresh = gold.mart_reconciliation(*together(
            lake.spark,
            lambda: sales.rows_with("order_id", changed.order_ids),
            lambda: settlements.rows_with("order_ref", changed.order_ids)))
        recon.replace_keys(fresh, changed.order_ids, sources)

    together(lake.spark, reconcile, lambda: rollup.replace_days(
        gold.agg_channel_daily(sales.read_days(changed.days), channels), changed.days, sources))
    return changed


def build_gold(lake: Lake, full_refresh: bool = False,
               lookback_days: int | None = None) -> None:
    build_dimensions(lake)
    together(lake.spark, lambda: refresh_fct_sales(lake, full_refresh, lookback_days),
             lambda: refresh_fct_settlement(lake, full_refresh, lookback_days))
    build_marts(lake, full_refresh)


def gold_tables(lake: Lake) -> dict[str, DataFrame]:
    return {name: lake.read("gold", name) for name in GOLD_TABLES}


def daily_run(lake: Lake, snapshot_ts: str, full_refresh: bool = False,
              lookback_days: int | None = None, gate: bool = True,
              with_stream: bool = False) -> Landed:
    """All stages in order; the first failing one ends the run."""
    outcome = land_bronze(lake)
    build_silver(lake, with_stream)
    lake.create_staging_views()
    snapshot_products(lake, snapshot_ts)
    build_gold(lake, full_refresh, lookback_days)
    if gate:
        quality.enforce(gate_plan.report(lake))
    return outcome
