"""Every operator as a query over the given tables: name -> callable(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewake.functions.dates import parse_day
from tradewake.operators import conform, incremental, quality, scd2, snapshot_table
from tradewake.operators.lookups import Lookup, measure, measured
from tradewake.plans import daily_run, dashboards, gate, gold, publish, refresh_timing
from tradewake.session import prepare, run_folder, stored, together
from tradewake.registry.derived_feeds import DerivedFeeds
from tradewake.sources.lake import Lake
from tradewake.sources.messages import from_files
from tradewake.streaming import continuity
from tradewake.streaming import orders as live

Query = Callable[[SparkSession, str], DataFrame]

FIRST_SNAPSHOT, SECOND_SNAPSHOT = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
# Snapshot times inside the order history, so that as-of lookups meet both versions.
ASOF_FIRST, ASOF_SECOND = "1995-06-01 00:00:00", "1998-06-01 00:00:00"

# The incremental scenario: the first load ends this many days before the last sale, ...
FIRST_LOAD_ENDS = 60
# ... and later loads look back this far.
LOOKBACK_DAYS = 30
EVERYTHING = 36500

_REGISTERED: dict[str, Query] = {}


def _query(build: Callable[[DerivedFeeds], DataFrame]) -> Callable[[DerivedFeeds], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(DerivedFeeds(prepare(spark), folder))
    _REGISTERED[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# Shared steps; a query refers to them through ``f.once`` so that each is planned, and its
# lookups measured, a single time.

def _references(f: DerivedFeeds) -> conform.References:
    return conform.references(f.ref_sku_map(), f.ref_status_map(), stored(f.ref_fx(), "fx"))


def _sales(f: DerivedFeeds) -> DataFrame:
    return conform.conform_sales(f.sales_amazon(), f.sales_backmarket(), f.once(_references))


def _stored_sales(f: DerivedFeeds) -> DataFrame:
    """For queries that go through the sales several times: feeds are conformed once."""
    return stored(f.once(_sales), "sales")


def _settlements(f: DerivedFeeds) -> DataFrame:
    return conform.conform_settlements(f.settlements_oms(), f.once(_references).fx)


def _two_snapshots(f: DerivedFeeds, first: str, second: str) -> DataFrame:
    before = conform.conform_products(f.ref_product())
    after = conform.conform_products(f.ref_product_v2())
    return scd2.merge_snapshot(scd2.first_versions(before, _at(first)), after, _at(second))


def _versions(f: DerivedFeeds) -> DataFrame:
    return _two_snapshots(f, FIRST_SNAPSHOT, SECOND_SNAPSHOT)


def _products(f: DerivedFeeds) -> DataFrame:
    return gold.dim_product(f.once(_versions))


def _channels(f: DerivedFeeds) -> DataFrame:
    """The channels that have sales: known from the feeds, before any join."""
    feeds = {conform.FEED_A: f.sales_amazon(), conform.FEED_B: f.sales_backmarket()}
    return gold.dim_channel(conform.sources(feeds))


def _dimensions(f: DerivedFeeds) -> dict[str, Lookup]:
    return measure({"channels": stored(f.once(_channels), "channels"),
                    "products": stored(gold.current_products(f.once(_products)), "products")})


def _keyed_sales(sales: DataFrame, dims: Mapping[str, Lookup]) -> DataFrame:
    return gold.fct_sales(sales, dims["channels"].map(gold.channel_keys), dims["products"])


def _fct_sales(f: DerivedFeeds) -> DataFrame:
    return _keyed_sales(f.once(_sales), f.once(_dimensions))


def _fct_settlement(f: DerivedFeeds) -> DataFrame:
    channels = f.once(_dimensions)["channels"].map(gold.channel_keys)
    return gold.fct_settlement(f.once(_settlements), channels)


def _reconciliation(f: DerivedFeeds) -> DataFrame:
    return gold.mart_reconciliation(f.once(_fct_sales), f.once(_fct_settlement))


def _rollup(f: DerivedFeeds) -> DataFrame:
    return gold.agg_channel_daily(f.once(_fct_sales), f.once(_dimensions)["channels"])


# --- landing and staging ---------------------------------------------------------------------

def _new_lake(f: DerivedFeeds, name: str) -> Lake:
    return Lake(f.spark, run_folder(f.spark, name))


def _fill_raw(f: DerivedFeeds, lake: Lake) -> Lake:
    together(f.spark, *(partial(f.feed(entity).write.parquet, lake.path("raw", entity))
                        for entity in daily_run.ENTITIES))
    return lake


@_query
def bronze_landing(f: DerivedFeeds) -> DataFrame:
    lake = _fill_raw(f, _new_lake(f, "bronze"))
    landed = daily_run.land_bronze(lake).loaded
    return reduce(DataFrame.unionByName, [
        lake.read("bronze", entity).agg(
            F.count(F.lit(1)).alias("rows"), F.count("_loaded_at").alias("stamped"))
        .select(F.lit(entity).alias("entity"), "rows", "stamped") for entity in landed])


@_query
def staging_sales(f: DerivedFeeds) -> DataFrame:
    lake = _new_lake(f, "silver")
    lake.day_table("silver", "sales").replace_all(f.once(_sales))
    return lake.silver_sales()


@_query
def staging_settlements(f: DerivedFeeds) -> DataFrame:
    lake = _new_lake(f, "silver")
    lake.day_table("silver", "settlements").replace_all(f.once(_settlements))
    return lake.silver_settlements()


@_query
def staging_products(f: DerivedFeeds) -> DataFrame:
    lake = _new_lake(f, "silver")
    incremental.write_full(conform.conform_products(f.ref_product()),
                           lake.path("silver", "products"))
    return lake.silver_products()


# --- conforming ------------------------------------------------------------------------------

@_query
def conform_fx(f: DerivedFeeds) -> DataFrame:
    """The rates that sales are converted with, each currency and day once."""
    needed = reduce(DataFrame.unionByName, [
        frame.select(F.col(feed.columns["currency"]).alias("fx_currency"),
                     parse_day(feed.columns["sold_on"], feed.date_pattern).alias("fx_date"))
        for feed, frame in ((conform.FEED_A, f.sales_amazon()),
                            (conform.FEED_B, f.sales_backmarket()))]).distinct()
    return f.once(_references).fx.frame.join(needed, ["fx_currency", "fx_date"], "left_semi")


@_query
def conform_channel_a(f: DerivedFeeds) -> DataFrame:
    return conform.conform_channel(f.sales_amazon(), conform.FEED_A, f.once(_references))


@_query
def conform_channel_b(f: DerivedFeeds) -> DataFrame:
    return conform.conform_channel(f.sales_backmarket(), conform.FEED_B, f.once(_references))


@_query
def conform_sales(f: DerivedFeeds) -> DataFrame:
    return f.once(_sales)


@_query
def conform_settlement(f: DerivedFeeds) -> DataFrame:
    return f.once(_settlements)


@_query
def conform_products(f: DerivedFeeds) -> DataFrame:
    """Both monthly masters at once: most products occur twice and one row of each survives."""
    return conform.conform_products(f.ref_product().unionByName(f.ref_product_v2()))


@_query
def status_map_coverage(f: DerivedFeeds) -> DataFrame:
    raw = {conform.FEED_A: f.sales_amazon(), conform.FEED_B: f.sales_backmarket()}
    return conform.status_coverage(raw, measured(f.ref_status_map()))


# --- star schema -----------------------------------------------------------------------------

@_query
def dim_channel(f: DerivedFeeds) -> DataFrame:
    return f.once(_channels)


def _sale_days(f: DerivedFeeds) -> DataFrame:
    """The days of both feeds: no lookup is needed for them."""
    return reduce(DataFrame.unionByName, [
        frame.select(parse_day(feed.columns["sold_on"], feed.date_pattern).alias("order_date"))
        for feed, frame in ((conform.FEED_A, f.sales_amazon()),
                            (conform.FEED_B, f.sales_backmarket()))])


@_query
def dim_date(f: DerivedFeeds) -> DataFrame:
    return gold.dim_date(_sale_days(f))


@_query
def dim_product(f: DerivedFeeds) -> DataFrame:
    return f.once(_products)


@_query
def fct_sales(f: DerivedFeeds) -> DataFrame:
    return f.once(_fct_sales)


@_query
def fct_settlement(f: DerivedFeeds) -> DataFrame:
    return f.once(_fct_settlement)


@_query
def mart_reconciliation(f: DerivedFeeds) -> DataFrame:
    return f.once(_reconciliation)


@_query
def agg_channel_daily(f: DerivedFeeds) -> DataFrame:
    return f.once(_rollup)


# --- dashboards ------------------------------------------------------------------------------

@_query
def recon_tiles(f: DerivedFeeds) -> DataFrame:
    return dashboards.reconciliation_tiles(f.once(_reconciliation))


@_query
def gap_split(f: DerivedFeeds) -> DataFrame:
    return dashboards.gap_split(f.once(_reconciliation))


@_query
def daily_booked_series(f: DerivedFeeds) -> DataFrame:
    return dashboards.daily_series(f.once(_rollup), "booked_usd")


@_query
def daily_orders_series(f: DerivedFeeds) -> DataFrame:
    return dashboards.daily_series(f.once(_rollup), "orders")


@_query
def return_rate_series(f: DerivedFeeds) -> DataFrame:
    return dashboards.daily_series(f.once(_rollup), "return_rate_pct")


def _live_backfill(f: DerivedFeeds) -> DataFrame:
    """The live aggregate computed over all messages as a batch."""
    return live.per_minute(live.landed(f.order_messages()))


@_query
def realtime_tiles(f: DerivedFeeds) -> DataFrame:
    as_of = f.table("events").select(F.max("ts").cast("timestamp")).scalar()
    return dashboards.live_tiles(_live_backfill(f), as_of)


@_query
def realtime_orders_series(f: DerivedFeeds) -> DataFrame:
    return dashboards.live_series(_live_backfill(f), "orders")


@_query
def realtime_units_series(f: DerivedFeeds) -> DataFrame:
    return dashboards.live_series(_live_backfill(f), "units")


# --- versioned products ----------------------------------------------------------------------

@_query
def scd2_two_snapshots(f: DerivedFeeds) -> DataFrame:
    return f.once(_versions)


@_query
def scd2_current(f: DerivedFeeds) -> DataFrame:
    return f.once(_products).filter("is_current")


@_query
def scd2_stored(f: DerivedFeeds) -> DataFrame:
    """The same history through the stored table, the second snapshot taken twice."""
    path = _new_lake(f, "versions").path("snapshots", "products")
    snapshot_table.take_snapshot(conform.conform_products(f.ref_product()), path, FIRST_SNAPSHOT)
    after = conform.conform_products(f.ref_product_v2())
    snapshot_table.take_snapshot(after, path, SECOND_SNAPSHOT)
    snapshot_table.take_snapshot(after, path, SECOND_SNAPSHOT)
    return snapshot_table.read_versions(f.spark, path)


@_query
def scd2_corrected_repeat(f: DerivedFeeds) -> DataFrame:
    """The second snapshot sees a wrong source, then an empty one, and at last the right one."""
    path = _new_lake(f, "versions").path("snapshots", "products")
    before = conform.conform_products(f.ref_product())
    after = conform.conform_products(f.ref_product_v2())
    snapshot_table.take_snapshot(before, path, FIRST_SNAPSHOT)
    wrong = after.withColumn("list_price", F.col("list_price") + F.col("product_id") % 3)
    for source in (wrong, after.limit(0), after):
        snapshot_table.take_snapshot(source, path, SECOND_SNAPSHOT)
    return snapshot_table.read_versions(f.spark, path)


@_query
def asof_product_join(f: DerivedFeeds) -> DataFrame:
    versions = gold.dim_product(_two_snapshots(f, ASOF_FIRST, ASOF_SECOND))
    facts = f.once(_sales).select("order_id", "product_id", "order_date", "revenue_usd")
    return scd2.asof_product_join(facts, measured(versions))


def _best_discounts(f: DerivedFeeds) -> DataFrame:
    """Versions of every part: its largest discount, month by month of shipping, until the next one."""
    months = f.table("lineitem").groupBy(
        F.col("l_partkey").alias("part"),
        F.date_trunc("month", F.date_add("l_shipdate", 31)).alias("valid_from")) \
        .agg(F.max("l_discount").alias("discount"))
    following = F.lead("valid_from").over(Window.partitionBy("part").orderBy("valid_from"))
    return months.withColumn("valid_to", following)


@_query
def asof_merge_discounts(f: DerivedFeeds) -> DataFrame:
    """Every line item with the largest discount that its part had until the month before."""
    lines = f.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"),
                                       "l_shipdate", "l_quantity")
    return scd2.asof_merge(lines, _best_discounts(f), "part", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "part", "l_shipdate", "l_quantity",
        F.col("version.valid_from").alias("discount_since"), F.col("version.discount").alias("discount_before"))


# --- incremental loads -----------------------------------------------------------------------

def _order_number() -> Column:
    return F.substring_index("order_id", "-", -1).cast("long")


def _first_load(sales: DataFrame) -> DataFrame:
    """What the first load saw: no recent days, late orders missing, some dated too early."""
    ends = sales.select(F.date_sub(F.max("order_date"), FIRST_LOAD_ENDS)).scalar()
    seen = sales.filter((F.col("order_date") <= ends) & (_order_number() % 50 != 7))
    return seen.withColumn("order_date", F.when(
        _order_number() % 61 == 5, F.date_sub("order_date", 3)).otherwise(F.col("order_date")))


def _loaded_twice(f: DerivedFeeds, lookback_days: int | None, lake: Lake | None = None,
                  between: Callable[[], object] = lambda: None) -> DataFrame:
    """First load with the first product snapshot, second load with the second one."""
    table = (lake or _new_lake(f, "facts")).day_table("gold", "fct_sales")
    sales = f.once(_stored_sales)
    old = gold.dim_product(scd2.first_versions(conform.conform_products(f.ref_product()),
                                               _at(FIRST_SNAPSHOT)))
    dims = f.once(_dimensions)
    old_dims = {**dims, "products": measured(gold.current_products(old))}
    table.replace_all(_keyed_sales(_first_load(sales), old_dims))
    between()
    loaded_to = table.loaded_to()
    delta = incremental.delta_strict(sales, loaded_to, "order_date") if lookback_days is None \
        else incremental.delta_lookback(sales, loaded_to, "order_date", lookback_days)
    table.replace_keys(_keyed_sales(delta, dims))
    return table.read()


@_query
def incremental_strict(f: DerivedFeeds) -> DataFrame:
    return _loaded_twice(f, None)


@_query
def incremental_lookback(f: DerivedFeeds) -> DataFrame:
    return _loaded_twice(f, LOOKBACK_DAYS)


@_query
def incremental_equals_full(f: DerivedFeeds) -> DataFrame:
    """A lookback over everything must end where a full refresh ends."""
    loaded = _loaded_twice(f, EVERYTHING)
    full = _keyed_sales(f.once(_stored_sales), f.once(_dimensions))
    tagged = loaded.select(*full.columns, F.lit(1).alias("side")) \
        .unionByName(full.withColumn("side", F.lit(-1)))
    balance = tagged.groupBy(*full.columns).agg(
        F.count_if(F.col("side") == 1).alias("n_loaded"),
        F.count_if(F.col("side") == -1).alias("n_full"))
    return balance.agg(
        F.sum("n_loaded").alias("loaded_rows"), F.sum("n_full").alias("full_rows"),
        F.sum(F.abs(F.col("n_loaded") - F.col("n_full"))).alias("differing"))


@_query
def incremental_settlement(f: DerivedFeeds) -> DataFrame:
    table = _new_lake(f, "facts").day_table("gold", "fct_settlement")
    facts = stored(f.once(_fct_settlement), "fct-settlement")
    ends = facts.select(F.date_sub(F.max("payout_date"), FIRST_LOAD_ENDS)).scalar()
    table.replace_all(facts.filter(F.col("payout_date") <= ends))
    table.replace_keys(incremental.delta_strict(facts, table.loaded_to(), "payout_date"))
    return table.read()


def _marts_loaded_twice(f: DerivedFeeds) -> Lake:
    """Marts built after the first loads, then brought up to the second ones by what changed."""
    lake = _new_lake(f, "marts")
    incremental.write_full(f.once(_channels), lake.path("gold", "dim_channel"))
    cash = stored(f.once(_fct_settlement), "fct-settlement")
    ends = cash.select(F.date_sub(F.max("payout_date"), FIRST_LOAD_ENDS)).scalar()
    lake.day_table("gold", "fct_settlement").replace_all(cash.filter(F.col("payout_date") <= ends))
    _loaded_twice(f, LOOKBACK_DAYS, lake, between=lambda: daily_run.build_marts(lake))
    settlements = lake.day_table("gold", "fct_settlement")
    settlements.replace_keys(incremental.delta_strict(cash, settlements.loaded_to(), "payout_date"))
    if daily_run.build_marts(lake) is None:
        raise RuntimeError("the marts were rebuilt in full")
    return lake


@_query
def marts_incremental(f: DerivedFeeds) -> DataFrame:
    """Reconciliation after increments of both facts, recomputed for the orders they touched."""
    return f.once(_marts_loaded_twice).read("gold", "mart_reconciliation")


@_query
def marts_incremental_daily(f: DerivedFeeds) -> DataFrame:
    """Daily rollup after an increment of sales, recomputed for the days it touched."""
    return f.once(_marts_loaded_twice).read("gold", "agg_channel_daily")


def _sales_lake(f: DerivedFeeds) -> Lake:
    """Silver sales, the two dimensions a sale refers to, and the sales fact."""
    lake = _new_lake(f, "sales")
    lake.day_table("silver", "sales").replace_all(f.once(_sales))
    incremental.write_full(f.once(_channels), lake.path("gold", "dim_channel"))
    incremental.write_full(f.once(_products), lake.path("gold", "dim_product"))
    daily_run.refresh_fct_sales(lake)
    return lake


@_query
def staging_views(f: DerivedFeeds) -> DataFrame:
    """Units and revenue by status through SQL on a staging view."""
    lake = _new_lake(f, "silver")
    lake.day_table("silver", "sales").replace_all(f.once(_sales))
    return lake.staged("sales", "stg_sales").sparkSession.sql("""
        SELECT canonical_status, count(*) AS orders, sum(quantity) AS units,
               CAST(sum(CAST(revenue_usd AS decimal(18,2))) AS double) AS revenue_usd
        FROM stg_sales GROUP BY canonical_status""")


@_query
def full_refresh(f: DerivedFeeds) -> DataFrame:
    """The switch that rebuilds the fact: days lost from it, old ones too, come back."""
    lake = f.once(_sales_lake)
    table = lake.day_table("gold", "fct_sales")
    table.replace_all(table.read().filter(F.day("order_date") % 3 != 1))
    daily_run.refresh_fct_sales(lake, full_refresh=True)
    return table.read()


@_query
def refresh_counts(f: DerivedFeeds) -> DataFrame:
    """What the comparison of increment and rebuild moved: rows of the fact and of its last day, and
    files of older days that the increment rewrote."""
    timing = refresh_timing.time_refresh(f.once(_sales_lake))
    return f.spark.createDataFrame(
        [(timing.fact_rows, timing.delta_rows, timing.files_rewritten)],
        "fact_rows bigint, delta_rows bigint, files_rewritten bigint")


@_query
def append_delta_day(f: DerivedFeeds) -> DataFrame:
    """Silver per day after its last day was held back and then added."""
    table = _new_lake(f, "silver").day_table("silver", "sales")
    sales = f.once(_stored_sales)
    last = sales.select(F.max("order_date")).first()[0]
    table.replace_all(sales.filter(F.col("order_date") < last))
    table.append(sales.filter(F.col("order_date") == last))
    return table.read().groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("quantity").alias("units"),
        F.sum(F.col("revenue_usd").cast("decimal(18,2)")).cast("double").alias("revenue_usd"))


# --- quality ---------------------------------------------------------------------------------

_GOLD: dict[str, Callable[[DerivedFeeds], DataFrame]] = {
    "dim_channel": _channels,
    "dim_product": _products,
    "dim_date": lambda f: gold.dim_date(_sale_days(f)),
    "fct_sales": lambda f: stored(f.once(_fct_sales), "fct-sales"),
    "fct_settlement": lambda f: stored(f.once(_fct_settlement), "fct-settlement"),
    "mart_reconciliation": lambda f: gold.mart_reconciliation(
        _gold(f)["fct_sales"], _gold(f)["fct_settlement"]),
    "agg_channel_daily": lambda f: gold.agg_channel_daily(
        _gold(f)["fct_sales"], f.once(_dimensions)["channels"]),
}


class _OnDemand(Mapping):
    """Gold tables that are planned, and facts stored, only when a check asks for them."""

    def __init__(self, feeds: DerivedFeeds):
        self._feeds = feeds

    def __getitem__(self, name: str) -> DataFrame:
        return self._feeds.once(_GOLD[name])

    def __iter__(self):
        return iter(_GOLD)

    def __len__(self) -> int:
        return len(_GOLD)


def _gold(f: DerivedFeeds) -> Mapping[str, DataFrame]:
    return f.once(_OnDemand)


@_query
def dq_not_null(f: DerivedFeeds) -> DataFrame:
    return quality.not_null(_gold(f))


@_query
def dq_unique(f: DerivedFeeds) -> DataFrame:
    return quality.unique(_gold(f))


@_query
def dq_relationships(f: DerivedFeeds) -> DataFrame:
    return quality.relationships(_gold(f))


@_query
def dq_amounts(f: DerivedFeeds) -> DataFrame:
    return quality.amounts(_gold(f))


@_query
def dq_non_empty(f: DerivedFeeds) -> DataFrame:
    return quality.non_empty(_gold(f))


@_query
def dq_orphans(f: DerivedFeeds) -> DataFrame:
    return quality.orphans(_gold(f))


@_query
def dq_current_version(f: DerivedFeeds) -> DataFrame:
    return quality.one_current_version(_gold(f))


@_query
def dq_gap_tolerance(f: DerivedFeeds) -> DataFrame:
    return quality.gap_tolerance(_gold(f))


@_query
def dq_gap_breaches(f: DerivedFeeds) -> DataFrame:
    return quality.gap_breaches(f.once(_reconciliation))


def _finished_run(f: DerivedFeeds) -> Lake:
    lake = _fill_raw(f, _new_lake(f, "run"))
    daily_run.daily_run(lake, FIRST_SNAPSHOT, gate=False)
    return lake


@_query
def gate_report(f: DerivedFeeds) -> DataFrame:
    """All checks over the tables of a complete stored run."""
    return quality.full_report(daily_run.gold_tables(_finished_run(f)))


@_query
def gate_incremental(f: DerivedFeeds) -> DataFrame:
    """The same checks by profiles, after the last day came on top of a gated run."""
    lake = f.once(_finished_run)
    refresh_timing.hold_back_last_day(lake)
    daily_run.build_marts(lake)
    gate.report(lake)
    daily_run.refresh_fct_sales(lake)
    daily_run.build_marts(lake)
    return gate.report(lake)


def _published(f: DerivedFeeds) -> Lake:
    lake = _new_lake(f, "serving")
    lake.day_table("gold", "agg_channel_daily").replace_all(_gold(f)["agg_channel_daily"])
    lake.day_table("gold", "mart_reconciliation").replace_all(gold.mart_reconciliation(
        _gold(f)["fct_sales"], f.once(_fct_settlement)))
    publish.publish(lake)
    return lake


@_query
def serving_parity(f: DerivedFeeds) -> DataFrame:
    return publish.parity(_published(f))


@_query
def publish_serving(f: DerivedFeeds) -> DataFrame:
    """The served rollup, read back."""
    return _published(f).read("serving", "agg_channel_daily")


# --- streaming -------------------------------------------------------------------------------

def _wave(f: DerivedFeeds, first: Column) -> list[DataFrame]:
    messages = f.order_messages()
    return [messages.filter(first).drop("seq"), messages.filter(~first).drop("seq")]


def _early(f: DerivedFeeds) -> Column:
    """The first five eighths of the events."""
    last = f.table("events").select(F.max("event_id")).scalar()
    return F.col("seq") * 8 < last * 5


def _drain_landing(f: DerivedFeeds, root: str) -> str:
    live.start_landing(from_files(f.spark, f"{root}/topic"), f"{root}/orders",
                       f"{root}/checkpoint").awaitTermination()
    return f"{root}/orders"


def _landed(f: DerivedFeeds) -> DataFrame:
    """Two arrivals, a drain after each, and one more drain with nothing new."""
    root = run_folder(f.spark, "stream")
    for wave in _wave(f, _early(f)):
        wave.write.mode("append").parquet(f"{root}/topic")
        _drain_landing(f, root)
    return f.spark.read.parquet(_drain_landing(f, root))


@_query
def stream_bronze(f: DerivedFeeds) -> DataFrame:
    return _landed(f).drop("_ingested_at")


@_query
def stream_distinct_ids(f: DerivedFeeds) -> DataFrame:
    return _landed(f).agg(F.count(F.lit(1)).alias("events"),
                          F.count_distinct("event_id").alias("distinct_ids"))


@_query
def stream_offset_runs(f: DerivedFeeds) -> DataFrame:
    """Runs of landed offsets, one a partition: nothing was lost and nothing landed twice."""
    return continuity.offset_runs(_landed(f))


@_query
def stream_offset_faults(f: DerivedFeeds) -> DataFrame:
    """Runs of offsets after every 101st message was lost and every 103rd landed twice."""
    events = _landed(f).select("kafka_partition", "kafka_offset")
    kept = events.filter("kafka_offset % 101 <> 7")
    return continuity.offset_runs(kept.unionAll(kept.filter("kafka_offset % 103 = 5")))


@_query
def conform_stream_orders(f: DerivedFeeds) -> DataFrame:
    return conform.conform_events(_landed(f), f.once(_references))


@_query
def silver_both_lanes(f: DerivedFeeds) -> DataFrame:
    """Silver sales of a run that takes in the landed events of the live lane."""
    lake = _fill_raw(f, _new_lake(f, "lanes"))
    daily_run.land_bronze(lake)
    f.order_messages().drop("seq").write.parquet(f"{lake.root}/topic")
    live.start_landing(from_files(f.spark, f"{lake.root}/topic"), lake.events_path(),
                       f"{lake.root}/checkpoint").awaitTermination()
    daily_run.build_silver(lake, with_stream=True)
    return lake.silver_sales()


def _drain_aggregate(f: DerivedFeeds, root: str, checkpoint: str) -> live.AggregateRun:
    table = f"{root}/orders_1m"
    live.ensure_live_table(f.spark, table)
    return live.drain_live_aggregate(
        from_files(f.spark, f"{root}/topic"), f"{root}/{checkpoint}", live.table_upserter(table),
        lambda: live.orders_in(live.live_table(f.spark, table)))


def _aggregated(f: DerivedFeeds, first: Column) -> tuple[str, list[live.AggregateRun]]:
    root = run_folder(f.spark, "stream")
    runs = []
    for wave in _wave(f, first):
        wave.write.mode("append").parquet(f"{root}/topic")
        runs.append(_drain_aggregate(f, root, "checkpoint"))
    return root, runs


def _live(f: DerivedFeeds, root: str) -> DataFrame:
    return live.live_table(f.spark, f"{root}/orders_1m").drop("updated_at", "window_date")


@_query
def stream_orders_1m(f: DerivedFeeds) -> DataFrame:
    return _live(f, _aggregated(f, _early(f))[0])


@_query
def stream_late_drop(f: DerivedFeeds) -> DataFrame:
    """Every seventh early event arrives with the second wave: mostly beyond the watermark."""
    return _live(f, _aggregated(f, _early(f) & (F.col("seq") % 7 != 3))[0])


@_query
def stream_late_count(f: DerivedFeeds) -> DataFrame:
    """Per run: events with a time, those counted in a minute, and those that came too late."""
    _, runs = _aggregated(f, _early(f) & (F.col("seq") % 7 != 3))
    return f.spark.createDataFrame(
        [(n, run.arrived, run.counted, run.late) for n, run in enumerate(runs, 1)],
        "run int, arrived bigint, counted bigint, late bigint")


@_query
def stream_rerun_idempotent(f: DerivedFeeds) -> DataFrame:
    """Drain again with nothing new, then replay everything under a new checkpoint."""
    root, _ = _aggregated(f, _early(f))
    _drain_aggregate(f, root, "checkpoint")
    _drain_aggregate(f, root, "replay")
    return _live(f, root).agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_distinct("window_start", "channel").alias("distinct_windows"),
        F.sum("orders").alias("orders"), F.sum("units").alias("units"))
