"""The whole run on a few days of data, stored zone by zone."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradewake.operators import quality
from tradewake.plans import daily_run, gate, publish, refresh_timing
from tradewake.schemas import RAW_SCHEMAS
from tradewake.sources.lake import Lake

FIRST, SECOND = "2024-01-01 00:00:00", "2024-02-01 00:00:00"

RAW = {
    "sales_amazon": [
        ("111-1", "B01", 2, 10.0, "USD", "Shipped", "2024/01/01"),
        ("111-2", "B02", 1, 5.0, "USD", "Returned", "2024/01/02")],
    "sales_backmarket": [("BM-1", "SKU1", 1, 100.0, "EUR", 3, "02-01-2024")],
    "settlements_oms": [
        ("STL-1", "amazon", "111-1", 20.0, 3.0, 2.0, 15.0, "USD", 1704240000),
        ("STL-2", "backmarket", "BM-1", 100.0, 12.0, 3.0, 85.0, "EUR", 1704240000)],
    "ref_sku_map": [("amazon", "B01", 1), ("amazon", "B02", 2), ("backmarket", "SKU1", 1)],
    "ref_product": [(1, "m", "b", "A", 1.0, 10.0), (2, "m", "b", "A", 1.0, 5.0)],
    "ref_fx": [(f"2024-01-0{d}", c, r) for d in (1, 2, 3)
               for c, r in (("USD", 1.0), ("EUR", 1.08 if d < 3 else 1.09))],
    "ref_status_map": [("amazon", "Shipped", "SHIPPED"), ("amazon", "Returned", "RETURNED"),
                       ("backmarket", "3", "DELIVERED")],
}


def fill(lake, **changes):
    for entity, data in {**RAW, **changes}.items():
        lake.spark.createDataFrame(data, RAW_SCHEMAS[entity]).write.mode("overwrite") \
            .parquet(lake.path("raw", entity))


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, str(tmp_path))
    fill(made)
    return made


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    made = Lake(spark, str(tmp_path_factory.mktemp("finished")))
    fill(made)
    landed = daily_run.daily_run(made, FIRST)
    assert landed.rows == {entity: len(data) for entity, data in RAW.items()}
    assert landed.skipped == []
    return made


def test_marts_of_a_run(finished, rows):
    recon = finished.read("gold", "mart_reconciliation")
    # EUR 85 + 15 at 1.09 against EUR 100 at 1.08: drift of one dollar.
    assert rows(recon, "order_id", "booked_usd", "net_received_usd", "gap_usd") == [
        ("111-1", 20.0, 15.0, 0.0), ("BM-1", 108.0, 92.65, -1.0)]
    assert "_loaded_at" in finished.read("bronze", "ref_fx").columns


def test_staging_views(finished, spark):
    finished.create_staging_views()
    total = spark.sql("SELECT sum(revenue_usd) FROM stg_sales WHERE order_date = '2024-01-02'")
    assert total.first()[0] == 113.0


def test_days_are_chosen_by_the_manifest(finished, rows):
    later = finished.silver_sales(after="2024-01-01")
    assert rows(later, "order_id") == [("111-2",), ("BM-1",)]
    assert finished.day_table("silver", "sales").days() == ("2024-01-01", "2024-01-02")
    assert finished.silver_sales(after="2024-01-02").inputFiles() == []


def test_short_copy_fails_verification(finished):
    publish.publish(finished)
    publish.verify(finished)
    short = finished.read("gold", "mart_reconciliation").filter("order_id <> 'BM-1'")
    short.write.mode("overwrite").parquet(finished.path("serving", "mart_reconciliation"))
    with pytest.raises(quality.GateFailure, match="mart_reconciliation: 1"):
        publish.verify(finished)


def test_rerun_changes_nothing(finished, rows):
    once = {t: rows(f) for t, f in daily_run.gold_tables(finished).items()}
    daily_run.daily_run(finished, FIRST)
    assert {t: rows(f) for t, f in daily_run.gold_tables(finished).items()} == once


def test_second_run_loads_the_new_day_and_keeps_old_product_keys(lake, rows):
    def keys():
        return dict(rows(lake.read("gold", "fct_sales"), "order_id", "product_sk"))

    daily_run.daily_run(lake, FIRST, gate=False)
    before = keys()
    fill(lake,
         sales_amazon=[*RAW["sales_amazon"],
                       ("111-3", "B01", 1, 11.0, "USD", "Shipped", "2024/01/03"),
                       ("111-4", "B01", 1, 11.0, "USD", "Shipped", "2024/01/01")],
         ref_product=[(1, "m", "b", "A", 1.0, 11.0), (2, "m", "b", "A", 1.0, 5.0)])
    daily_run.daily_run(lake, SECOND, gate=False)
    after = keys()
    assert set(after) == set(before) | {"111-3"}
    assert all(after[k] == before[k] for k in before) and after["111-3"] != after["111-1"]
    daily_run.refresh_fct_sales(lake, lookback_days=5)
    healed = keys()
    assert set(healed) == {*after, "111-4"} and healed["111-1"] == after["111-3"]


def test_timing_loads_the_last_day_without_rewriting_files(finished):
    timing = refresh_timing.time_refresh(finished)
    assert (timing.fact_rows, timing.delta_rows, timing.files_rewritten) == (3, 2, 0)


def test_second_gate_reads_new_files_only(lake, rows):
    """Old data files are unreadable by then; the report is still that of the whole tables."""
    daily_run.daily_run(lake, FIRST)
    sales = lake.day_table("gold", "fct_sales")
    assert [gate.Profile(lake, name).update() for name in gate.VERSIONED] == [0, 0, 0, 0]
    before = {f.name for f in sales.manifest().data}
    extra = sales.read().filter("order_id = '111-1'").withColumn("order_id", F.lit("111-9")) \
        .withColumn("order_date", F.lit("2024-01-09").cast("date")).withColumn("revenue_usd", F.lit(None).cast("double")).withColumn("channel_sk", F.lit("nowhere"))
    sales.replace_keys(extra)
    for name in before:
        Path(sales.path, "data", name).write_bytes(b"no parquet at all")
    assert gate.Profile(lake, "fct_sales").update() == 1
    failed = {(r["check"], r["subject"]): r["failing"] for r in gate.report(lake).filter("NOT passed").collect()}
    assert failed == {("not_null", "fct_sales.revenue_usd"): 1, ("amounts", "fct_sales.revenue_usd"): 1,
                      ("relationships", "fct_sales.channel_sk"): 1, ("orphans", "fct_sales.channel_sk"): 1}


def test_gate_by_profiles_finds_repeated_keys(lake, rows):
    daily_run.daily_run(lake, FIRST)
    sales = lake.day_table("gold", "fct_sales")
    sales.append(sales.read().filter("order_id = '111-2'"))
    for _ in range(2):  # a version with repeated keys is never the one to start from
        full = quality.full_report(daily_run.gold_tables(lake))
        assert rows(gate.report(lake)) == rows(full)
        assert rows(full.filter("NOT passed"), "check", "subject", "failing") == [("unique", "fct_sales.order_id", 1)]


def marts(lake, rows):
    return [rows(lake.read("gold", name)) for name in daily_run.MARTS]


def test_marts_follow_increments_in_any_order(lake, rows):
    """New days, late and corrected settlements, a status that leaves the mart: as a full rebuild."""
    daily_run.daily_run(lake, FIRST, gate=False)
    sales, settlements = (lake.day_table("gold", name) for name in daily_run.FACTS)
    first = {r["order_id"]: r for r in sales.read().collect()}

    def changed(table, **columns):
        frame = table.read().filter("order_id = '111-1'" if table is sales else "settlement_id = 'STL-2'")
        for name, value in columns.items():
            frame = frame.withColumn(name, F.lit(value).cast(frame.schema[name].dataType))
        return frame

    steps = [
        lambda: settlements.replace_keys(changed(settlements, settlement_id="STL-9", order_ref="111-1", net_usd=1.0)),
        lambda: settlements.replace_keys(changed(settlements, order_ref="111-2", payout_date="2024-02-01")),
        lambda: sales.replace_keys(changed(sales, order_id="111-7", order_date="2024-01-09", revenue_usd=9.0)),
        lambda: sales.replace_keys(changed(sales, is_settleable=False)),
        lambda: sales.replace_keys(changed(sales, order_date="2024-01-02", is_settleable=True)),
    ]
    for number, step in enumerate(steps):
        step()
        if number != 1:  # once two increments come together
            assert daily_run.build_marts(lake) is not None
            found = marts(lake, rows)
            daily_run.build_marts(lake, full_refresh=True)
            assert marts(lake, rows) == found
    assert len(first) == 3 and daily_run.build_marts(lake).days == set()


def test_rows_without_order_id_rebuild_the_marts(lake, rows):
    daily_run.daily_run(lake, FIRST, gate=False)
    sales = lake.day_table("gold", "fct_sales")
    sales.replace_keys(sales.read().limit(1).withColumn("order_id", F.lit(None).cast("string")))
    assert daily_run.build_marts(lake) is None
    assert lake.read("gold", "mart_reconciliation").filter("order_id IS NULL").count() in (0, 1)


def test_live_orders_fill_in_what_the_feeds_lack(lake, rows):
    """The feed's row wins over events of its order; of several events the last one counts."""
    stamp = datetime(2024, 1, 2, 10)
    events = [("e1", "111-1", 9, stamp, 0), ("e2", "L-1", 1, stamp, 1),
              ("e3", "L-1", 5, stamp + timedelta(hours=1), 2), ("e4", None, 1, stamp, 3)]
    lake.spark.createDataFrame(
        [(0, n, when, e, order, "amazon", "B01", qty, 10.0, "USD", "Shipped", when, when.date())
         for e, order, qty, when, n in events],
        "kafka_partition int, kafka_offset long, kafka_ts timestamp, event_id string, "
        "order_id string, channel string, sku string, qty int, unit_price double, "
        "currency string, status string, event_ts timestamp, event_date date") \
        .write.parquet(lake.events_path())
    daily_run.land_bronze(lake)
    daily_run.build_silver(lake)
    assert rows(lake.silver_sales(), "order_id") == [("111-1",), ("111-2",), ("BM-1",)]
    daily_run.build_silver(lake, with_stream=True)
    assert rows(lake.silver_sales(), "order_id", "quantity", "revenue_usd") == [
        ("111-1", 2, 20.0), ("111-2", 1, 5.0), ("BM-1", 1, 108.0), ("L-1", 5, 50.0)]


def test_missing_feed_is_skipped_with_a_report(spark, tmp_path):
    empty = Lake(spark, str(tmp_path))
    fx = spark.createDataFrame(RAW["ref_fx"], RAW_SCHEMAS["ref_fx"])
    fx.write.parquet(empty.path("raw", "ref_fx"))
    landed = daily_run.land_bronze(empty)
    assert landed.loaded == ["ref_fx"] and len(landed.skipped) == 6


def test_gate_names_every_failure(lake):
    fill(lake, ref_fx=[r for r in RAW["ref_fx"] if r[0] != "2024-01-02"], settlements_oms=[
        ("STL-1", "amazon", "111-1", 20.0, 3.0, 2.0, 1.0, "USD", 1704240000)])
    with pytest.raises(quality.GateFailure) as failure:
        daily_run.daily_run(lake, FIRST)
    assert "not_null fct_sales.revenue_usd: 2" in str(failure.value)
    assert "gap_tolerance mart_reconciliation.gap_usd: 1" in str(failure.value)
