"""Facts, marts and checks on hand-made rows."""

from __future__ import annotations

from datetime import date

import pytest

from tradewake.operators import quality
from tradewake.operators.lookups import measured
from tradewake.plans import gold

DAY = date(2026, 6, 29)
FACT = ("order_id string, source string, order_date date, canonical_status string, "
        "revenue_usd double, is_settleable boolean, is_returned boolean, channel_sk string, "
        "quantity int")
SETTLED = "settlement_id string, order_ref string, net_usd double, fees_usd double"


@pytest.fixture
def recon(spark):
    sales = spark.createDataFrame([
        ("A", "amazon", DAY, "SHIPPED", 100.0, True, False, "k", 1),
        ("B", "amazon", DAY, "DELIVERED", 50.0, True, False, "k", 1),
        ("C", "amazon", DAY, "DELIVERED", 100.0, True, False, "k", 1),
        ("D", "amazon", DAY, "DELIVERED", 100.0, True, False, "k", 1),
        ("E", "amazon", DAY, "DELIVERED", None, True, False, "k", 1),
        ("F", "amazon", DAY, "PENDING", 10.0, False, False, "k", 1),
        ("G", "amazon", DAY, None, 10.0, None, None, "k", 1)], FACT)
    settled = spark.createDataFrame([
        ("1", "A", 60.0, 0.0), ("2", "A", 30.0, 10.0), ("3", "C", 90.0, 5.0),
        ("4", "D", 90.0, 4.99), ("5", "E", 1.0, 1.0), ("6", "Z", 1.0, 1.0)], SETTLED)
    return gold.mart_reconciliation(sales, settled)


def test_reconciliation(recon, rows):
    assert rows(recon, "order_id", "booked_usd", "net_received_usd", "fees_usd", "is_settled",
                "gap_usd") == [
        ("A", 100.0, 90.0, 10.0, True, 0.0),
        ("B", 50.0, None, None, False, 50.0),
        ("C", 100.0, 90.0, 5.0, True, 5.0),
        ("D", 100.0, 90.0, 4.99, True, 5.01),
        ("E", None, 1.0, 1.0, True, None)]


def test_tolerance_is_strict_and_passes_unknown_gaps(recon, rows):
    assert rows(quality.gap_breaches(recon), "order_id") == [("D",)]


def test_rollup_counts_unknown_status_as_not_returned(spark, rows):
    sales = spark.createDataFrame([
        ("A", "amazon", DAY, "RETURNED", 1.1, False, True, "k", 2),
        ("B", "amazon", DAY, None, 2.2, None, None, "k", 1),
        ("C", "amazon", DAY, "SHIPPED", None, True, False, "k", 1),
        ("D", "amazon", DAY, "SHIPPED", 9.0, True, False, None, 1)], FACT)
    channels = measured(spark.createDataFrame(
        [("k", "amazon", "Amazon", 0.15)],
        "channel_sk string, channel string, channel_name string, fee_rate double"))
    assert rows(gold.agg_channel_daily(sales, channels)) == [
        ("Amazon", DAY, 3, 4, 3.3, 1, 33.33)]


def test_unknown_channel_keeps_its_name(spark, rows):
    sales = spark.createDataFrame([("shopx",), ("amazon",)], "source string")
    assert rows(gold.dim_channel(sales), "channel", "channel_name", "fee_rate") == [
        ("amazon", "Amazon", 0.15), ("shopx", "shopx", None)]


def test_date_dimension_of_no_sales_is_empty(spark):
    assert gold.dim_date(spark.createDataFrame([], "order_date date")).count() == 0


def test_fact_keeps_unmatched_rows_and_null_flags(spark, rows):
    sales = spark.createDataFrame(
        [("A", "amazon", 1, 1, 1.0, "SHIPPED", DAY, 1.0),
         ("B", "nowhere", None, 1, 1.0, None, DAY, 1.0)],
        "order_id string, source string, product_id long, quantity int, unit_price double, "
        "canonical_status string, order_date date, revenue_usd double")
    channels = measured(spark.createDataFrame([("amazon", "k")], "channel string, "
                                              "channel_sk string"))
    products = measured(spark.createDataFrame([(1, "p")], "product_id long, product_sk string"))
    assert rows(gold.fct_sales(sales, channels, products), "order_id", "channel_sk",
                "product_sk", "is_returned", "is_settleable") == [
        ("A", "k", "p", False, True), ("B", None, None, None, None)]


def test_checks_find_orphans_nulls_and_lost_references(spark, rows):
    tables = {
        "fct_sales": spark.createDataFrame(
            [("A", "k", "p"), ("A", "x", None), ("C", None, "q")],
            "order_id string, channel_sk string, product_sk string"),
        "dim_channel": spark.createDataFrame([("k",)], "channel_sk string"),
        "dim_product": spark.createDataFrame(
            [("p", 1, True), ("r", 1, True)], "product_sk string, product_id int, "
            "is_current boolean")}
    assert rows(quality.orphans(tables), "failing", "passed") == [(2, False)]
    assert rows(quality.one_current_version(tables), "failing", "passed") == [(1, False)]
    assert rows(quality.not_null(tables, {"fct_sales": ("order_id", "channel_sk")}),
                "subject", "failing") == [("fct_sales.channel_sk", 1), ("fct_sales.order_id", 0)]
    links = (("fct_sales", "channel_sk", "dim_channel"), ("fct_sales", "product_sk",
                                                          "dim_product"))
    assert rows(quality.relationships(tables, links), "subject", "failing") == [
        ("fct_sales.channel_sk", 1), ("fct_sales.product_sk", 1)]
    with pytest.raises(quality.GateFailure, match="orphans fct_sales.channel_sk: 2"):
        quality.enforce(quality.orphans(tables))


def test_amounts_that_sums_would_leave_out_are_reported(spark, rows):
    tables = {"fct_settlement": spark.createDataFrame(
        [(1.0, 1.0, 1.0), (1e17, None, 1.0), (1.0, float("nan"), 1.0)],
        "gross_usd double, fees_usd double, net_usd double")}
    only = {"fct_settlement": quality.AMOUNTS["fct_settlement"]}
    assert rows(quality.amounts(tables, only), "subject", "failing") == [
        ("fct_settlement.fees_usd", 2), ("fct_settlement.gross_usd", 1),
        ("fct_settlement.net_usd", 0)]


def test_join_of_a_hot_order_id_is_split(spark):
    """One id holds a hundredth of the rows; small limits stand for many rows a task."""
    limits = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
              "spark.sql.shuffle.partitions": "200", "spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        sales = spark.range(0, 60_000, 1, 24).selectExpr(
            "if(id % 100 = 0, 'hot', concat('k', id)) order_id", "md5(string(id)) source",
            "date'2024-01-01' order_date", "sha1(string(id)) canonical_status",
            "id * 1.37D revenue_usd", "true is_settleable")
        settled = spark.range(0, 60_000, 1, 4).selectExpr(
            "concat('k', id) order_ref", "1.0D net_usd", "0.0D fees_usd")
        joined = gold.mart_reconciliation(sales, settled)
        qe = joined._jdf.queryExecution()
        assert len(joined.select("order_id").collect()) == 60_000
        joined.collect()
        assert "skew=true" in qe.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sums_of_the_reconciliation_are_not_broadcast(recon):
    """However few they are: Spark judges them by their compressed file, the driver holds them as a table."""
    assert "Broadcast" not in recon._jdf.queryExecution().executedPlan().toString()


def test_gate_reads_the_sales_fact_three_times(spark, tmp_path):
    from test_daily_run import FIRST, fill

    from tradewake.plans import daily_run
    from tradewake.sources.lake import Lake
    lake = Lake(spark, str(tmp_path))
    fill(lake)
    daily_run.daily_run(lake, FIRST, gate=False)
    seen = []

    class Counting(dict):
        def __getitem__(self, name):
            seen.append(name)
            return super().__getitem__(name)

    report = quality.full_report(Counting(daily_run.gold_tables(lake)))
    assert seen.count("fct_sales") == 3
    assert report.filter("NOT passed").isEmpty()


def test_parity_reports_missing_empty_and_short_copies(spark, rows):
    two = spark.range(2)
    report = quality.served_parity(
        {"good": two, "short": two, "empty": spark.range(0), "missing": two},
        {"good": spark.range(2), "short": spark.range(1), "empty": spark.range(0)})
    assert rows(report, "subject", "served_rows", "passed") == [
        ("empty", 0, False), ("good", 2, True), ("missing", -1, False), ("short", 1, False)]
