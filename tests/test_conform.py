"""Conforming on hand-made rows: odd dates, unknown codes, missing rates."""

from __future__ import annotations

from datetime import date

import pytest

from tradewake.operators import conform
from tradewake.schemas import RAW_SCHEMAS


def make(spark, entity, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS[entity])


@pytest.fixture
def refs(spark):
    return build_refs(spark)


def build_refs(spark, **options):
    return conform.references(
        make(spark, "ref_sku_map", [("amazon", "B01", 1), ("backmarket", "SKU1", 1)]),
        make(spark, "ref_status_map", [("amazon", "Shipped", "SHIPPED"),
                                       ("backmarket", "3", "DELIVERED")]),
        make(spark, "ref_fx", [("2026-06-29", "USD", 1.0), ("2026-06-29", "EUR", 1.0825),
                               ("2026-07-01", "EUR", 1.1), ("not a day", "EUR", 9.0)]),
        **options)


SALES_A = [
    ("111-1", "B01", 2, 10.10, "USD", "Shipped", "2026/06/29"),
    ("111-2", "B99", 1, 5.0, "USD", "Lost", "2026/06/29"),
    ("111-3", "B01", 1, 5.0, "USD", "Shipped", "2026/13/40"),
    ("111-4", "B01", 1, 5.0, "USD", "Shipped", "2026/06/30"),
    ("111-5", None, None, None, None, None, None),
]
EXPECTED_A = [
    ("111-1", 1, "SHIPPED", date(2026, 6, 29), 20.2),
    ("111-2", None, None, date(2026, 6, 29), 5.0),
    ("111-3", 1, "SHIPPED", None, None),
    ("111-4", 1, "SHIPPED", date(2026, 6, 30), None),
    ("111-5", None, None, None, None),
]
COLUMNS = ("order_id", "product_id", "canonical_status", "order_date", "revenue_usd")


def test_channel_a(spark, refs, rows):
    sales = conform.conform_channel(make(spark, "sales_amazon", SALES_A), conform.FEED_A, refs)
    assert rows(sales, *COLUMNS) == EXPECTED_A


def test_channel_b_matches_integer_codes_and_converts(spark, refs, rows):
    raw = make(spark, "sales_backmarket", [
        ("BM-1", "SKU1", 3, 7.77, "EUR", 3, "29-06-2026"),
        ("BM-2", "SKU1", 3, 7.77, "EUR", 9, "29-06-2026x")])
    sales = conform.conform_channel(raw, conform.FEED_B, refs)
    # 3 x 7.77 x 1.0825 = 25.233075
    assert rows(sales, *COLUMNS) == [
        ("BM-1", 1, "DELIVERED", date(2026, 6, 29), 25.23), ("BM-2", 1, None, None, None)]


def test_joins_without_broadcast_give_the_same(spark, rows):
    small = build_refs(spark)
    large = build_refs(spark, budget=0)
    assert small.sku_map.fits and not large.sku_map.fits
    raw = make(spark, "sales_amazon", SALES_A)
    sales = conform.conform_channel(raw, conform.FEED_A, large)
    assert rows(sales, *COLUMNS) == EXPECTED_A


def test_half_cents_round_away_from_zero(spark, refs, rows):
    raw = make(spark, "sales_amazon", [
        ("111-1", "B01", 1, 1.005, "USD", "Shipped", "2026/06/29"),
        ("111-2", "B01", 1, 2.675, "USD", "Shipped", "2026/06/29")])
    sales = conform.conform_channel(raw, conform.FEED_A, refs)
    assert rows(sales, "order_id", "revenue_usd") == [("111-1", 1.01), ("111-2", 2.68)]


def test_settlement_day_does_not_depend_on_the_session_zone(spark, refs, rows):
    raw = make(spark, "settlements_oms", [
        ("STL-1", "backmarket", "BM-1", 100.0, 12.0, 3.0, 85.0, "EUR", 1782864000),
        ("STL-2", "backmarket", "BM-2", 1.0, 0.0, 0.0, 1.0, "EUR", 1782864000 - 1)])
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        settled = rows(conform.conform_settlements(raw, refs.fx))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert settled == [
        ("STL-1", "backmarket", "BM-1", date(2026, 7, 1), 110.0, 16.5, 93.5),
        ("STL-2", "backmarket", "BM-2", date(2026, 6, 30), None, None, None)]


def test_one_row_per_product(spark, rows):
    raw = make(spark, "ref_product", [
        (1, "m", "b", "B", 1.0, 3.0), (1, "m", "b", "A", 9.0, 9.0), (2, "n", "b", "A", 1.0, 2.0)])
    assert rows(conform.conform_products(raw)) == [
        (1, "m", "b", "A", 9.0, 9.0), (2, "n", "b", "A", 1.0, 2.0)]


def test_duplicate_map_keys_fan_out_and_are_caught_by_the_gate(spark, refs, rows):
    from tradewake.operators import quality
    twice = conform.references(
        make(spark, "ref_sku_map", [("amazon", "B01", 1), ("amazon", "B01", 2)]),
        refs.status_map.frame, make(spark, "ref_fx", [("2026-06-29", "USD", 1.0)]))
    sales = conform.conform_channel(
        make(spark, "sales_amazon", SALES_A[:1]), conform.FEED_A, twice)
    report = quality.unique({"fct_sales": sales}, {"fct_sales": "order_id"})
    assert rows(report) == [("unique", "fct_sales.order_id", 1, False)]
