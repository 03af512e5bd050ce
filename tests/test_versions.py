"""Versioned products: single steps, long histories, stored tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewake.operators import scd2, snapshot_table
from tradewake.operators.lookups import measured
from tradewake.plans import gold
from tradewake.schemas import RAW_SCHEMAS

T = [f"2024-0{m}-01 00:00:00" for m in range(1, 8)]
WHEN = [datetime(2024, m, 1) for m in range(1, 8)]


def source(spark, *products):
    return spark.createDataFrame(
        [(i, "model", brand, grade, 1.0, price) for i, brand, grade, price in products],
        RAW_SCHEMAS["ref_product"])


def at(text):
    return F.lit(text).cast("timestamp")


def history(spark, sources, stamps=T):
    versions = scd2.first_versions(sources[0], at(stamps[0]))
    for frame, stamp in zip(sources[1:], stamps[1:], strict=False):
        versions = scd2.merge_snapshot(versions, frame, at(stamp))
    return versions


def test_price_there_and_back(spark, rows):
    versions = history(spark, [source(spark, (1, "b", "A", p)) for p in (10.0, 12.0, 10.0)])
    assert rows(versions, "list_price", "valid_from", "valid_to") == [
        (10.0, WHEN[0], WHEN[1]), (10.0, WHEN[2], None), (12.0, WHEN[1], WHEN[2])]


def test_untracked_column_opens_nothing_and_keeps_the_old_value(spark, rows):
    versions = history(spark, [source(spark, (1, "old", "A", 10.0)),
                               source(spark, (1, "new", "A", 10.0))])
    assert rows(versions, "brand", "valid_to") == [("old", None)]


def test_null_price_equals_null_price(spark, rows):
    versions = history(spark, [source(spark, (1, "b", None, None))] * 3)
    assert rows(versions, "valid_from", "valid_to") == [(WHEN[0], None)]


def test_key_vanishes_and_returns(spark, rows):
    versions = history(spark, [source(spark, (1, "b", "A", 10.0), (2, "b", "A", 5.0)),
                               source(spark, (2, "b", "A", 5.0)),
                               source(spark, (1, "b", "A", 10.0), (2, "b", "A", 5.0))])
    assert rows(versions, "product_id", "valid_from", "valid_to") == [
        (1, WHEN[0], WHEN[1]), (1, WHEN[2], None), (2, WHEN[0], None)]


snapshots = st.lists(
    st.dictionaries(st.integers(1, 4), st.tuples(st.sampled_from("AB"), st.sampled_from([1.0, 2.0])),
                    min_size=1), min_size=2, max_size=4)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshots)
def test_intervals_never_overlap_and_end_with_the_last_source(spark, data):
    frames = [source(spark, *[(k, "b", g, p) for k, (g, p) in day.items()]) for day in data]
    versions = [r.asDict() for r in history(spark, frames).collect()]
    by_key = {}
    for v in versions:
        by_key.setdefault(v["product_id"], []).append(v)
    for spans in by_key.values():
        spans.sort(key=lambda v: v["valid_from"])
        for earlier, later in zip(spans, spans[1:], strict=False):
            assert earlier["valid_to"] is not None
            assert earlier["valid_from"] < earlier["valid_to"] <= later["valid_from"]
    live = {v["product_id"]: (v["grade"], v["list_price"]) for v in versions
            if v["valid_to"] is None}
    assert live == data[-1]


def test_stored_history_equals_the_computed_one_and_repeats(spark, rows, tmp_path):
    frames = [source(spark, (1, "b", "A", 1.0), (2, "b", "A", 1.0)),
              source(spark, (1, "b", "A", 2.0), (3, "b", "A", 1.0)),
              source(spark, (1, "b", "B", 2.0), (2, "b", "A", 1.0))]
    path = str(tmp_path / "versions")
    for frame, stamp in zip(frames, T, strict=False):
        snapshot_table.take_snapshot(frame, path, stamp)
        once = rows(snapshot_table.read_versions(spark, path))
        snapshot_table.take_snapshot(frame, path, stamp)
        assert rows(snapshot_table.read_versions(spark, path)) == once
    assert once == rows(history(spark, frames))
    folders = {p.name for p in (tmp_path / "versions").iterdir() if p.is_dir()}
    assert folders == {"closed_at=open", "closed_at=20240201T000000.000000",
                       "closed_at=20240301T000000.000000"}


def test_rerun_with_a_corrected_source_replaces_the_versions_it_opened(spark, rows, tmp_path):
    path = str(tmp_path / "versions")
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0)), path, T[0])
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 7.0)), path, T[1])
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 2.0)), path, T[1])
    assert rows(snapshot_table.read_versions(spark, path), "list_price", "valid_from",
                "valid_to") == [(1.0, WHEN[0], WHEN[1]), (2.0, WHEN[1], None)]


def stored(spark, rows, path):
    return rows(snapshot_table.read_versions(spark, path), "product_id", "list_price", "valid_from",
                "valid_to")


def test_empty_source_closes_every_product(spark, rows, tmp_path):
    path = str(tmp_path / "versions")
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0), (2, "b", "A", 2.0)), path, T[0])
    snapshot_table.take_snapshot(source(spark).limit(0), path, T[1])
    closed = [(1, 1.0, WHEN[0], WHEN[1]), (2, 2.0, WHEN[0], WHEN[1])]
    assert stored(spark, rows, path) == closed
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0)), path, T[2])
    assert stored(spark, rows, path) == sorted(
        [*closed, (1, 1.0, WHEN[2], None)], key=lambda r: tuple(str(v) for v in r))


def test_first_snapshot_repeated_with_an_empty_source(spark, rows, tmp_path):
    path = str(tmp_path / "versions")
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0)), path, T[0])
    snapshot_table.take_snapshot(source(spark).limit(0), path, T[0])
    assert stored(spark, rows, path) == []
    snapshot_table.take_snapshot(source(spark).limit(0), path, T[0])
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0)), path, T[0])
    assert stored(spark, rows, path) == [(1, 1.0, WHEN[0], None)]


@pytest.mark.parametrize("wrong", [
    [(1, "b", "A", 9.0), (2, "b", "A", 2.0)], [(2, "b", "A", 2.0)], [],
    [(1, "b", "B", 1.0), (2, "b", "A", 8.0), (3, "b", "A", 3.0)]])
def test_repeat_with_the_right_source_equals_one_right_run(spark, rows, tmp_path, wrong):
    first, right = source(spark, (1, "b", "A", 1.0), (2, "b", "A", 2.0)), \
        source(spark, (1, "b", "A", 1.0), (2, "b", "A", 3.0))
    found = []
    for name, sources in (("once", [right]), ("again", [source(spark, *wrong).limit(9), right])):
        path = str(tmp_path / name)
        snapshot_table.take_snapshot(first, path, T[0])
        for frame in sources:
            snapshot_table.take_snapshot(frame, path, T[1])
        found.append(rows(snapshot_table.read_versions(spark, path)))
    assert found[0] == found[1]


def test_snapshot_cut_off_before_folders_are_dropped(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "versions")
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0)), path, T[0])
    with monkeypatch.context() as patch:
        patch.setattr(snapshot_table.files, "drop_partition", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            snapshot_table.take_snapshot(source(spark).limit(0), path, T[1])
    snapshot_table.take_snapshot(source(spark).limit(0), path, T[1])
    assert stored(spark, rows, path) == [(1, 1.0, WHEN[0], WHEN[1])]


def test_older_snapshot_is_refused(spark, tmp_path):
    path = str(tmp_path / "versions")
    snapshot_table.take_snapshot(source(spark, (1, "b", "A", 1.0)), path, T[1])
    with pytest.raises(ValueError):
        snapshot_table.take_snapshot(source(spark, (1, "b", "A", 2.0)), path, T[0])


@pytest.mark.parametrize("budget", [None, 0])
def test_asof_join_takes_the_version_of_the_day(spark, rows, budget):
    products = gold.dim_product(history(
        spark, [source(spark, (1, "b", "A", p)) for p in (10.0, 12.0)]))
    lookup = measured(products) if budget is None else measured(products, budget)
    facts = spark.createDataFrame(
        [("early", 1, "2023-12-31"), ("first", 1, "2024-01-01"), ("before", 1, "2024-01-31"),
         ("after", 1, "2024-02-01"), ("other", 9, "2024-02-01")],
        "order_id string, product_id long, d string").withColumn("order_date",
                                                                 F.to_date("d"))
    found = rows(scd2.asof_product_join(facts, lookup), "order_id", "asof_list_price")
    assert found == [("after", 12.0), ("before", 10.0), ("early", None), ("first", 10.0),
                     ("other", None)]


def test_asof_merge_like_the_join(spark, rows):
    """Many versions of a hot product, facts on boundaries, before the first, without product or day."""
    versions = spark.sql("""
        SELECT p AS product_id, timestamp'2020-01-01' + make_interval(0, 0, 0, CAST(7 * n AS int)) AS valid_from,
               IF(n < 99, timestamp'2020-01-01' + make_interval(0, 0, 0, CAST(7 * n + 7 - (n % 5) AS int)), NULL)
                   AS valid_to, CAST(n AS double) AS price
        FROM (SELECT id AS n FROM range(100)), (SELECT explode(array(1, 2, 3)) AS p)
        WHERE p = 1 OR n % 10 = p
        UNION ALL SELECT NULL, timestamp'2020-01-01', NULL, -1.0""")
    facts = spark.sql("""
        SELECT id AS price, IF(id % 3 = 0, 1, CAST(id % 5 AS int)) AS product_id,
               date_add(date'2019-12-01', CAST(id * 13 % 900 AS int)) AS sold FROM range(2000)
        UNION ALL SELECT -1, NULL, date'2020-05-05' UNION ALL SELECT -2, 1, NULL""")
    found = scd2.asof_merge(facts, versions, "product_id", "sold", span_days=11)
    assert found.columns == [*facts.columns, "version"]
    v = versions.select(F.col("product_id").alias("of"), "valid_from", "valid_to", F.col("price").alias("p"))
    at = F.col("sold").cast("timestamp")
    wanted = facts.join(v, (F.col("product_id") == F.col("of")) & (at >= F.col("valid_from"))
                        & (F.col("valid_to").isNull() | (at < F.col("valid_to"))), "left")
    assert rows(found.select("price", "product_id", "sold", F.col("version.price").alias("p"))) == \
        rows(wanted.select("price", "product_id", "sold", "p"))
    assert scd2.asof_merge(facts.limit(0), versions, "product_id", "sold").collect() == []
    none = scd2.asof_merge(facts, versions.limit(0), "product_id", "sold")
    assert none.count() == 2002 and none.filter("version IS NOT NULL").isEmpty()
