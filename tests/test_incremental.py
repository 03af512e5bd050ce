"""Deltas, keyed upserts and lookups on frames."""

from __future__ import annotations

from datetime import date
from tradewake.operators import incremental
from tradewake.operators.lookups import measure

SCHEMA = "k string, d date, v int"


def day(n):
    return date(2024, 1, n)


def test_strict_skips_late_rows_and_lookback_loads_them(spark, rows):
    source = spark.createDataFrame(
        [("a", day(5), 1), ("late", day(4), 1), ("old", day(1), 1), ("new", day(6), 1)], SCHEMA)
    assert rows(incremental.delta_strict(source, "2024-01-05", "d"), "k") == [("new",)]
    assert rows(incremental.delta_lookback(source, "2024-01-05", "d", 1), "k") == [
        ("a",), ("late",), ("new",)]


def test_empty_target_loads_nothing_strictly_and_everything_with_lookback(spark, rows):
    source = spark.createDataFrame([("a", day(5), 1)], SCHEMA)
    assert rows(incremental.delta_strict(source, None, "d")) == []
    assert rows(incremental.delta_lookback(source, None, "d", 1), "k") == [("a",)]


def test_upsert_replaces_by_composite_key_including_null(spark, rows):
    schema = "k string, w int, v int"
    target = spark.createDataFrame([("a", 1, 1), (None, 1, 1), ("a", 2, 1)], schema)
    changes = spark.createDataFrame([("a", 1, 9), (None, 1, 9), ("b", 1, 9)], schema)
    assert rows(incremental.upsert(target, changes, ["k", "w"])) == [
        (None, 1, 9), ("a", 1, 9), ("a", 2, 1), ("b", 1, 9)]


def test_lookup_beyond_the_budget_is_never_broadcast(spark, rows):
    """Spark's own estimate of such a small frame is far below its threshold."""
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    lookup = measure({"l": spark.sql("SELECT * FROM VALUES ('a', 9), (NULL, 8) t(k, v)")}, budget=0)["l"]
    for joined, found in ((lookup.left_join(fact, "k"), [(None, None), ("a", 9), ("b", None)]),
                          (lookup.inner_join(fact, "k"), [("a", 9)])):
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows(joined, "k", "v") == found


def _skewed(spark):
    """A third of the rows share one key; the others are spread."""
    return spark.range(0, 300_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('k', id % 5000) end as k",
        "repeat(cast(id as string), 8) as pad")


def test_unbroadcast_lookup_splits_a_hot_key(spark, rows):
    """Beyond the budget the join is shuffled and the hot partition is processed in pieces."""
    lookup_rows = spark.range(5000).selectExpr("concat('k', id) as k", "id as v") \
        .union(spark.sql("SELECT 'hot', -1L"))
    tight = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k) for k in tight}
    for key, value in tight.items():
        spark.conf.set(key, value)
    try:
        lookup = measure({"l": lookup_rows}, budget=0)["l"]
        joined = lookup.left_join(_skewed(spark), "k")
        counts = joined.selectExpr("v is null as lost", "k = 'hot' as hot")
        frame = counts.toPandas()
        assert not frame.lost.any() and frame.hot.sum() == 100_000 and len(frame) == 300_000
        joined.write.format("noop").mode("overwrite").save()
        qe = joined._jdf.queryExecution()
        joined._jdf.collectToPython()
        assert "skew=true" in qe.executedPlan().toString()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
