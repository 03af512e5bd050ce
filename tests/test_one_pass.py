"""Costly inputs of day tables are computed once: dealing rows to files goes through its input twice."""

from __future__ import annotations

from threading import Barrier

import pytest

from tradewake.operators.lookups import Lookup
from tradewake.plans.gate import Profile
from tradewake.registry.queries import registered
from tradewake.session import together
from tradewake.sources import day_table
from tradewake.sources.day_table import DayTable
from tradewake.sources.lake import Lake

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def plans(monkeypatch):
    """Optimized plans of everything that is written to day tables."""
    seen, write = [], DayTable._write_data

    def recorded(self, frame, **how):
        seen.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return write(self, frame, **how)
    monkeypatch.setattr(DayTable, "_write_data", recorded)
    return seen


@pytest.mark.parametrize("name", ["incremental_lookback", "incremental_equals_full", "publish_serving",
                                  "serving_parity", "append_delta_day", "incremental_settlement"])
def test_feeds_are_conformed_once(spark, plans, name):
    result = registered()[name](spark, SMALL)
    plans.append(result._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) > 1 and not any("o_orderdate" in plan for plan in plans)


def test_a_delta_too_large_to_broadcast_is_joined_once(spark, plans, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(day_table, "SMALL_ROWS", 10)
    monkeypatch.setattr(day_table, "measured", lambda frame: Lookup(frame, False))
    table = DayTable(spark, str(tmp_path / "facts"), "d", "k", ("k",))
    day = "date_add(date'2024-01-01', cast(id / 10 as int)) d"
    table.replace_all(spark.range(200).selectExpr("concat('K', id) k", day, "cast(id as int) v"))
    table.replace_keys(spark.range(50, 300).selectExpr("concat('K', id) k", day, "-1 v"))
    assert "Join" not in plans[-1]
    assert rows(table.read(), "v", "k") == sorted(
        [(i, f"K{i}") for i in range(50)] + [(-1, f"K{i}") for i in range(50, 300)],
        key=lambda r: (str(r[0]), r[1]))


def test_a_daily_run_conforms_and_reconciles_once(spark, monkeypatch):
    """gate_incremental (F6): Silver and the full reconciliation are dealt to files from stored rows."""
    seen, replace_all = {}, DayTable.replace_all

    def recorded(self, frame, *sources):
        seen["/".join(self.path.split("/")[-2:])] = frame._jdf.queryExecution().optimizedPlan().toString()
        return replace_all(self, frame, *sources)
    monkeypatch.setattr(DayTable, "replace_all", recorded)
    registered()["gate_incremental"](spark, SMALL)
    for name in ("silver/sales", "silver/settlements", "gold/mart_reconciliation"):
        assert "Join" not in seen[name]


def test_uses_are_shuffled_once_unless_a_file_was_profiled_twice(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    table = lake.day_table("gold", "fct_sales")
    table.replace_all(spark.range(50).selectExpr(
        "concat('K', id) order_id", "date'2024-01-01' order_date", "cast(id % 3 as string) channel_sk",
        "if(id % 5 = 0, null, cast(id % 7 as string)) product_sk", "cast(id as double) revenue_usd"))
    profile = Profile(lake, "fct_sales")
    assert profile.update() == len(table.manifest().data)
    found = profile._kept("uses", list(table.manifest().data))
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    once = rows(profile.uses())
    spark.read.parquet(f"{profile.path}/uses").coalesce(1).write.parquet(str(tmp_path / "again"))
    spark.read.parquet(str(tmp_path / "again")).write.mode("append").parquet(f"{profile.path}/uses")
    assert rows(profile.uses()) == once and sum(r[-1] for r in once) == 50


def test_independent_steps_run_at_once_and_the_first_failure_is_raised(spark):
    met = Barrier(2, timeout=20)
    assert together(spark, lambda: met.wait() >= 0, lambda: met.wait() >= 0) == [True, True]
    done = []

    def fails(error):
        raise error
    with pytest.raises(KeyError):
        together(spark, lambda: fails(KeyError()), lambda: fails(ValueError()), lambda: done.append(1))
    assert done == [1] and together(spark) == []
