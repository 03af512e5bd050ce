"""The serving database: statements and their order, with connection and writer replaced."""

from __future__ import annotations

import pytest
from test_daily_run import FIRST, fill
from test_streaming import Lane, event

from tradewake.plans import daily_run, publish
from tradewake.sources.jdbc import Database, create_statement, upsert_statement
from tradewake.sources.lake import Lake
from tradewake.sources.messages import from_files
from tradewake.streaming import orders as live


class Log:
    """A database that remembers what was asked of it, and keeps written rows."""

    def __init__(self, spark, fails_on="nothing"):
        self.calls, self.tables, self.fails_on = [], {}, fails_on
        self.database = Database(spark, "jdbc:none", {}, lambda: self, self.write)

    def write(self, frame, table):
        self.calls.append(f"write {table.split('_stage_')[0]}")
        self.tables[table] = (frame.columns, [tuple(r) for r in frame.collect()])

    def execute(self, statement):
        self.calls.append(" ".join(statement.split()[:3]))
        if self.fails_on in statement:
            raise RuntimeError(f"no {self.fails_on}")

    def table_exists(self, table):
        return table in self.tables

    def commit(self):
        self.calls.append("commit")

    def rollback(self):
        self.calls.append("rollback")

    def close(self):
        self.calls.append("close")


def test_statements():
    assert upsert_statement("t", "s", ["a", "b", "c"], ["a", "b"]) == (
        "INSERT INTO t (a, b, c) SELECT a, b, c FROM s ON CONFLICT (a, b) DO UPDATE SET "
        "c = EXCLUDED.c")


def test_aggregate_is_created_staged_merged_and_cleaned_up(spark, tmp_path):
    lane, log = Lane(spark, tmp_path), Log(spark)
    lane.send(event(0, 1), event(1, 2))
    live.ensure_live_database(log.database)
    assert log.calls == ["CREATE TABLE IF", "commit", "close"]
    log.calls.clear()
    live.start_live_aggregate(
        from_files(spark, lane.topic), str(tmp_path / "ck"),
        log.database.upserter(live.DATABASE_TABLE, live.LIVE_KEY)).awaitTermination()
    assert log.calls == ["write orders_stream_1m", "INSERT INTO orders_stream_1m", "commit", "close",
                         "DROP TABLE IF", "commit", "close"]
    columns, rows = next(iter(log.tables.values()))
    assert columns == ["window_start", "window_end", "channel", "orders", "units", "updated_at"]
    assert len(rows) == 2 and all(r[-1] is not None for r in rows)


def test_failed_merge_still_drops_its_staging_table(spark):
    log = Log(spark, fails_on="INSERT")
    write = log.database.upserter("t", ["id"])
    with pytest.raises(RuntimeError, match="no INSERT"):
        write(spark.range(2), 0)
    assert log.calls == ["write t", "INSERT INTO t", "rollback", "close", "DROP TABLE IF", "commit",
                         "close"]
    log.calls.clear()
    write(spark.range(0), 1)
    assert log.calls == []


def test_live_table_in_the_database_has_a_key(spark):
    from pyspark.sql.types import StructType
    assert create_statement("t", StructType.fromDDL("a timestamp, b string, c bigint"), ["a", "b"]) \
        == "CREATE TABLE IF NOT EXISTS t (a TIMESTAMP, b TEXT, c BIGINT, PRIMARY KEY (a, b))"


def test_marts_are_published_and_verified(spark, tmp_path, monkeypatch):
    lake, log = Lake(spark, str(tmp_path)), Log(spark)
    fill(lake)
    daily_run.daily_run(lake, FIRST)
    assert [r["passed"] for r in publish.parity(lake, log.database).collect()] == [False, False]
    publish.publish(lake, log.database)
    assert sorted(log.tables) == ["agg_channel_daily", "mart_reconciliation"]

    def read(_database, table):
        return lake.read("gold", table).limit(len(log.tables[table][1]))

    monkeypatch.setattr(Database, "read", read)
    publish.verify(lake, log.database)
    log.tables["mart_reconciliation"][1].pop()
    with pytest.raises(Exception, match="mart_reconciliation: 1"):
        publish.verify(lake, log.database)
