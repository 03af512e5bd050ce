"""Jobs from the command line, in the running session."""

from __future__ import annotations

import pytest
from test_daily_run import FIRST, fill
from test_streaming import Lane, event

from tradewake.__main__ import main
from tradewake.operators.quality import GateFailure
from tradewake.sources.lake import Lake
from tradewake.streaming import orders as live


def test_stages_one_by_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    fill(lake)
    for job in ("bronze", "silver", "snapshot", "gold", "publish", "verify"):
        main([job, "--data-dir", str(tmp_path), "--snapshot-ts", FIRST])
    assert lake.read("serving", "mart_reconciliation").count() == 2
    lake.read("gold", "mart_reconciliation").limit(1).write.mode("overwrite") \
        .parquet(lake.path("serving", "mart_reconciliation"))
    with pytest.raises(GateFailure):
        main(["verify", "--data-dir", str(tmp_path)])


def test_streams_drain_a_folder(spark, tmp_path):
    lane = Lane(spark, tmp_path)
    lane.send(event(0, 1), event(1, 2))
    for job in ("stream-land", "stream-aggregate"):
        main([job, "--data-dir", str(tmp_path / "lake"), "--topic", lane.topic])
    lake = Lake(spark, str(tmp_path / "lake"))
    assert spark.read.parquet(f"{lake.root}/bronze_stream/orders").count() == 2
    assert live.live_table(spark, lake.path("serving", "orders_stream_1m")).count() == 2
