"""The live lane on a folder of message files."""

from __future__ import annotations

from datetime import datetime

import pytest

from tradewake.schemas import MESSAGE
from tradewake.sources.messages import from_files
from tradewake.streaming import continuity
from tradewake.streaming import orders as live


def event(offset, minute, second=0, channel="amazon", qty=1, payload=None):
    stamp = f"2024-01-01T12:{minute:02d}:{second:02d}+00:00"
    text = payload or (
        f'{{"event_id":"e{offset}","order_id":"o{offset}","channel":"{channel}","sku":"s",'
        f'"qty":{qty},"unit_price":2.5,"currency":"USD","status":"Shipped",'
        f'"event_ts":"{stamp}"}}')
    return (b"k", text.encode(), 0, offset, datetime(2024, 1, 1, 12))


@pytest.fixture
def lane(spark, tmp_path):
    return Lane(spark, tmp_path)


class Lane:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.topic, self.sink, self.table = (str(root / n) for n in ("topic", "sink", "live"))
        (root / "topic").mkdir()

    def send(self, *events):
        self.spark.createDataFrame(list(events), MESSAGE).coalesce(1) \
            .write.mode("append").parquet(self.topic)

    def land(self):
        live.start_landing(from_files(self.spark, self.topic), self.sink,
                           str(self.root / "ck_land")).awaitTermination()
        return self.spark.read.parquet(self.sink)

    def aggregate(self, checkpoint="ck_agg"):
        live.ensure_live_table(self.spark, self.table)
        return live.drain_live_aggregate(
            from_files(self.spark, self.topic), str(self.root / checkpoint),
            live.table_upserter(self.table),
            lambda: live.orders_in(live.live_table(self.spark, self.table)))

    def minutes(self):
        found = live.live_table(self.spark, self.table) \
            .select("window_start", "channel", "orders", "units").collect()
        return sorted((r[0].minute, r[1], r[2], r[3]) for r in found)


def test_landing_is_exactly_once_over_restarts(lane):
    lane.send(event(0, 1), event(1, 2))
    assert lane.land().count() == 2
    lane.send(event(2, 3))
    assert lane.land().count() == 3
    landed = lane.land()
    assert landed.count() == 3 and landed.select("event_id").distinct().count() == 3


def test_broken_payload_lands_as_nulls_and_stays_out_of_the_aggregate(lane):
    lane.send(event(0, 1), event(1, 1, payload="{bad"))
    broken = lane.land().filter("kafka_offset = 1").collect()[0]
    assert broken["order_id"] is None and broken["event_date"] is None
    lane.aggregate()
    assert lane.minutes() == [(1, "amazon", 1, 1)]


def test_landed_timestamp_honours_its_offset(lane, spark):
    lane.send(event(0, 1, payload='{"event_id":"e","event_ts":"2024-01-01T01:30:00+02:00"}'))
    row = lane.land().selectExpr("cast(event_ts as string) t", "cast(event_date as string) d") \
        .first()
    assert tuple(row) == ("2023-12-31 23:30:00", "2023-12-31")


def test_later_batch_corrects_its_minute(lane):
    lane.send(event(0, 1, qty=2), event(1, 1, channel="backmarket"), event(2, 2))
    lane.aggregate()
    lane.send(event(3, 1, qty=3), event(4, 3))
    lane.aggregate()
    assert lane.minutes() == [(1, "amazon", 2, 5), (1, "backmarket", 1, 1),
                              (2, "amazon", 1, 1), (3, "amazon", 1, 1)]


def test_events_beyond_the_watermark_are_dropped_and_counted(lane):
    lane.send(event(0, 1), event(1, 10))
    lane.aggregate()
    # Watermark 12:08. Minute 12:07 ended by then, minute 12:08 did not.
    lane.send(event(2, 1), event(3, 7, 59), event(4, 8, 0))
    run = lane.aggregate()
    assert lane.minutes() == [(1, "amazon", 1, 1), (8, "amazon", 1, 1), (10, "amazon", 1, 1)]
    assert (run.arrived, run.counted, run.late) == (3, 1, 2)


def test_late_events_are_counted_beyond_the_reports_a_query_keeps(lane, spark):
    """One file a micro-batch, more of them than progress reports are remembered."""
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        lane.send(event(0, 50))
        lane.aggregate()
        for n in range(1, 9):
            lane.send(event(n, n), event(100 + n, 50))
        messages = lane.spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1) \
            .parquet(lane.topic)
        run = live.drain_live_aggregate(
            messages, str(lane.root / "ck_agg"), live.table_upserter(lane.table),
            lambda: live.orders_in(live.live_table(spark, lane.table)))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert (run.arrived, run.counted, run.late) == (16, 8, 8)


def test_replay_into_the_same_table_changes_nothing(lane):
    lane.send(event(0, 1), event(1, 1), event(2, 2))
    lane.aggregate()
    once = lane.minutes()
    lane.aggregate()
    lane.aggregate("another_checkpoint")
    assert lane.minutes() == once == [(1, "amazon", 2, 2), (2, "amazon", 1, 1)]


def test_empty_topic_leaves_an_empty_table(lane):
    lane.aggregate()
    assert lane.minutes() == []


def test_unknown_quantity_gives_unknown_units(lane):
    lane.send(event(0, 1, qty="null"))
    lane.aggregate()
    found = live.live_table(lane.spark, lane.table).select("orders", "units").first()
    assert tuple(found) == (1, None)


def dying(write):
    """A writer whose run ends after the table was written, before the batch is committed."""
    def writes(batch, batch_id):
        write(batch, batch_id)
        raise KeyError("the driver is gone")
    return writes


def test_run_that_ends_between_table_and_commit(lane, spark, rows):
    """The batch runs again under its id: table, state and late count end as without the fault."""
    def drain(checkpoint, table, writer=lambda w: w):
        live.ensure_live_table(spark, table)
        return live.drain_live_aggregate(
            from_files(spark, lane.topic), str(lane.root / checkpoint), writer(live.table_upserter(table)),
            lambda: live.orders_in(live.live_table(spark, table)), ledger=str(lane.root / f"{checkpoint}-late"))

    def minutes(frame):
        return rows(frame, "window_start", "window_end", "channel", "orders", "units")

    calm, other = str(lane.root / "calm"), str(lane.root / "other")
    lane.send(event(0, 1), event(1, 8, qty=2), event(2, 8, channel="backmarket"))
    drain("ck_calm", calm)
    with pytest.raises(Exception, match="driver is gone"):
        drain("ck_other", other, dying)
    assert minutes(live.live_table(spark, other)) == minutes(live.live_table(spark, calm))
    drain("ck_other", other)
    lane.send(event(3, 2), event(4, 8, qty=5), event(5, 9))  # the first is beyond the watermark
    expected = drain("ck_calm", calm)
    with pytest.raises(Exception, match="driver is gone"):
        drain("ck_other", other, dying)
    found = drain("ck_other", other)
    assert expected.late_so_far == found.late_so_far == 1
    assert minutes(live.live_table(spark, other)) == minutes(live.live_table(spark, calm))
    table = live.live_table(spark, other)
    still_open = live.open_minutes(spark, str(lane.root / "ck_other"))
    held = minutes(still_open)
    assert held and held == minutes(table.join(
        still_open.select("window_start", "channel"), ["window_start", "channel"], "left_semi"))
    assert live.open_minutes(spark, str(lane.root / "ck_other")).filter("minute(window_start) >= 8").count() == 3


def test_interval_trigger_goes_on_until_stopped(lane, spark):
    live.ensure_live_table(spark, lane.table)
    query = live.start_live_aggregate(from_files(spark, lane.topic), str(lane.root / "ck_run"),
                                      live.table_upserter(lane.table), live.Trigger("1 second"))
    try:
        for n in (1, 2):
            lane.send(event(n, n))
            query.processAllAvailable()
            assert query.isActive and len(lane.minutes()) == n
    finally:
        query.stop()


def test_offset_runs_show_gaps_and_repeats(spark, rows):
    landed = [(0, o) for o in range(10)] + [(0, 12), (0, 13), (0, 13), (1, 5), (1, 7), (1, 7), (1, 7), (None, 3), (2, None)]
    events = spark.createDataFrame(landed, "kafka_partition int, kafka_offset long")
    expected = [(0, 0, 9, 10, 0), (0, 12, 13, 2, 1), (1, 5, 5, 1, 0), (1, 7, 7, 1, 2)]
    columns = ("kafka_partition", "first_offset", "last_offset", "messages", "repeats")
    for block in (1, 3, 1 << 20):
        assert rows(continuity.offset_runs(events, block), *columns) == expected
    assert continuity.offset_runs(events.limit(0)).collect() == []
