"""Command line: ``python -m tradewake <job> --data-dir ...`` (see ``--help``)."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from tradewake.operators import quality
from tradewake.plans import daily_run, gate, publish, refresh_timing
from tradewake.session import build_session, clear_scratch
from tradewake.sources.jdbc import Database
from tradewake.sources.lake import Lake
from tradewake.sources.messages import from_files, from_kafka
from tradewake.streaming import orders as live

BATCH_JOBS = ("bronze", "silver", "snapshot", "gold", "gate", "run", "publish", "verify",
              "time-refresh")
STREAM_JOBS = ("stream-land", "stream-aggregate")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradewake")
    parser.add_argument("job", choices=BATCH_JOBS + STREAM_JOBS)
    parser.add_argument("--data-dir", required=True, help="lake folder")
    parser.add_argument("--snapshot-ts", help="UTC time of the product snapshot; default: now",
                        default=datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f"))
    parser.add_argument("--full-refresh", action="store_true", help="rebuild the facts")
    parser.add_argument("--lookback-days", type=int, help="also reload this many loaded days")
    parser.add_argument("--with-stream", action="store_true",
                        help="silver also takes in orders that only the live lane has landed")
    parser.add_argument("--url", help="JDBC URL: serve from this database instead of the lake")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE",
                        help="property of the database connection; may be repeated")
    parser.add_argument("--bootstrap", help="Kafka servers; without them --topic is a folder")
    parser.add_argument("--topic", default="orders")
    parser.add_argument("--mode", choices=("batch", "continuous"), default="batch")
    parser.add_argument("--interval", default="10 seconds", help="trigger in continuous mode")
    return parser.parse_args(argv)


def database(lake: Lake, args: argparse.Namespace) -> Database | None:
    if not args.url:
        return None
    return Database(lake.spark, args.url, dict(p.split("=", 1) for p in args.jdbc_property))


def run_batch(lake: Lake, args: argparse.Namespace) -> None:
    refresh = {"full_refresh": args.full_refresh, "lookback_days": args.lookback_days}
    match args.job:
        case "bronze":
            print(daily_run.land_bronze(lake))
        case "silver":
            daily_run.build_silver(lake, args.with_stream)
        case "snapshot":
            daily_run.snapshot_products(lake, args.snapshot_ts)
        case "gold":
            daily_run.build_gold(lake, **refresh)
        case "gate":
            quality.enforce(gate.report(lake))
        case "run":
            print(daily_run.daily_run(lake, args.snapshot_ts, **refresh,
                                      with_stream=args.with_stream))
        case "publish":
            publish.publish(lake, database(lake, args))
        case "verify":
            publish.verify(lake, database(lake, args))
        case "time-refresh":
            print(refresh_timing.time_refresh(lake))


def run_stream(lake: Lake, args: argparse.Namespace) -> None:
    spark, root = lake.spark, lake.root
    messages = from_kafka(spark, args.bootstrap, args.topic) if args.bootstrap \
        else from_files(spark, args.topic)
    trigger = live.Trigger(args.interval if args.mode == "continuous" else None)
    if args.job == "stream-land":
        live.start_landing(messages, lake.events_path(),
                           f"{root}/bronze_stream/_checkpoint/orders", trigger).awaitTermination()
        landed = spark.read.parquet(lake.events_path()).count()
        print(f"{landed} events landed in {lake.events_path()}")
        return
    served = database(lake, args)
    table = lake.path("serving", "orders_stream_1m")
    if served:
        live.ensure_live_database(served)
        write, counted = served.upserter(live.DATABASE_TABLE, live.LIVE_KEY), \
            lambda: live.orders_in(served.read(live.DATABASE_TABLE))
    else:
        live.ensure_live_table(spark, table)
        write, counted = live.table_upserter(table), \
            lambda: live.orders_in(live.live_table(spark, table))
    checkpoint = f"{root}/_checkpoint/orders_stream_1m"
    run = live.drain_live_aggregate(messages, checkpoint, write, counted, trigger,
                                    f"{checkpoint}-arrivals")
    print(f"{run.counted} orders counted, {run.late} came too late, {run.late_so_far} in all runs")


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    lake = Lake(build_session(f"tradewake-{args.job}"), args.data_dir.rstrip("/"))
    try:
        if args.job in STREAM_JOBS:
            run_stream(lake, args)
        else:
            run_batch(lake, args)
    finally:
        clear_scratch(lake.spark)


if __name__ == "__main__":
    main()
