"""Command line for the scheduled jobs; made for spark-submit."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from feedpulse.functions.dates import days
from feedpulse.plans import jobs
from feedpulse.sources.readers import read_actions, read_actions_table, stream_actions
from feedpulse.sources.scratch import clear
from feedpulse.streaming.activity import anomaly_alerts_stream
from feedpulse.streaming.both_services import corrected_activity


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, help: str, messages: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help)
        sub.add_argument("--feed", required=True, help="folder or catalog table of feed_actions")
        if messages:
            sub.add_argument("--messages", required=True, help="folder or table of message_actions")
        sub.add_argument("--format", default="parquet", help="file format, or 'table'")
        sub.add_argument("--out", required=True, help="folder for the results")
        return sub

    day = date.fromisoformat
    rollup = command("daily-rollup", "roll-up of the day before --as-of", messages=True)
    rollup.add_argument("--as-of", type=day, required=True)
    rollup.add_argument("--dims", help="folder that keeps the users' dimension values")
    rollup.add_argument("--versioned", action="store_true", help="replace the day at once, in a table of versions")
    rollup.add_argument("--backfill", action="store_true", help="make yesterday's --dims from the history first")
    alerts = command("alerts", "alerts for the last closed bucket before --as-of, and their bands")
    alerts.add_argument("--as-of", type=datetime.fromisoformat, required=True)
    alerts.add_argument("--messages", help="message_actions, to check all six metrics")
    alerts.add_argument("--a", type=float, default=4, help="width of the band in quartile ranges")
    alerts.add_argument("--n", type=int, default=6, help="earlier buckets a band rests on")
    for name, help, messages in (
        ("feed-report", "feed report", False),
        ("service-report", "whole-service report", True),
        ("weekly", "weekly status and retention", False),
        ("dashboards", "tables behind the dashboards", True),
    ):
        sub = command(name, help, messages)
        sub.add_argument("--as-of", type=day, required=True)
        if name == "weekly":
            sub.add_argument("--state", help="folder that keeps users' weeks; only the last week's events are read then")
            sub.add_argument("--since", type=day, help="bring in all weeks from this day, at first or for late events")
    command("campaign", "campaign retention").add_argument("--date", type=day, required=True)
    for name in ("aa", "ab"):
        test = command(name, f"{name.upper()} test")
        test.add_argument("--from", dest="first", type=day, required=True)
        test.add_argument("--to", dest="last", type=day, required=True)
        test.add_argument("--groups", type=int, nargs=2, required=True, metavar=("A", "B"))
        test.add_argument("--seed", type=int, default=42)
        if name == "aa":
            test.add_argument("--n", type=int, default=250, help="users drawn from either group")
            test.add_argument("--iters", type=int, default=10_000, help="tests")
        else:
            test.add_argument("--reps", type=int, default=2_000, help="bootstrap replicates")
    stream = command("alert-stream", "check every bucket of a stream of files as it closes")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", help="processing time, e.g. '15 minutes'; else work off the backlog")
    both = command("activity-stream", "six metrics of each bucket as it closes, corrected for late events", messages=True)
    both.add_argument("--checkpoint", required=True)
    both.add_argument("--every", help="processing time; else work off the backlog")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    builder = SparkSession.builder.appName(f"feedpulse-{args.job}")
    builder = builder.config("spark.ui.enabled", "false")
    if args.job == "alert-stream":
        provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        builder = builder.config("spark.sql.streaming.stateStore.providerClass", provider)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(name: str, path: str) -> DataFrame:
        if args.format == "table":
            db, _, _ = path.rpartition(".")
            return read_actions_table(spark, name, db or None)
        return read_actions(spark, name, path, args.format)

    if args.job == "alert-stream":
        stream = stream_actions(spark, "feed_actions", args.feed, args.format)
        anomaly_alerts_stream(
            stream, args.out, args.checkpoint, processing_time=args.every
        ).awaitTermination()
        return

    if args.job == "activity-stream":
        streams = [
            stream_actions(spark, name, path, args.format)
            for name, path in (("feed_actions", args.feed), ("message_actions", args.messages))
        ]
        corrected_activity(*streams, args.out, args.checkpoint, processing_time=args.every).awaitTermination()
        return

    feed = read("feed_actions", args.feed)
    results: dict[str, DataFrame] = {}
    if args.job == "daily-rollup":
        if args.backfill:
            jobs.backfill_dims(feed, args.as_of - days(1), args.dims)
        messages = read("message_actions", args.messages)
        place = "versioned_path" if args.versioned else "path"
        jobs.daily_rollup(feed, messages, args.as_of, dims_path=args.dims, **{place: args.out})
    elif args.job == "alerts":
        msg = read("message_actions", args.messages) if args.messages else None
        results = jobs.check_alerts(feed, args.as_of, args.a, args.n, msg)
    elif args.job == "feed-report":
        results = jobs.feed_report(feed, args.as_of)
    elif args.job == "service-report":
        results = jobs.service_report(feed, read("message_actions", args.messages), args.as_of)
    elif args.job == "weekly":
        if args.state:
            results = jobs.weekly_report_kept(feed, args.as_of, args.state, args.since)
        else:
            results = jobs.weekly_report(feed, args.as_of)
    elif args.job == "dashboards":
        results = jobs.dashboard_tables(feed, read("message_actions", args.messages), args.as_of)
    elif args.job == "campaign":
        results = jobs.campaign_report(feed, args.date)
    elif args.job == "aa":
        results = jobs.aa_report(
            feed, args.first, args.last, *args.groups, args.n, args.iters, args.seed
        )
    elif args.job == "ab":
        results = jobs.ab_report(feed, args.first, args.last, *args.groups, args.reps, args.seed)
    # Each run has a folder of its own, so that a run replaces only its own results.
    run = next(getattr(args, x) for x in ("as_of", "date", "last") if hasattr(args, x))
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{args.out}/{name}/run={run:%Y-%m-%dT%H-%M}")
    clear(spark)


if __name__ == "__main__":
    main()
