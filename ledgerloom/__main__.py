"""Jobs from the command line: ``spark-submit`` or ``python -m ledgerloom <job> --root <folder> ..``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import daily, fraud, monitor
from ledgerloom.session import build_session
from ledgerloom.sources.files import load_folder
from ledgerloom.sources.readers import TOPIC, file_events, kafka_events
from ledgerloom.streaming import feed
from ledgerloom.streaming.landing import dead_letter_sink, folder_sink, start_landing

FEED = "serving.latest_events"
DEAD_LETTERS = "public.dead_letters"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="warehouse folder")
        return sub

    load = job("load", "load delimited files into source tables")
    load.add_argument("--format", default="csv", choices=["csv", "parquet"])
    load.add_argument("--single-line", action="store_true", help="no cell holds a line break, so tasks may share a file")
    load.add_argument("tables", nargs="+", metavar="TABLE=PATH")
    stream = job("stream", "land events until stopped")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder of JSON lines")
    stream.add_argument("--topic", default=TOPIC)
    stream.add_argument("--available-now", action="store_true", help="stop when nothing is left")
    calendar = job("calendar", "add missing days to the calendar")
    calendar.add_argument("--start")
    calendar.add_argument("--end")
    job("dimensions", "load the enterprise dimensions; known members keep their keys").add_argument(
        "--renumber", action="store_true", help="number all members anew; all facts must be loaded again")
    job("constraints", "declared constraints of all tables that are there; exit status 1 if one is broken")
    for name, text in (("daily", "dimensions, facts and checks of a day"),
                       ("star-day", "wallet, lending and payment star facts of a day")):
        job(name, text).add_argument("--day", required=True)
    job("checks", "fact count, customers by flag, newest facts")
    job("monitor", "live feed and its figures")
    job("compact", "pack the small batches of the landing table that daily runs have taken up")
    job("refresh-views", "make the stored sums of changed days again and show the views")
    job("move-facts", "write the facts of merged customers under the key that survived")
    job("train", "train the fraud model").add_argument("--model", required=True)
    return parser


def _stream(spark: SparkSession, w: daily.Warehouse, args: argparse.Namespace) -> None:
    raw = kafka_events(spark, args.servers, args.topic) if args.servers else file_events(spark, args.folder)
    query = start_landing(
        raw, f"{w.root}/_checkpoints/landing", folder_sink(w.path(daily.LANDING)), feed.feed_sink(w.path(FEED)),
        available_now=args.available_now, dead=dead_letter_sink(w.path(DEAD_LETTERS)),
    )
    query.awaitTermination()


def _show(*frames: DataFrame) -> None:
    for frame in frames:
        frame.show(monitor.FEED_ROWS, truncate=False)


def main(argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    w = daily.Warehouse(spark, args.root)
    if args.job == "load":
        paths = dict(pair.split("=", 1) for pair in args.tables)
        print("loaded:", *load_folder(spark, paths, w.root, args.format, not args.single_line))
    elif args.job == "stream":
        _stream(spark, w, args)
    elif args.job == "calendar":
        daily.load_calendar(w, args.start, args.end)
    elif args.job == "dimensions":
        daily.load_dimensions(w, args.renumber)
    elif args.job == "constraints":
        report = daily.constraint_report(w).where("broken_rows > 0")
        _show(report)
        if not report.isEmpty():
            sys.exit(1)
    elif args.job == "daily":
        daily.run_daily(w, args.day)
    elif args.job == "star-day":
        daily.run_star_day(w, args.day)
    elif args.job == "checks":
        facts = w.table("mdm.fact_enterprise_transaction")
        customers = w.table("mdm.dim_customer")
        _show(monitor.fact_count(facts), monitor.customers_by_flag(customers), monitor.newest_facts(facts))
    elif args.job == "compact":
        print("packed" if daily.compact_landing(w) else "nothing to pack")
    elif args.job == "refresh-views":
        daily.refresh_sums(w)
        _show(*daily.serve_views(w).values())
    elif args.job == "move-facts":
        print("files written anew:", daily.move_facts(w))
    elif args.job == "monitor":
        # the feed that the stream keeps, or else the newest of all landed events
        events = feed.latest(spark, w.path(FEED)) if w.existing_path(FEED) else w.table(daily.LANDING)
        _show(monitor.live_feed(events), monitor.live_metrics(events))
    elif args.job == "train":
        print(f"accuracy: {fraud.train(w.table('ewallet.transaction'), args.model):.4f}")


if __name__ == "__main__":
    main(sys.argv[1:])
