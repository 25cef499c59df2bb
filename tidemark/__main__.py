"""Run a job.

``spark-submit --py-files tidemark.zip tidemark/__main__.py ingest ...``, or ``python -m tidemark ingest ...``.
Options fall back to the environment variables BOOTSTRAP_SERVERS, TOPIC, TABLE_NAME and TABLE_KEY.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.operators import source_struct
from tidemark.plans import extract_after, publish_table, run_bronze
from tidemark.schemas import ORDER_IMAGE, envelope, log_schema
from tidemark.sources import StateTable, read_feed, stream_feed, stream_log
from tidemark.streaming import run_ingest, run_state_stream


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark", description="Change-data jobs.")
    jobs = parser.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="stream a feed into the log")
    bronze = jobs.add_parser("bronze", help="bring the state table up to date with the log")
    state = jobs.add_parser("state", help="keep the state table up to date from the log as a stream")
    fold = jobs.add_parser("fold", help="fold the batches a state stream stored into the table")
    extract = jobs.add_parser("extract", help="append the new row images of a whole feed to a Parquet folder")
    publish = jobs.add_parser("publish", help="publish the rows of a Parquet table as change messages")

    for job in (ingest, extract, publish):
        job.add_argument("--servers", default=os.environ.get("BOOTSTRAP_SERVERS", ""))
        job.add_argument("--topic", default=os.environ.get("TOPIC", ""))
        job.add_argument("--feed-format", default="kafka")
        job.add_argument("--feed-path", help="for a feed in files")
        job.add_argument("--feed-option", action="append", default=[], metavar="NAME=VALUE")
    for job in (ingest, bronze, state, fold):
        job.add_argument("--table", default=os.environ.get("TABLE_NAME"), required="TABLE_NAME" not in os.environ)
        job.add_argument("--root", default="../out")
    for job in (ingest, bronze, state):
        job.add_argument("--log-format", default="parquet", help="parquet or delta")
        job.add_argument("--image", help='columns of the table, as "customer_id INT, order_id INT"')
    for job in (bronze, state, fold, publish):
        job.add_argument("--keys", default=os.environ.get("TABLE_KEY"), required="TABLE_KEY" not in os.environ)
    for job in (bronze, state, fold):
        job.add_argument("--buckets", type=int, help="write the state bucketed by the keys, into so many")
    for job in (bronze, state):
        job.add_argument("--op-from", default="op", choices=["op", "images"])
    for job in (ingest, state):
        job.add_argument("--available-now", action="store_true", help="take what is there and stop")
        job.add_argument("--every", help='time between micro-batches, as "1 minute"')
    bronze.add_argument("--since", help="first ingest date to read; all by default")
    state.add_argument("--fold-every", type=int, metavar="N", help="fold after N micro-batches, not by the fold job")
    publish.add_argument("--rows", required=True, help="folder of the table")
    publish.add_argument("--op", default="c", choices=["c", "u", "d"])
    publish.add_argument("--ts-column", help="column with the event time; the time of the job by default")
    publish.add_argument("--source-table", help="name of the table in the source metadata")
    extract.add_argument("--out", default="output")
    extract.add_argument("--first-message", action="store_true", help="infer the schema from the first message alone")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"tidemark-{args.job}").getOrCreate()
    if args.job in ("ingest", "extract", "publish"):
        options = dict(pair.split("=", 1) for pair in args.feed_option)
        source = (spark, args.feed_path, args.feed_format, args.servers, args.topic)
    if args.job == "extract":
        moving = args.feed_format == "kafka"
        extract_after(read_feed(*source, **options), args.out, from_first=args.first_message, land=moving)
        return
    if args.job == "publish":
        if args.feed_format == "kafka":
            options = {"kafka.bootstrap.servers": args.servers, "topic": args.topic, **options}
        metadata = source_struct(table=args.source_table) if args.source_table else None
        rows = spark.read.parquet(args.rows)
        publish_table(rows, args.keys, args.op, args.ts_column, args.feed_path, args.feed_format, metadata, **options)
        return

    if args.job == "ingest":
        checkpoint = f"{args.root}/log/checkpoint_{args.table}"
        feed = stream_feed(*source, **options)
        run_ingest(
            feed,
            _log(args),
            checkpoint,
            envelope(_image(args)),
            args.log_format,
            available_now=args.available_now,
            every=args.every,
        ).awaitTermination()
        return

    table = StateTable(spark, f"{args.root}/bronze/{args.table}", args.keys, buckets=args.buckets)
    if args.job == "fold":
        table.fold()
    elif args.job == "bronze":
        backups = f"{args.root}/bronze/backup/{args.table}"
        schema = log_schema(_image(args))
        run_bronze(spark, _log(args), table, backups, None, args.since, schema, args.log_format, args.op_from)
    else:
        events = stream_log(spark, _log(args), log_schema(_image(args)), args.log_format)
        run_state_stream(
            events, table, args.op_from, args.fold_every, args.available_now, args.every
        ).awaitTermination()


def _log(args: argparse.Namespace) -> str:
    return f"{args.root}/log/{args.table}"


def _image(args: argparse.Namespace) -> T.StructType:
    return T.StructType.fromDDL(args.image) if args.image else ORDER_IMAGE


if __name__ == "__main__":
    main()
