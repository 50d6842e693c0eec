"""Run a job with spark-submit or python -m clickmill; see --help."""

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from clickmill.plans import (
    CLICK_ORDER,
    batch,
    batch_new_days,
    ingest,
    serve,
    serve_visitors,
    speed_activity,
    speed_clicks,
    speed_sketches,
    speed_visitors,
)
from clickmill.plans.jobs import ACTIVITY_TABLE, PAYLOAD, POSITION, SKETCH_TABLE
from clickmill.schema import ACTIVITY, ACTIVITY_BY_PRODUCT, VISITOR_SKETCHES, VISITORS_BY_PRODUCT
from clickmill.session import STREAM_CONF, configure
from clickmill.sources import close_day, create_database, kafka_stream, stated_cutoff
from clickmill.streaming import DayTable

SPEED = {
    "activity": (speed_activity, "stream_activity_by_product", ACTIVITY_BY_PRODUCT, None),
    "visitors": (speed_visitors, "stream_visitors_by_product", VISITORS_BY_PRODUCT, None),
    "sketches": (speed_sketches, "stream_visitor_sketches", VISITOR_SKETCHES, None),
    "clicks": (speed_clicks, "stream_click_events", ACTIVITY, CLICK_ORDER),
}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clickmill")
    jobs = parser.add_subparsers(dest="job", required=True)

    landing = jobs.add_parser("ingest", help="land clicks from Kafka as dated parquet")
    speed = jobs.add_parser("speed", help="keep a speed table up to date from Kafka")
    speed.add_argument("kind", choices=SPEED)
    speed.add_argument("--database", required=True, help="of the catalog, that the table is in")
    speed.add_argument("--delay", help='forget hours this old, such as "2 days"; not for clicks')
    landing.add_argument("--files", type=int, help="files per micro-batch and day")
    landing.add_argument("--keep-payload", action="store_true", help="land the text of what cannot be keyed")
    landing.add_argument("--keep-position", action="store_true", help="land topic, partition and offset")
    for stream in (landing, speed):
        stream.add_argument("--servers", required=True)
        stream.add_argument("--topic", required=True)
        stream.add_argument("--starting-offsets", default="latest")
        stream.add_argument("--max-offsets-per-trigger", type=int)
        stream.add_argument("--path", required=True)
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--every", help='processing time, such as "60 seconds"')
        stream.add_argument(
            "--kafka-option", action="append", default=[], metavar="KEY=VALUE",
            help="for the Kafka client, such as kafka.security.protocol=SSL; repeatable",
        )

    recompute = jobs.add_parser("batch", help="recompute the batch tables from landed clicks")
    recompute.add_argument("--landed", required=True)
    recompute.add_argument("--database", required=True, help="of the catalog, that the tables are in")
    recompute.add_argument("--location", required=True)
    recompute.add_argument("--since", type=date.fromisoformat)
    recompute.add_argument("--until", type=date.fromisoformat)
    recompute.add_argument("--closed", help="folder of the days that close has rewritten")
    recompute.add_argument("--hours", type=int, help="only event hours this recent")
    recompute.add_argument("--once", action="store_true", help="drop repeated deliveries; needs landed positions")
    recompute.add_argument("--rejects", action="store_true", help="write clicks without a key, with their payload")
    recompute.add_argument("--sketches", action="store_true", help="write sketches of the visitors, for serve --visitors")

    days = jobs.add_parser("days", help="bring the batch tables up to date by the landed days not read yet")
    days.add_argument("--landed", required=True)
    days.add_argument("--closed", help="folder of the days that close has rewritten")
    days.add_argument("--database", required=True)
    days.add_argument("--location", required=True)
    days.add_argument("--until", type=date.fromisoformat, required=True, help="the last day that receives no more clicks")
    days.add_argument("--once", action="store_true", help="drop repeated deliveries; needs landed positions")
    for job in (speed, recompute, days):
        job.add_argument("--buckets", type=int, default=64, help="files of a table, or of each of its days")

    closing = jobs.add_parser("close", help="rewrite a landed day into few files in hour order")
    closing.add_argument("--landed", required=True)
    closing.add_argument("--closed", required=True)
    closing.add_argument("--day", type=date.fromisoformat, required=True)
    closing.add_argument("--files", type=int, default=64)
    closing.add_argument("--keep-payload", action="store_true", help="the landed days hold payloads")
    closing.add_argument("--keep-position", action="store_true", help="the landed days hold positions")

    serving = jobs.add_parser("serve", help="merge batch and speed counts and publish them")
    serving.add_argument("--database", required=True, help="of the catalog, that all tables are in")
    serving.add_argument("--table", default="serving_layer")
    serving.add_argument("--location", required=True)
    serving.add_argument("--visitors", action="store_true", help="serve unique visitors, from the sketches of both layers")
    overlap = serving.add_mutually_exclusive_group()
    overlap.add_argument("--cutoff-hour", type=int, help="default: the one the batch job stated")
    overlap.add_argument("--additive", action="store_true", help="no click is in both tables")
    args = parser.parse_args()
    if args.job == "speed" and args.kind == "clicks" and args.delay:
        parser.error("--delay is not for clicks: the last click of an hour needs no open hour")
    if any("=" not in option for option in getattr(args, "kafka_option", [])):
        parser.error("--kafka-option takes KEY=VALUE")
    return args


def _kafka(spark: SparkSession, args: argparse.Namespace):
    extra = dict(option.split("=", 1) for option in args.kafka_option)
    if args.max_offsets_per_trigger:
        extra["maxOffsetsPerTrigger"] = args.max_offsets_per_trigger
    return kafka_stream(
        spark, args.servers, args.topic, starting_offsets=args.starting_offsets, **extra
    )


def main() -> None:
    args = _arguments()
    confs = [STREAM_CONF] if args.job == "speed" else []
    builder = SparkSession.builder.appName(f"clicks-{args.job}")
    spark = configure(builder, *confs).getOrCreate()

    if args.job == "batch":
        batch(
            spark, args.landed, args.location, args.since, args.until, closed=args.closed, hours=args.hours,
            once=args.once, rejects=args.rejects, sketches=args.sketches, database=args.database, buckets=args.buckets,
        )
    elif args.job == "days":
        batch_new_days(
            spark, args.landed, args.location, args.until, args.closed, args.once, args.database, args.buckets
        )
    elif args.job == "close":
        extra = StructType([*([PAYLOAD] if args.keep_payload else []), *(POSITION if args.keep_position else [])])
        close_day(spark, args.landed, args.closed, args.day, args.files, extra)
    elif args.job == "serve":
        create_database(spark, args.database, args.location)
        table = f"{args.database}.{args.table}"
        cutoff = args.cutoff_hour
        if cutoff is None and not args.additive:
            cutoff = stated_cutoff(spark, f"{args.database}.{ACTIVITY_TABLE}")
        _, name, _, _ = SPEED["sketches" if args.visitors else "activity"]
        sides = [spark.table(f"{args.database}.{side}") for side in (SKETCH_TABLE if args.visitors else ACTIVITY_TABLE, name)]
        if args.visitors:
            serve_visitors(*sides, table, args.location, cutoff)
        else:
            serve(*sides, table, args.location, cutoff, args.additive)
    else:
        trigger = {"processingTime": args.every} if args.every else None
        rows = _kafka(spark, args)
        if args.job == "ingest":
            query = ingest(
                rows, args.path, args.checkpoint, trigger=trigger, files=args.files,
                keep_payload=args.keep_payload, keep_position=args.keep_position,
            )
        else:
            start, name, schema, order = SPEED[args.kind]
            create_database(spark, args.database, args.path)
            table = DayTable(spark, f"{args.database}.{name}", f"{args.path}/{name}", schema, order=order, buckets=args.buckets)
            options = {"delay": args.delay} if args.delay else {}
            query = start(rows, table, args.checkpoint, trigger=trigger, **options)
        query.awaitTermination()


if __name__ == "__main__":
    main()
