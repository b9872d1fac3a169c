"""Run the star-schema job: ``python -m quotelake``, or spark-submit this file."""

from __future__ import annotations

import argparse

from quotelake.session import build_session
from quotelake.sources import files, kafka
from quotelake.streaming import job, queries
from quotelake.streaming.tables import Tables


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quotelake", description=__doc__)
    parser.add_argument("--tables", required=True, help="root folder of the tables")
    parser.add_argument("--checkpoint", required=True, help="folder of the stream's checkpoint")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS", help="bootstrap servers")
    source.add_argument("--files", metavar="FOLDER", help="folder of topic files")
    parser.add_argument("--topic", default=kafka.DEFAULT_TOPIC)
    parser.add_argument("--starting", default="latest", help="offsets of the first start")
    parser.add_argument("--offsets-per-trigger", type=int)
    parser.add_argument("--files-per-trigger", type=int)
    parser.add_argument("--backfill", action="store_true", help="batches hold many days")
    parser.add_argument("--trigger", default=job.FACT_TRIGGER, help="processing-time interval")
    parser.add_argument("--once", action="store_true", help="stop when the data at hand is through")
    return parser.parse_args(argv)


def start(spark, args: argparse.Namespace):
    if args.kafka:
        messages = kafka.read_stream(spark, kafka.source_options(
            args.kafka, args.topic, args.starting, args.offsets_per_trigger))
    else:
        messages = files.stream_topic_files(spark, args.files, args.files_per_trigger)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    return job.start_star_job(
        messages, Tables(args.tables), args.checkpoint, trigger, name="star_schema",
        backfill=args.backfill)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session()
    query = start(spark, args)
    if args.once:
        queries.run_available(query)
    else:
        queries.run_until_any_ends(spark)


if __name__ == "__main__":
    main()
