"""Command line for spark-submit: ``batch``, ``incremental``, ``ingest`` and ``validate``."""

import argparse

from pyspark.sql import SparkSession

from trafficlake.operators.upkeep import validate_outputs
from trafficlake.plans.batch import run_batch
from trafficlake.plans.incremental import run_incremental
from trafficlake.schema import BATCH_MAX_DELAY, BATCH_MIN_MESSAGES, SAMPLE_ROWS, TOPIC_NAME
from trafficlake.session import use_utc
from trafficlake.sources.topic import read_topic, topic_batching
from trafficlake.streaming.ingest import ingest_stream


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trafficlake")
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("batch", help="raw lake -> KPI tables and CSV sample")
    batch.add_argument("raw", help="folder or glob of JSON Lines files")
    batch.add_argument("analytics", help="folder of the KPI tables")
    batch.add_argument("sample", help="folder of the CSV sample")
    batch.add_argument("--clean", help="folder of the clean events; default: below spark.checkpoint.dir")
    batch.add_argument("--start", help="first day, yyyy-MM-dd; raw is then the root of the lake")
    batch.add_argument("--end", help="last day, yyyy-MM-dd")
    batch.add_argument("--sample-rows", type=int, default=SAMPLE_ROWS)
    batch.add_argument("--input-bytes", type=int, help="size of the input; default: as the file system tells")
    batch.add_argument("--versions", action="store_true", help="publish the KPI tables as one version")

    days = commands.add_parser("incremental", help="changed days of the raw lake -> KPI tables and CSV sample")
    days.add_argument("raw", help="root of the lake")
    days.add_argument("partials", help="folder of what each day adds")
    days.add_argument("analytics", help="folder of the KPI tables")
    days.add_argument("sample", help="folder of the CSV sample")
    days.add_argument("--day", action="append", dest="days", help="read this day, again if it did not change")
    days.add_argument("--sample-rows", type=int, default=SAMPLE_ROWS)
    days.add_argument("--versions", action="store_true", help="publish the KPI tables as one version")

    ingest = commands.add_parser("ingest", help="topic -> raw lake, until stopped")
    ingest.add_argument("servers")
    ingest.add_argument("raw", help="folder of the raw lake")
    ingest.add_argument("checkpoint")
    ingest.add_argument("--topic", default=TOPIC_NAME)
    ingest.add_argument("--min-rows", type=int, default=BATCH_MIN_MESSAGES)
    ingest.add_argument("--max-rows", type=int, default=1_000_000, help="upper limit of one micro-batch")
    ingest.add_argument("--max-delay", default=BATCH_MAX_DELAY)
    ingest.add_argument("--writers", type=int, help="writing tasks per micro-batch; default: by the size of directories")
    ingest.add_argument("--quarantine", help="folder for messages that cannot be stored")

    validate = commands.add_parser("validate", help="Parquet files per KPI table")
    validate.add_argument("analytics")
    return parser.parse_args(argv)


def _batch(spark: SparkSession, args: argparse.Namespace) -> None:
    days = {"start": args.start, "end": args.end}
    sizes = {"sample_rows": args.sample_rows, "input_bytes": args.input_bytes, "versions": args.versions}
    run_batch(spark, args.raw, args.analytics, args.sample, args.clean, **days, **sizes).quality.show()


def _incremental(spark: SparkSession, args: argparse.Namespace) -> None:
    places = (args.raw, args.partials, args.analytics, args.sample)
    result = run_incremental(spark, *places, args.days, args.sample_rows, args.versions)
    print(f"days read: {', '.join(result.days) or 'none'}; days gone: {', '.join(result.gone) or 'none'}")
    result.quality.show()


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    batching = topic_batching(args.min_rows, args.max_delay, args.max_rows)
    messages = read_topic(spark, args.servers, args.topic, **batching)
    stream = ingest_stream(messages, args.raw, f"{args.checkpoint}/events", writers=args.writers, quarantine=args.quarantine)
    stream.awaitTermination()


def _validate(spark: SparkSession, args: argparse.Namespace) -> None:
    validate_outputs(spark, args.analytics).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = use_utc(SparkSession.builder.appName(f"trafficlake-{args.command}").getOrCreate())
    {"batch": _batch, "incremental": _incremental, "ingest": _ingest, "validate": _validate}[args.command](spark, args)


if __name__ == "__main__":
    main()
