"""The jobs as commands, one per step, so that any workflow tool can run them in order.

Connections come from the environment, so that no password shows in a process list:
``PODIUM_JDBC_URL``, ``_DRIVER``, ``_USER``, ``_PASSWORD`` and ``PODIUM_KAFKA_BOOTSTRAP``,
``_PROTOCOL``, ``_MECHANISM``, ``_USER``, ``_PASSWORD``. A topic argument is the name of a Kafka topic
or ``files:<folder>`` for message files; a table argument is a database table or ``files:<folder>``
for Parquet files. ``--package`` and ``--jar`` add drivers and connectors to a new session; a Kafka
topic brings its connector along.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from podium.operators.stats import STREAM
from podium.plans import (
    FileTopic,
    KafkaTopic,
    bronze_to_silver,
    landing_to_bronze,
    publish_table,
    read_stats,
    round_trip_stats,
    run_lake,
    silver_to_gold,
    stream_fan_out,
    stream_stats,
)
from podium.plans.topics import Topic
from podium.schemas import ATHLETE_BIO, STREAM_STATS, TABLES, TELEMETRY
from podium.session import KAFKA_CONNECTOR, build_session
from podium.sinks import create_jdbc_table, files_writer, jdbc_writer
from podium.sources import Jdbc, kafka_options, key_range, read_jdbc
from podium.streaming import EVERY_10_SECONDS, UNTIL_CAUGHT_UP, run_number, snapshot

RUN, BATCH_ID = "run", "batch_id"
_FILES = "files:"


def _environment(prefix: str, *names: str) -> list[str | None]:
    return [os.environ.get(f"PODIUM_{prefix}_{name}") for name in names]


def _database() -> Jdbc:
    url, driver, user, password = _environment("JDBC", "URL", "DRIVER", "USER", "PASSWORD")
    if not url or not driver:
        raise SystemExit("PODIUM_JDBC_URL and PODIUM_JDBC_DRIVER are not set")
    return Jdbc(url, driver, user, password)


def _topic(name: str) -> Topic:
    if name.startswith(_FILES):
        return FileTopic(name.removeprefix(_FILES))
    bootstrap, *security = _environment(
        "KAFKA", "BOOTSTRAP", "PROTOCOL", "MECHANISM", "USER", "PASSWORD"
    )
    if not bootstrap:
        raise SystemExit("PODIUM_KAFKA_BOOTSTRAP is not set")
    return KafkaTopic(kafka_options(bootstrap, *security), name)


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    db = _database()
    ranges = key_range(spark, db, args.table, args.split, args.tasks) if args.split else None
    publish_table(spark, db, args.table, _topic(args.topic), args.key, partition=ranges)


def _table(spark: SparkSession, name: str, split: str | None = None, tasks: int = 64) -> DataFrame:
    if name.startswith(_FILES):
        return spark.read.parquet(name.removeprefix(_FILES))
    db = _database()
    ranges = key_range(spark, db, name, split, tasks) if split else None
    return read_jdbc(spark, db, name, partition=ranges)


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    topic = _topic(args.topic)
    limits = {}
    if isinstance(topic, KafkaTopic):
        if args.max_bytes is not None:
            raise SystemExit("--max-bytes is for message files; a Kafka topic takes --max-messages")
        limits["starting"] = args.starting
        if args.max_messages is not None:
            limits["max_messages"] = args.max_messages
    else:
        if args.max_messages is not None:
            raise SystemExit("--max-messages is for Kafka topics; message files take --max-bytes")
        if args.starting != "earliest":
            raise SystemExit("--starting is for Kafka topics; message files are read from the first")
        if args.max_bytes is not None:
            limits["maxBytesPerTrigger"] = args.max_bytes
    return topic.stream(spark, **limits)


def _trigger(args: argparse.Namespace) -> dict:
    return UNTIL_CAUGHT_UP if args.catch_up else EVERY_10_SECONDS


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    db = _database()
    reference = _table(spark, args.reference, args.split, args.tasks)
    if not args.live:
        # Read once, in ranges; files have a known size, so a small table can be broadcast.
        reference = snapshot(reference, args.snapshot or f"{args.checkpoint.rstrip('/')}-reference")
    run = run_number(spark, args.checkpoint)
    stream_stats(
        _messages(spark, args),
        reference,
        [
            _topic(args.to_topic).writer(),
            jdbc_writer(db, args.to_table, BATCH_ID, args.max_connections, RUN, run),
        ],
        args.checkpoint,
        trigger=_trigger(args),
        hot=args.hot or (),
        state_partitions=args.state_partitions,
    ).awaitTermination()


def _fan_out(spark: SparkSession, args: argparse.Namespace) -> None:
    writers = [_topic(name).writer() for name in args.to_topic or ()]
    if args.to_files:
        writers.append(files_writer(args.to_files, run_number(spark, args.checkpoint)))
    if not writers:
        raise SystemExit("fan-out needs --to-topic or --to-files")
    stream_fan_out(
        _messages(spark, args), writers, args.checkpoint, args.schema, trigger=_trigger(args)
    ).awaitTermination()


def _round_trip(spark: SparkSession, args: argparse.Namespace) -> None:
    stats = round_trip_stats(
        spark,
        _table(spark, args.reference, args.split, args.tasks),
        _table(spark, args.facts),
        _topic(args.topic),
        args.schema,
        STREAM,
    )
    stats.write.mode("overwrite").parquet(args.to_files)


def _read(spark: SparkSession, args: argparse.Namespace) -> None:
    keys = STREAM.group_by if args.latest else None
    rows = read_stats(spark, _database(), args.table, keys, [RUN, BATCH_ID])
    rows.printSchema()
    rows.show(args.rows, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="podium", description=__doc__)
    parser.add_argument("--package", action="append", default=[], help="coordinates Spark fetches")
    parser.add_argument("--jar", action="append", default=[], help="a driver or connector file")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(
        name: str, run: Callable[[SparkSession, argparse.Namespace], object], text: str
    ) -> argparse.ArgumentParser:
        command = steps.add_parser(name, help=text, description=text)
        command.set_defaults(run=run)
        return command

    def keeps_versions(command: argparse.ArgumentParser) -> None:
        command.add_argument(
            "--versions", action="store_true", help="keep the old table until the new one is complete"
        )

    command = step(
        "landing-to-bronze",
        lambda spark, a: landing_to_bronze(spark, a.landing, a.lake, a.table or TABLES, a.versions),
        "CSV files to Parquet",
    )
    command.add_argument("--landing", required=True)
    command.add_argument("--lake", required=True)
    command.add_argument("--table", action="append")
    keeps_versions(command)
    command = step(
        "bronze-to-silver",
        lambda spark, a: bronze_to_silver(spark, a.lake, a.table or TABLES, versions=a.versions),
        "clean text and drop duplicates",
    )
    command.add_argument("--lake", required=True)
    command.add_argument("--table", action="append")
    keeps_versions(command)
    command = step(
        "silver-to-gold",
        lambda spark, a: silver_to_gold(spark, a.lake, versions=a.versions),
        "averages per group",
    )
    command.add_argument("--lake", required=True)
    keeps_versions(command)
    command = step(
        "lake",
        lambda spark, a: run_lake(spark, a.landing, a.lake, versions=a.versions),
        "the three lake steps in order",
    )
    command.add_argument("--landing", required=True)
    command.add_argument("--lake", required=True)
    keeps_versions(command)

    command = step(
        "create-table",
        lambda spark, a: create_jdbc_table(
            spark, f"{STREAM_STATS}, {RUN} BIGINT, {BATCH_ID} BIGINT", _database(), a.table
        ),
        "drop and create the table the stream writes to",
    )
    command.add_argument("--table", required=True)
    command = step("publish", _publish, "send a database table to a topic")
    command.add_argument("--table", required=True)
    command.add_argument("--topic", required=True)
    command.add_argument("--key", help="column used as the message key")
    command.add_argument("--split", help="numeric or date column to read the table in ranges of")
    command.add_argument("--tasks", type=int, default=64, help="number of ranges")

    def reads_stream(command: argparse.ArgumentParser) -> None:
        command.add_argument("--topic", required=True)
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--starting", default="earliest", help="earliest or latest, Kafka only")
        command.add_argument("--max-messages", type=int, help="per micro-batch, Kafka only")
        command.add_argument("--max-bytes", type=int, help="per micro-batch, message files only")
        command.add_argument("--catch-up", action="store_true", help="stop when caught up")

    def reads_reference(command: argparse.ArgumentParser) -> None:
        command.add_argument("--reference", required=True, help="table with the athletes")
        command.add_argument("--split", help="column of that table to read it in ranges of")
        command.add_argument("--tasks", type=int, default=64, help="number of ranges")

    command = step("stream", _stream, "running averages from a topic to a topic and a table")
    reads_stream(command)
    reads_reference(command)
    command.add_argument("--snapshot", help="folder to copy the reference table to")
    command.add_argument("--live", action="store_true", help="read that table in every micro-batch")
    command.add_argument("--hot", type=int, action="append", help="a key with very many messages")
    command.add_argument("--state-partitions", type=int, help="counts at the first start")
    command.add_argument("--to-topic", required=True)
    command.add_argument("--to-table", required=True)
    command.add_argument("--max-connections", type=int, default=64, help="to the target table")
    command = step("fan-out", _fan_out, "each message, stamped, to several sinks")
    reads_stream(command)
    command.add_argument("--schema", default=TELEMETRY, help="fields of a message")
    command.add_argument("--to-topic", action="append")
    command.add_argument("--to-files", help="folder for Parquet files")
    command = step("round-trip", _round_trip, "averages with the reference table sent by topic")
    reads_reference(command)
    command.add_argument("--facts", required=True, help="table with the results")
    command.add_argument("--topic", required=True)
    command.add_argument("--schema", default=ATHLETE_BIO, help="fields of a reference message")
    command.add_argument("--to-files", required=True, help="folder for the averages")
    command = step("read-stats", _read, "print the averages in the table")
    command.add_argument("--table", required=True)
    command.add_argument("--latest", action="store_true", help="only the newest of each group")
    command.add_argument("--rows", type=int, default=20)
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one step; `spark` is for callers that have a session already."""
    args = _parser().parse_args(arguments)
    if spark is None:
        topics = [getattr(args, "topic", None), *_listed(getattr(args, "to_topic", None))]
        kafka = [KAFKA_CONNECTOR] * any(t and not t.startswith(_FILES) for t in topics)
        spark = build_session(f"podium {args.step}", [*kafka, *args.package], args.jar)
    args.run(spark, args)


def _listed(value: str | list[str] | None) -> list[str]:
    return value if isinstance(value, list) else [value] if value else []
