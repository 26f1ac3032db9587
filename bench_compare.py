"""

Inputs are the test tables repeated COPIES times, written once to the scratch folder, so that work
and not start-up is measured. Prints one JSON line per comparison.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from podium.functions.text import KEEP_CLASS, clean_text  # noqa: E402
from podium.operators import (  # noqa: E402
    StatsSpec,
    clean_strings,
    deduplicate,
    group_averages,
    join_reference,
    parse_messages,
    reference_stats,
)
from podium.plans import FileTopic, fan_out_messages  # noqa: E402
from podium.plans.streams import stream_stats  # noqa: E402
from podium.session import scratch_dir  # noqa: E402
from podium.sinks import fan_out, files_writer  # noqa: E402
from podium.streaming import UNTIL_CAUGHT_UP  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
EVENT = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
SPEC = StatsSpec(
    key="user_id",
    group_by=("event_type", "c_mktsegment"),
    averages={"avg_value": "value", "avg_acctbal": "c_acctbal"},
    scale=3,
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def compare(title: str, repeat: int = 3, **variants) -> None:
    """Time each variant, the fastest of `repeat` rounds, taking turns."""
    best = dict.fromkeys(variants, float("inf"))
    for _ in range(repeat):
        for name, variant in variants.items():
            start = time.perf_counter()
            variant()
            best[name] = min(best[name], time.perf_counter() - start)
    print(json.dumps({title: {name: round(s, 2) for name, s in best.items()}}), flush=True)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("podium-compare")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def copies(name: str, times: int) -> DataFrame:
        path = scratch_dir(spark, name)
        table = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        table.crossJoin(spark.range(times).drop("id")).repartition(32).write.parquet(path)
        return spark.read.parquet(path)

    # Text cleaning.
    texts = copies("documents", max(1, COPIES // 2)).select("text")
    one_by_one = F.udf(lambda t: re.sub(f"[^{KEEP_CLASS}]", "", str(t)), "string")
    token = F.coalesce("text", F.lit("None"))
    compare(
        "clean documents",
        clean_text=lambda: run(texts.select(clean_text("text"))),
        regexp_replace=lambda: run(
            texts.select(F.regexp_replace(token, f"[^{KEEP_CLASS}]", ""))
        ),
        python_udf=lambda: run(texts.select(one_by_one("text"))),
    )
    short = copies("orders", COPIES).select("o_orderpriority", "o_orderstatus")
    compare(
        "clean short columns",
        clean_text=lambda: run(short.select(*[clean_text(c).alias(c) for c in short.columns])),
        regexp_replace=lambda: run(
            short.select(*[F.regexp_replace(c, f"[^{KEEP_CLASS}]", "") for c in short.columns])
        ),
        python_udf=lambda: run(short.select(*[one_by_one(c).alias(c) for c in short.columns])),
    )

    # A silver step as a whole: clean, de-duplicate, write.
    bronze = copies("orders", COPIES).select(
        *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey")],
        F.concat("o_orderpriority", (F.rand(seed=1) * 5).cast("int")).alias("o_orderpriority"),
        "o_orderstatus",
    )

    def silver() -> None:
        deduplicate(clean_strings(bronze)).write.parquet(scratch_dir(spark, "silver"))

    def silver_by_udf() -> None:
        cleaned = bronze
        for name in bronze.columns:
            cleaned = cleaned.withColumn(name, one_by_one(name))
        cleaned = cleaned.dropDuplicates()
        cleaned.take(20)  # a preview before the write runs the plan once more
        cleaned.write.parquet(scratch_dir(spark, "silver"))

    compare("silver step", native=silver, python_udf_and_preview=silver_by_udf)

    # Messages: parse, join, average.
    events = copies("events", COPIES)
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet")
    customers = customers.withColumnRenamed("c_custkey", "user_id")
    topic = FileTopic(scratch_dir(spark, "topic"))
    topic.publish(events, "user_id")
    messages = topic.batch(spark)
    expanded = messages.select(
        F.from_json(F.col("value").cast("string"), EVENT).alias("data")
    ).select("data.*")
    compare(
        "parse, join and average messages",
        parse_messages=lambda: run(
            reference_stats(parse_messages(messages, EVENT), customers, SPEC)
        ),
        select_data_star=lambda: run(reference_stats(expanded, customers, SPEC)),
    )

    # Streams: rows per second, and what the fan-out saves.
    def stream() -> None:
        stream_stats(
            topic.stream(spark, maxFilesPerTrigger=8), customers,
            [files_writer(scratch_dir(spark, "out")), files_writer(scratch_dir(spark, "out"))],
            scratch_dir(spark, "checkpoint"), SPEC, EVENT, UNTIL_CAUGHT_UP,
        ).awaitTermination()

    start = time.perf_counter()
    stream()
    rows = messages.count()
    print(json.dumps({"stream rows per second": int(rows / (time.perf_counter() - start))}))

    def each_sink_alone(*writers):
        def write_batch(batch, batch_id):
            if batch.count() > 0:
                for write in writers:
                    write(batch, batch_id)

        return write_batch

    def fanned_out(sink) -> None:
        (
            fan_out_messages(topic.stream(spark, maxFilesPerTrigger=16), EVENT)
            .writeStream.foreachBatch(
                sink(*[files_writer(scratch_dir(spark, "out")) for _ in range(2)])
            )
            .option("checkpointLocation", scratch_dir(spark, "checkpoint"))
            .trigger(**UNTIL_CAUGHT_UP)
            .start()
            .awaitTermination()
        )

    compare(
        "stateless stream to two sinks",
        repeat=2,
        fan_out=lambda: fanned_out(fan_out),
        each_sink_alone=lambda: fanned_out(each_sink_alone),
    )

    # A key with a third of all facts, in a plan that cannot adapt while it runs (as on a stream).
    skewed = events.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id"))
    ).select("user_id", "event_type", "value")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    reference = customers.select("user_id", "c_mktsegment", "c_acctbal")

    def joined(hot) -> None:
        pairs = join_reference(skewed, reference, "user_id", hot=hot)
        run(group_averages(pairs, SPEC.group_by, SPEC.averages, SPEC.scale))

    compare(
        "sort-merge join with one hot key",
        hot_key_named=lambda: joined([1]),
        hot_key_not_named=lambda: joined([]),
    )
    spark.stop()


if __name__ == "__main__":
    main()
