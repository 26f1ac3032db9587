"""The queries: each takes a session and the folder of the tables, and returns a frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from podium.checks.database import database, fresh_table
from podium.functions import as_double, as_int, clean_text, parse_born
from podium.operators import (
    StatsSpec,
    along_curve,
    as_of,
    clean_strings,
    deduplicate,
    hot_keys,
    join_reference,
    latest_per_key,
    numeric_rows,
    parse_messages,
    parse_variants,
    plan_bytes,
    reference_stats,
    to_messages,
    variant_fields,
)
from podium.plans import (
    FileTopic,
    bronze_to_silver,
    gold_averages,
    landing_to_bronze,
    load_increment,
    load_silver,
    publish_table,
    read_stats,
    round_trip_stats,
    run_lake,
    silver_by_key,
    silver_rows,
    silver_to_gold,
    stream_fan_out,
    stream_stats,
)
from podium.plans.incremental import BUCKET
from podium.session import scratch_dir
from podium.sinks import (
    Ledger,
    committed,
    create_jdbc_table,
    files_writer,
    jdbc_writer,
    merge_writer,
    once,
    table_writer,
    write_jdbc,
    write_layer,
)
from podium.sources import empty_like, key_range, quantile_predicates, read_jdbc, read_layer
from podium.streaming import (
    UNTIL_CAUGHT_UP,
    FoldedHistory,
    partitions_of_batches,
    read_history,
    run_number,
    snapshot,
    start_fan_out,
    stream_table,
    windowed_averages,
)
from podium.versions import VersionedTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
ORDER = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
CUSTOMER = """
    custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING
"""
EVENT_STATS = StatsSpec(
    key="user_id",
    group_by=("event_type", "c_mktsegment"),
    averages={"avg_value": "value", "avg_acctbal": "c_acctbal"},
    scale=3,
)


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _customers(spark: SparkSession, folder: str, key: str = "custkey") -> DataFrame:
    return _table(spark, folder, "customer").withColumnRenamed("c_custkey", key)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").withColumnRenamed("o_custkey", "custkey")


# Bytes of files in one micro-batch, which is kept on the executors while it is written.
BATCH_BYTES = 2**30
# Ranges that a database table is read in, and connections it is written through: what a database
# takes at a time, not what a table needs.
MOST_CONNECTIONS = 64
ROWS_PER_RANGE = 1_000_000


# Messages in a file of a topic: a file is read by few tasks, so a micro-batch should be many of them, and
# a long topic no more than some thousands.
MESSAGES_PER_FILE = 50_000
FILES_PER_TOPIC = 4096
# Files that a task writes when rows are dealt out, and the times a core's share of the rows that a task
# may have without it.
FILES_PER_TASK = 5
MOST_OF_A_SHARE = 1.5


def _messages_per_file(rows: DataFrame, count: int | None = None) -> int:
    """What spreads the messages of a topic over files; topics shorter than a few files come in four."""
    count = rows.count() if count is None else count
    return min(count // 4 + 1, max(MESSAGES_PER_FILE, count // FILES_PER_TOPIC))


def _publish(topic: FileTopic, rows: DataFrame, key: str | None = None) -> None:
    """Publish `rows` in files, from tasks that have about as many rows each.

    A table is read by one task for each of its row groups at most, and one of them may hold millions of
    short rows. Where a task would get far more than a core's share, the rows are dealt out before: making
    messages of them takes much longer than that.
    """
    in_tasks = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"))
    count, most = in_tasks.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.max("rows"), F.lit(0))).first()
    per_file = _messages_per_file(rows, count)
    tasks = count // (FILES_PER_TASK * per_file) + 1
    if tasks > 1 and most > MOST_OF_A_SHARE * count / rows.sparkSession.sparkContext.defaultParallelism:
        rows = rows.repartition(tasks, *rows.columns)
    topic.publish(rows, key, max_per_file=per_file)


def _batch_bytes(df: DataFrame) -> int:
    """The size of a micro-batch; tables smaller than a few of them still come in several."""
    return min(BATCH_BYTES, plan_bytes(df) // 4 + 1)


def _ranges(rows: DataFrame) -> int:
    """How many ranges the rows are worth, as far as the database's connections go."""
    return max(1, min(MOST_CONNECTIONS, -(-rows.count() // ROWS_PER_RANGE)))


def _to_ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


# Averages


@_query
def q_gold_avg_stats(spark: SparkSession, folder: str) -> DataFrame:
    spec = StatsSpec(
        key="custkey",
        group_by=("o_orderpriority", "o_orderstatus", "c_mktsegment", "c_nationkey"),
        averages={"avg_weight": "c_acctbal", "avg_height": "o_totalprice"},
        measure_type="float",
        scale=2,
        reference_first=True,
    )
    return reference_stats(_orders(spark, folder), _customers(spark, folder), spec)


@_query
def q_stats_double_3dp(spark: SparkSession, folder: str) -> DataFrame:
    spec = StatsSpec(
        key="custkey",
        group_by=("o_orderpriority", "o_orderstatus", "c_mktsegment"),
        averages={"avg_height": "o_totalprice", "avg_weight": "c_acctbal"},
        scale=3,
    )
    return reference_stats(_orders(spark, folder), _customers(spark, folder), spec)


@_query
def q_stats_unrounded(spark: SparkSession, folder: str) -> DataFrame:
    spec = StatsSpec(
        key="custkey",
        group_by=("o_orderpriority", "c_mktsegment"),
        averages={"avg_height": "o_totalprice", "avg_weight": "c_acctbal"},
    )
    stats = reference_stats(_orders(spark, folder), _customers(spark, folder), spec)
    # The last bits of a sum of doubles depend on its order: compare six decimals.
    return stats.withColumns({name: F.round(name, 6) for name in spec.averages})


@_query
def q_stats_stamped(spark: SparkSession, folder: str) -> DataFrame:
    spec = StatsSpec(
        key="custkey",
        group_by=("o_orderpriority", "c_mktsegment"),
        averages={"avg_height": "o_totalprice"},
        scale=3,
        stamp="timestamp",
    )
    stats = reference_stats(_orders(spark, folder), _customers(spark, folder), spec)
    # The time itself is not known beforehand: it is present, of today, and the same in all rows.
    now = F.col("timestamp").between(
        F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp()
    )
    same = F.min("timestamp").over(Window.partitionBy("o_orderpriority")) == F.col("timestamp")
    return stats.select("o_orderpriority", "c_mktsegment", "avg_height", (now & same).alias("stamped"))


@_query
def q_stats_whole_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys as untidy text: with fraction digits, beyond the type, or no number at all."""
    kinds = F.col("o_orderkey") % 5
    text = F.col("custkey").cast("string")
    key = (
        F.when(kinds == 0, text)
        .when(kinds == 1, F.concat(text, F.lit(".0")))
        .when(kinds == 2, F.concat(text, F.lit(".7")))
        .when(kinds == 3, F.concat(text, F.lit("99999999999")))
        .otherwise(F.concat(F.lit("no"), text))
    )
    spec = StatsSpec(
        key="custkey",
        group_by=("o_orderpriority", "c_mktsegment"),
        averages={"avg_height": "o_totalprice"},
        scale=3,
        key_type="int",
    )
    orders = _orders(spark, folder).withColumn("custkey", key)
    return reference_stats(orders, _customers(spark, folder), spec)


# Cleaning


@_query
def q_clean_text(spark: SparkSession, folder: str) -> DataFrame:
    part = _table(spark, folder, "part")
    return part.select("p_partkey", *[clean_text(c).alias(c) for c in ("p_name", "p_brand")])


@_query
def q_clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", clean_text("text").alias("text"))


@_query
def q_clean_all_strings(spark: SparkSession, folder: str) -> DataFrame:
    return clean_strings(_table(spark, folder, "customer"))


@_query
def q_silver_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Three columns without the key, so that there are equal rows to drop."""
    orders = _table(spark, folder, "orders")
    return deduplicate(
        clean_strings(orders.select("o_orderpriority", "o_orderstatus", "o_custkey"))
    )


@_query
def q_silver_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Without the id; the number of characters goes with the text."""
    documents = _table(spark, folder, "documents")
    return deduplicate(
        clean_strings(documents.select("text", "lang", "source", "n_chars"))
    )


@_query
def q_numeric_rows(spark: SparkSession, folder: str) -> DataFrame:
    part = _table(spark, folder, "part")
    dirty = part.select(
        "p_partkey",
        as_int(F.substring_index("p_brand", "#", -1)).alias("brand_no"),
        as_double("p_name").alias("name_no"),
        F.when(F.col("p_size") <= 25, F.col("p_size").cast("string"))
        .otherwise(F.col("p_name"))
        .alias("size_text"),
    )
    return numeric_rows(dirty, ["size_text"])


@_query
def q_parse_born(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", parse_born(F.date_format("o_orderdate", "dMMMMyyyy")).alias("born")
    )


# Joins and shapes


@_query
def q_join_using(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_reference(
        _orders(spark, folder), _customers(spark, folder).drop("c_name"), "custkey"
    )
    return joined.select("custkey", "o_orderkey", "c_mktsegment", "o_orderstatus")


@_query
def q_hot_key_join(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the events belong to one user. The hint keeps the merge join at every size."""
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    events = _table(spark, folder, "events").select(
        "event_id", user.cast("bigint").alias("user_id"), "event_type"
    )
    hot = hot_keys(events, "user_id")
    customers = _customers(spark, folder, "user_id").select("user_id", "c_mktsegment")
    return join_reference(events, customers.hint("merge"), "user_id", hot=hot)


@_query
def q_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = _table(spark, folder, "events").select("user_id", "event_type", "event_id", "value")
    return latest_per_key(events, ["user_id", "event_type"], "event_id")


@_query
def q_distinct_sorted(spark: SparkSession, folder: str) -> DataFrame:
    customers = _table(spark, folder, "customer").select("c_mktsegment", "c_nationkey")
    return customers.distinct().sort("c_nationkey", "c_mktsegment")


@_query
def q_limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Which rows a limit takes is open: how many they are, and that they are the table's, is not."""
    customers = _table(spark, folder, "customer")
    known = customers.limit(5).join(customers, customers.columns, "left_semi")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("n_different"))


@_query
def q_limit_zero_schema(spark: SparkSession, folder: str) -> DataFrame:
    customers = _table(spark, folder, "customer")
    return customers.limit(0).unionByName(empty_like(spark, customers.schema))


@_query
def q_count_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("n"))


# Messages


@_query
def q_to_json(spark: SparkSession, folder: str) -> DataFrame:
    """Engines write doubles and times as different text, so the values are compared."""
    return parse_messages(to_messages(_table(spark, folder, "orders")), ORDER)


@_query
def q_keyed_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = to_messages(_table(spark, folder, "customer"), key="c_custkey")
    return parse_messages(messages, CUSTOMER.replace("custkey", "c_custkey"), carry=["key"])


@_query
def q_payload_key(spark: SparkSession, folder: str) -> DataFrame:
    messages = to_messages(_table(spark, folder, "events"), key="value")
    parsed = parse_messages(messages, EVENT, carry=["key"])
    return parsed.withColumn("key", F.col("key").try_cast("double"))


@_query
def q_uuid_key(spark: SparkSession, folder: str) -> DataFrame:
    """Keys are random: each is a new one, and no message is lost."""
    messages = to_messages(_table(spark, folder, "customer"), key=F.expr("uuid()"))
    parsed = parse_messages(messages, "c_custkey BIGINT", carry=["key"])
    return parsed.agg(
        F.count_distinct("key").alias("n_keys"),
        F.count_if(F.length("key") == 36).alias("n_uuids"),
        F.count_distinct("c_custkey").alias("n_customers"),
    )


@_query
def q_from_json(spark: SparkSession, folder: str) -> DataFrame:
    messages = _table(spark, folder, "events").withColumnRenamed("value", "reading")
    messages = messages.withColumnRenamed("props", "value")
    return parse_messages(messages, "k INT", carry=["event_id"])


@_query
def q_bad_messages(spark: SparkSession, folder: str) -> DataFrame:
    # Errors carry plain text, purchases a text where the number should be.
    payload = (
        F.when(F.col("event_type") == "error", F.col("event_type"))
        .when(F.col("event_type") == "purchase", F.lit('{"k": "none"}'))
        .otherwise(F.col("props"))
    )
    messages = _table(spark, folder, "events").select("event_id", payload.alias("value"))
    return parse_messages(messages, "k INT", bad_record="bad_record", carry=["event_id"])


@_query
def q_topic_batch(spark: SparkSession, folder: str) -> DataFrame:
    spec = StatsSpec(
        key="user_id",
        group_by=("event_type", "c_mktsegment"),
        averages={"avg_value": "value", "avg_acctbal": "c_acctbal"},
        scale=6,
    )
    stats = round_trip_stats(
        spark,
        _customers(spark, folder, "user_id"),
        _table(spark, folder, "events"),
        FileTopic(scratch_dir(spark, "topic")),
        CUSTOMER.replace("custkey", "user_id"),
        spec,
    )
    return stats


# Files and databases


@_query
def q_csv_bronze(spark: SparkSession, folder: str) -> DataFrame:
    landing, lake = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    orders = _table(spark, folder, "orders")
    orders.write.option("header", True).csv(f"{landing}/orders.csv")
    landing_to_bronze(spark, landing, lake, ["orders"])
    bronze = read_layer(spark, lake, "bronze", "orders")
    # All of bronze is text; engines write doubles and times differently, so their values are compared.
    return bronze.withColumn("o_totalprice", as_double("o_totalprice")).withColumn(
        "o_orderdate", F.col("o_orderdate").try_cast("timestamp_ntz")
    )


@_query
def q_lake_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    landing, lake = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    # Some rows of either side have lost their key. They belong to nobody and meet nobody.
    known = F.when(F.col("custkey") % 50 != 7, F.col("custkey"))
    customers = _customers(spark, folder).withColumn("custkey", known)
    known = F.when(F.col("o_orderkey") % 50 != 7, F.col("custkey"))
    orders = _orders(spark, folder).withColumn("custkey", known)
    tables = {"customer": customers, "orders": orders}
    for name, rows in tables.items():
        rows.write.option("header", True).csv(f"{landing}/{name}.csv")
    spec = StatsSpec(
        key="custkey",
        group_by=("o_orderpriority", "c_mktsegment"),
        averages={"avg_weight": "c_acctbal", "avg_height": "o_totalprice"},
        measure_type="float",
        scale=2,
        reference_first=True,
    )
    gold = run_lake(spark, landing, lake, spec, list(tables))
    return spark.read.parquet(gold)


@_query
def q_jdbc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    customers = _table(spark, folder, "customer")
    connection, table = database(spark), fresh_table("customer")
    create_jdbc_table(spark, customers.schema, connection, table)
    write_jdbc(customers, connection, table, max_connections=MOST_CONNECTIONS)
    ranges = key_range(spark, connection, table, "c_custkey", tasks=_ranges(customers))
    return read_jdbc(spark, connection, table, partition=ranges)


@_query
def q_publish_table(spark: SparkSession, folder: str) -> DataFrame:
    connection, table = database(spark), fresh_table("customer")
    customers = _customers(spark, folder)
    write_jdbc(customers, connection, table, max_connections=MOST_CONNECTIONS)
    topic = FileTopic(scratch_dir(spark, "topic"))
    ranges = key_range(spark, connection, table, "custkey", tasks=_ranges(customers))
    publish_table(spark, connection, table, topic, "custkey", partition=ranges)
    messages = topic.batch(spark).withColumn("key", F.col("key").cast("string"))
    return parse_messages(messages, CUSTOMER, carry=["key"])


# Streams


def _start_event_stats(
    spark: SparkSession,
    events: DataFrame,
    customers: DataFrame,
    writers: Callable[[int], list[Any]],
    trigger: Mapping[str, Any] = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Publish `events` to a topic and run the streaming averages over it, on a new checkpoint.

    `writers` gets the number of the run. Hot users are looked for at every size.
    """
    topic, checkpoint = FileTopic(scratch_dir(spark, "topic")), scratch_dir(spark, "checkpoint")
    _publish(topic, events, "user_id")
    history = topic.batch(spark)
    batch_bytes = _batch_bytes(history)
    hot = hot_keys(parse_messages(history, EVENT, only=["user_id"]), "user_id")
    return stream_stats(
        topic.stream(spark, maxBytesPerTrigger=batch_bytes),
        customers,
        writers(run_number(spark, checkpoint)),
        checkpoint,
        EVENT_STATS,
        EVENT,
        trigger,
        hot,
        state_partitions=partitions_of_batches(spark, batch_bytes, customers),
    )


def _run_twice(
    spark: SparkSession, folder: str, writers: Callable[[int], list[Any]]
) -> None:
    """A run over half of the events, then one over all of them, on a new checkpoint, into the same
    sinks. The second run's batch ids start again; its results are the newer ones all the same."""
    events, customers = _table(spark, folder, "events"), _customers(spark, folder, "user_id")
    customers = snapshot(customers, scratch_dir(spark, "snapshot"))
    for part in (events.where(F.col("event_id") % 2 == 0), events):
        _start_event_stats(spark, part, customers, writers).awaitTermination()


@_query
def q_stream_medal_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_dir(spark, "out")
    _run_twice(spark, folder, lambda run: [files_writer(out, run)])
    history = read_history(spark, out)
    return latest_per_key(history, EVENT_STATS.group_by, ["run", "batch_id"]).drop("run", "batch_id")


@_query
def q_stream_trigger(spark: SparkSession, folder: str) -> DataFrame:
    """On a clock instead of until caught up, and stopped when all is consumed."""
    out = scratch_dir(spark, "out")
    query = _start_event_stats(
        spark,
        _table(spark, folder, "events"),
        _customers(spark, folder, "user_id"),
        lambda run: [files_writer(out, run)],
        {"processingTime": "500 milliseconds"},
    )
    query.processAllAvailable()
    query.stop()
    history = read_history(spark, out)
    return latest_per_key(history, EVENT_STATS.group_by, ["run", "batch_id"]).drop("run", "batch_id")


@_query
def q_stream_to_database(spark: SparkSession, folder: str) -> DataFrame:
    connection, table = database(spark), fresh_table("stats")
    create_jdbc_table(
        spark,
        "event_type STRING, c_mktsegment STRING, avg_value DOUBLE, avg_acctbal DOUBLE, "
        "run BIGINT, batch_id BIGINT",
        connection,
        table,
    )

    def writers(run: int) -> list[Any]:
        return [jdbc_writer(connection, table, "batch_id", MOST_CONNECTIONS, "run", run)]

    _run_twice(spark, folder, writers)
    ranges = key_range(spark, connection, table, "batch_id", tasks=MOST_CONNECTIONS)
    stats = read_stats(
        spark, connection, table, EVENT_STATS.group_by, ["run", "batch_id"], partition=ranges
    )
    return stats.drop("run", "batch_id")


@_query
def q_stream_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    events = _table(spark, folder, "events")
    stream = stream_table(
        spark, folder, "events", events.schema,
        maxBytesPerTrigger=_batch_bytes(events),
    )
    out, copy = scratch_dir(spark, "out"), FileTopic(scratch_dir(spark, "topic"))
    stream_fan_out(
        to_messages(stream, "event_id"),
        [files_writer(out), copy.writer(key="value")],
        scratch_dir(spark, "checkpoint"),
        EVENT,
        trigger=UNTIL_CAUGHT_UP,
    ).awaitTermination()
    stamped = F.col("processed_at").isNotNull().alias("stamped")
    files = read_history(spark, out).select(F.lit("files").alias("sink"), *events.columns, stamped)
    messages = parse_messages(copy.batch(spark), f"{EVENT}, processed_at TIMESTAMP")
    return files.unionByName(messages.select(F.lit("topic").alias("sink"), *events.columns, stamped))


@_query
def q_stream_windowed(spark: SparkSession, folder: str) -> DataFrame:
    events = _table(spark, folder, "events")
    # All files in one micro-batch: no row can be late, and the result is the same for any order.
    windows = windowed_averages(
        stream_table(spark, folder, "events", events.schema),
        "ts", ["event_type"], {"avg_value": "value"}, scale=3, rows="n",
    )
    out = scratch_dir(spark, "out")
    start_fan_out(
        windows, [files_writer(out)], scratch_dir(spark, "checkpoint"), "append", UNTIL_CAUGHT_UP
    ).awaitTermination()
    return read_history(spark, out).select(
        F.col("w_start").cast("timestamp_ntz").alias("w_start"), "event_type", "n", "avg_value"
    )


# Tables in versions, loads and deliveries that are repeated

GOLD_SPEC = StatsSpec(
    key="custkey",
    group_by=("o_orderpriority", "o_orderstatus", "c_mktsegment", "c_nationkey"),
    averages={"avg_weight": "c_acctbal", "avg_height": "o_totalprice"},
    measure_type="float",
    scale=2,
    reference_first=True,
)


@_query
def q_versioned_layer(spark: SparkSession, folder: str) -> DataFrame:
    """A layer whose next write fails in the middle, then one that is replaced by a part of itself."""
    lake, orders = scratch_dir(spark, "lake"), _table(spark, folder, "orders")
    write_layer(orders, lake, "bronze", "orders", versions=True)
    broken = orders.withColumn(
        "o_orderkey", F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("o_orderkey"))
    )
    try:
        write_layer(broken, lake, "bronze", "orders", versions=True)
    except PySparkException:
        pass  # as meant: the layer is what it was
    old = read_layer(spark, lake, "bronze", "orders")
    write_layer(old.where(F.col("o_orderkey") % 2 == 0), lake, "bronze", "orders", versions=True)
    return read_layer(spark, lake, "bronze", "orders").unionByName(old)


@_query
def q_lake_in_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole lake twice: the second run finds half of the orders more."""
    landing, lake = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    customers, orders = _customers(spark, folder), _orders(spark, folder)
    customers.write.option("header", True).csv(f"{landing}/customer.csv")
    for part in (orders.where(F.col("o_orderkey") % 2 == 0), orders):
        part.write.mode("overwrite").option("header", True).csv(f"{landing}/orders.csv")
        run_lake(spark, landing, lake, GOLD_SPEC, ["customer", "orders"], versions=True)
    return read_layer(spark, lake, "gold", "avg_stats").withColumn("c_nationkey", as_int("c_nationkey"))


@_query
def q_incremental_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads that overlap, and one that is repeated."""
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")
    silver = VersionedTable(spark, scratch_dir(spark, "silver"), BUCKET)
    for load, rest in enumerate((0, 1, 1, 2)):
        rows = orders.where(F.col("o_orderkey") % 4 != rest).drop("o_orderkey")
        load_silver(rows, silver, min(load, 2), buckets=8)
    load_silver(orders.where(F.col("o_orderkey") % 4 == 2).drop("o_orderkey"), silver, 3, buckets=8)
    return silver_rows(silver.read())


@_query
def q_incremental_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads of orders and customers; customers also come after their orders."""
    silver = [VersionedTable(spark, scratch_dir(spark, "silver"), BUCKET) for _ in range(2)]
    state = VersionedTable(spark, scratch_dir(spark, "gold"), BUCKET)
    customers = _customers(spark, folder).select("custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    orders = _orders(spark, folder).drop("o_orderdate")
    for load in range(3):
        bronze = (
            customers.where(F.pmod(F.xxhash64("custkey"), F.lit(3)) == load),
            orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == load),
        )
        load_increment(bronze, silver, state, load, GOLD_SPEC, buckets=8)
    return gold_averages(state, GOLD_SPEC)


@_query
def q_gold_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The gold join over silver tables in buckets by key."""
    lake = scratch_dir(spark, "lake")
    for name, rows in (("customer", _customers(spark, folder)), ("orders", _orders(spark, folder).drop("o_orderdate"))):
        write_layer(rows, lake, "bronze", name)
    bronze_to_silver(spark, lake, ["customer", "orders"])
    # A database of its own, so that runs do not share tables; its tables lie in the lake.
    database = f"podium_{lake.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database}")
    tables = silver_by_key(spark, lake, "custkey", 8, ["customer", "orders"], database)
    gold = silver_to_gold(spark, lake, GOLD_SPEC, gold_table="stats", silver=[t.hint("merge") for t in tables])
    return spark.read.parquet(gold)


class _Unsteady:
    """A sink that takes a batch and then fails, once for each of the given batches."""

    def __init__(self, write: Any, *batches: int) -> None:
        self.write, self.left = write, set(batches)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch, batch_id)
        if batch_id in self.left:
            self.left.discard(batch_id)
            raise RuntimeError(f"sink failed after batch {batch_id}")


def _until_done(start: Callable[[], StreamingQuery]) -> None:
    """Start a query again until it ends well."""
    for _ in range(10):
        try:
            start().awaitTermination()
            return
        except PySparkException:
            pass  # a sink failed; its batch comes again
    raise RuntimeError("the query does not end well")


@_query
def q_stream_once(spark: SparkSession, folder: str) -> DataFrame:
    """Three sinks, two of which fail after taking a batch: an append-only one and a table."""
    events = _table(spark, folder, "events")
    topic = FileTopic(scratch_dir(spark, "topic"))
    _publish(topic, events)
    ledger, out = Ledger(spark, scratch_dir(spark, "ledger")), scratch_dir(spark, "out")
    checkpoint, first = scratch_dir(spark, "checkpoint"), VersionedTable(spark, scratch_dir(spark, "table"))
    appending = _Unsteady(lambda batch, batch_id: batch.write.mode("append").parquet(out), 0, 2)
    table = _Unsteady(table_writer(first, "events"), 1)
    writers = [once(appending, ledger, "files"), table]
    stream = topic.stream(spark, maxBytesPerTrigger=_batch_bytes(topic.batch(spark)))
    _until_done(lambda: stream_fan_out(stream, writers, checkpoint, EVENT, trigger=UNTIL_CAUGHT_UP))
    ledger.fold()
    sinks = {"files": committed(spark.read.parquet(out), ledger, "files"), "table": first.read()}
    parts = [rows.select(F.lit(name).alias("sink"), *events.columns) for name, rows in sinks.items()]
    return parts[0].unionByName(parts[1])


@_query
def q_stream_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Running averages merged into a table by group, while the sink fails now and then."""
    table = VersionedTable(spark, scratch_dir(spark, "table"), "bucket")
    write = _Unsteady(merge_writer(table, list(EVENT_STATS.group_by), "stats", 4), 0, 1)
    events, customers = _table(spark, folder, "events"), _customers(spark, folder, "user_id")
    customers = snapshot(customers, scratch_dir(spark, "snapshot"))
    topic, checkpoint = FileTopic(scratch_dir(spark, "topic")), scratch_dir(spark, "checkpoint")
    _publish(topic, events, "user_id")
    batch_bytes = _batch_bytes(topic.batch(spark))
    stream, parts = topic.stream(spark, maxBytesPerTrigger=batch_bytes), partitions_of_batches(spark, batch_bytes, customers)
    _until_done(
        lambda: stream_stats(
            stream, customers, [write], checkpoint, EVENT_STATS, EVENT, UNTIL_CAUGHT_UP, state_partitions=parts
        )
    )
    return table.read().drop("bucket")


@_query
def q_folded_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into one history, which is folded after the first batch, after the first run, and later."""
    out = scratch_dir(spark, "out")
    folded = FoldedHistory(spark, out, scratch_dir(spark, "base"), EVENT_STATS.group_by)
    events, customers = _table(spark, folder, "events"), _customers(spark, folder, "user_id")
    customers = snapshot(customers, scratch_dir(spark, "snapshot"))
    runs = []

    def writers(run: int) -> list[Any]:
        runs.append(run)
        return [files_writer(out, run)]

    for part in (events.where(F.col("event_id") % 2 == 0), events):
        _start_event_stats(spark, part, customers, writers).awaitTermination()
        folded.fold((runs[-1], 0))
        if len(runs) == 1:
            folded.fold(forget=True)
    return folded.read().drop("run", "batch_id")


# Layout, versions of the reference table, payloads without a schema, late rows


@_query
def q_along_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Line items laid out by two columns, and a filter on both."""
    path = scratch_dir(spark, "curve")
    items = _table(spark, folder, "lineitem")
    along_curve(items, ["l_partkey", "l_suppkey"], 64).write.parquet(path)
    low = items.agg(F.max("l_partkey"), F.max("l_suppkey")).first()
    near = (F.col("l_partkey") <= low[0] // 8) & (F.col("l_suppkey") <= low[1] // 8)
    return spark.read.parquet(path).where(near).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@_query
def q_even_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges with equally many rows of a column that lies close together: every row is in one of them."""
    events = _table(spark, folder, "events").select("event_id", "user_id")
    key = F.when(F.col("event_id") % 10 > 0, F.col("user_id") % 100).otherwise(F.col("user_id") * 1000)
    rows = events.withColumn("key", F.when(F.col("event_id") % 97 > 0, key))
    ranges = quantile_predicates(rows, "key", 16, "`")
    numbered = [rows.where(text).withColumn("range", F.lit(k)) for k, text in enumerate(ranges)]
    whole = numbered[0]
    for part in numbered[1:]:
        whole = whole.unionByName(part)
    return whole.select("event_id", "key")


@_query
def q_reference_by_version(spark: SparkSession, folder: str) -> DataFrame:
    """Every third customer changes its segment in the middle of the events."""
    events = _table(spark, folder, "events").select("event_id", "user_id", "ts")
    middle = events.agg(F.min("ts"), F.expr("timestampdiff(MICROSECOND, min(ts), max(ts)) div 2")).first()
    change = F.lit(middle[0]).cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(middle[1]) / 1_000_000)
    customers = _customers(spark, folder, "user_id").select("user_id", "c_mktsegment")
    since = customers.withColumn("since", F.lit(None).cast("timestamp_ntz"))
    moved = customers.where(F.col("user_id") % 3 == 0).select(
        "user_id", F.concat(F.lit("NEW "), "c_mktsegment").alias("c_mktsegment"), change.alias("since")
    )
    return as_of(events, since.unionByName(moved), "user_id", "ts", "since").drop("ts")


@_query
def q_unknown_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that no schema names, of different types from message to message."""
    payload = (
        F.when(F.col("event_type") == "error", F.col("event_type"))
        .when(F.col("event_type") == "purchase", F.lit('{"k": "none", "more": {"n": [4, 5]}}'))
        .otherwise(F.col("props"))
    )
    messages = _table(spark, folder, "events").select("event_id", payload.alias("value"))
    fields = {"k": ("$.k", "int"), "k_text": ("$.k", "string"), "n": ("$.more.n[1]", "bigint")}
    return variant_fields(parse_variants(messages, carry=["event_id"]), fields)


@_query
def q_stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows over events that come in four parts by time, each in micro-batches of its own; some rows of
    the first part come with the last one, when their windows are closed."""
    events = _table(spark, folder, "events")
    first, span = events.agg(F.min("ts"), F.expr("timestampdiff(MICROSECOND, min(ts), max(ts))")).first()
    since = F.timestamp_diff("MICROSECOND", F.lit(first).cast("timestamp_ntz"), F.col("ts"))
    part = F.floor(since * 4 / F.lit(span + 1))
    late = (part == 0) & (F.col("event_id") % 20 == 0)
    source, out, checkpoint = (scratch_dir(spark, name) for name in ("parts", "out", "checkpoint"))
    dealt = events.withColumn("part", F.when(late, 3).otherwise(part))
    for k in range(4):
        dealt.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{source}/events.parquet")
        windows = windowed_averages(
            stream_table(spark, source, "events", events.schema), "ts", ["event_type"], {"avg_value": "value"}, scale=3, rows="n"
        )
        start_fan_out(windows, [files_writer(out)], checkpoint, "append", UNTIL_CAUGHT_UP).awaitTermination()
    return read_history(spark, out).select(
        F.col("w_start").cast("timestamp_ntz").alias("w_start"), "event_type", "n", "avg_value"
    )
