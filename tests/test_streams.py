"""Streams over message files: same results as a batch, recovery, late rows, fan-out."""

import datetime as dt
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from podium.checks import queries
from podium.operators import (
    STREAM,
    latest_per_key,
    observe_bad,
    parse_messages,
    reference_stats,
    to_messages,
)
from podium.plans import FileTopic, fan_out_messages, running_stats, stream_fan_out, stream_stats
from podium.schemas import ATHLETE_EVENT_RESULTS
from podium.session import SETTINGS
from podium.sinks import console_writer, fan_out, files_writer
from podium.streaming import (
    EVERY_10_SECONDS,
    UNTIL_CAUGHT_UP,
    bucketed_snapshot,
    partitions_of_batches,
    read_history,
    run_number,
    snapshot,
    start_console,
    start_fan_out,
    stream_table,
    windowed_averages,
)
from tests.athletes import RESULTS, STATS, as_stats, bio, results
from tests.settings import session_conf

FOLDER = "/root/testdata/sf0.001"

KEYS = list(STREAM.group_by)


def send(spark, topic, rows):
    df = spark.createDataFrame(rows, ATHLETE_EVENT_RESULTS).coalesce(1)
    topic.publish(df, key="athlete_id")


def run(query):
    query.awaitTermination()
    return query


def start(spark, tmp_path, writers, **options):
    topic = FileTopic(str(tmp_path / "topic"))
    return stream_stats(
        topic.stream(spark, maxFilesPerTrigger=1), bio(spark), writers,
        str(tmp_path / "checkpoint"), trigger=UNTIL_CAUGHT_UP, **options,
    )


# Running averages


def test_stream_equals_batch(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    for part in (RESULTS[:3], RESULTS[3:5], RESULTS[5:]):
        send(spark, topic, part)
    run(start(spark, tmp_path, [files_writer(out)]))
    history = read_history(spark, out)
    assert history.select("batch_id").distinct().count() == 3
    # One stamp per micro-batch.
    assert history.select("batch_id", "timestamp").distinct().count() == 3
    view = latest_per_key(history, KEYS, "batch_id")
    assert as_stats(view) == STATS
    batch = running_stats(topic.batch(spark), bio(spark))
    assert as_stats(batch) == STATS
    assert as_stats(reference_stats(results(spark), bio(spark), STREAM)) == STATS
    assert batch.columns == history.drop("batch_id").columns


def test_only_changed_groups_are_written_again(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS[:3])
    send(spark, topic, RESULTS[3:4])
    run(start(spark, tmp_path, [files_writer(out)]))
    history = read_history(spark, out)
    changed = [tuple(r[:4]) for r in history.filter("batch_id = 1").collect()]
    assert changed == [("Judo", "Gold", "M", "CUB")]
    assert history.count() == 4


def test_hot_keys_do_not_change_a_stream(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS)
    run(start(spark, tmp_path, [files_writer(out)], hot=[7, 8]))
    assert as_stats(read_history(spark, out)) == STATS


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6))
def test_any_split_gives_the_same_view(spark, tmp_path_factory, seed):
    tmp_path = tmp_path_factory.mktemp("split")
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    rng = random.Random(seed)
    rows = rng.sample(RESULTS, len(RESULTS))
    cuts = sorted(rng.sample(range(1, len(rows)), 2))
    for part in (rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]):
        send(spark, topic, part)
    run(start(spark, tmp_path, [files_writer(out)]))
    assert as_stats(latest_per_key(read_history(spark, out), KEYS, "batch_id")) == STATS


def test_state_survives_a_restart(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS[:4])
    run(start(spark, tmp_path, [files_writer(out)]))
    send(spark, topic, RESULTS[4:])
    run(start(spark, tmp_path, [files_writer(out)]))
    assert as_stats(latest_per_key(read_history(spark, out), KEYS, "batch_id")) == STATS


def test_a_failed_sink_gets_its_batch_again(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS[:5])
    send(spark, topic, RESULTS[5:])
    seen, broken = [], [True]

    def flaky(batch, batch_id):
        seen.append(batch_id)
        if batch_id == 1 and broken[0]:
            raise RuntimeError("sink is down")

    with pytest.raises(StreamingQueryException, match="sink is down"):
        run(start(spark, tmp_path, [files_writer(out), flaky]))
    broken[0] = False
    run(start(spark, tmp_path, [files_writer(out), flaky]))
    assert seen == [0, 1, 1]
    # The first sink saw batch 1 twice and holds it once.
    history = read_history(spark, out)
    assert history.count() == history.dropDuplicates([*KEYS, "batch_id"]).count()
    assert as_stats(latest_per_key(history, KEYS, "batch_id")) == STATS


def test_the_static_side_is_read_again_in_every_batch(spark, tmp_path):
    path, out = str(tmp_path / "bio"), str(tmp_path / "out")
    bio(spark).filter("athlete_id = '1'").write.parquet(path)
    topic = FileTopic(str(tmp_path / "topic"))

    def once():
        run(
            stream_stats(
                topic.stream(spark), spark.read.parquet(path), [files_writer(out)],
                str(tmp_path / "checkpoint"), trigger=UNTIL_CAUGHT_UP,
            )
        )

    send(spark, topic, RESULTS[:2])
    once()
    assert read_history(spark, out).count() == 1
    bio(spark).filter("athlete_id = '2'").write.mode("append").parquet(path)
    send(spark, topic, RESULTS[1:2])
    once()
    view = latest_per_key(read_history(spark, out), KEYS, "batch_id")
    assert {r["country_noc"] for r in view.collect()} == {"GBR", "NOR"}


def test_snapshot(spark, tmp_path):
    frozen = snapshot(bio(spark), str(tmp_path / "s"))
    assert frozen.columns == bio(spark).columns and frozen.count() == 9


def test_bucketed_snapshot_is_not_shuffled_again(spark, tmp_path):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "4",
    }
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS[:5])
    send(spark, topic, RESULTS[5:])
    typed = bio(spark).withColumn("athlete_id", F.col("athlete_id").try_cast("int"))
    with session_conf(spark, conf):
        frozen = bucketed_snapshot(typed, "bio_buckets", str(tmp_path / "b"), "athlete_id", 4)
        query = run(
            stream_stats(
                topic.stream(spark, maxFilesPerTrigger=1), frozen, [files_writer(out)],
                str(tmp_path / "c"), trigger=UNTIL_CAUGHT_UP,
            )
        )
        plan = query._jsq.explainInternal(False)
    # One exchange for the facts, one for the groups, none for the static side.
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2
    assert as_stats(latest_per_key(read_history(spark, out), KEYS, "batch_id")) == STATS


# Fan-out


def test_fan_out_computes_a_batch_once(spark):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def touch(x):
        evaluated.add(1)
        return x

    counts = []
    batch = spark.range(1000).select(touch(F.col("id").cast("int")).alias("x"))
    sinks = [lambda b, i: counts.append((i, b.agg(F.sum("x")).first()[0]))] * 3
    fan_out(*sinks)(batch, 4)
    assert counts == [(4, 499500)] * 3
    assert evaluated.value == 1000
    assert not batch.storageLevel.useMemory


def test_fan_out_skips_empty_batches_and_frees_after_errors(spark):
    called = []
    fan_out(lambda b, i: called.append(i))(spark.range(0), 0)
    assert called == []

    def fail(batch, batch_id):
        raise RuntimeError("down")

    batch = spark.range(5)
    with pytest.raises(RuntimeError):
        fan_out(fail)(batch, 1)
    assert not batch.storageLevel.useMemory


def test_fan_out_writes_few_rows_with_few_tasks(spark):
    tasks = []
    sink = lambda b, i: tasks.append((b.rdd.getNumPartitions(), b.count()))
    fan_out(sink, bytes_per_task=2**20)(spark.range(0, 100, 1, 8), 0)
    fan_out(sink, bytes_per_task=1)(spark.range(0, 100, 1, 8), 1)
    # A stateless batch is written as it comes.
    fan_out(sink)(spark.range(0, 200_000, 1, 16), 2)
    assert tasks == [(1, 100), (8, 100), (16, 200_000)]


def test_telemetry_goes_to_two_sinks(spark, tmp_path):
    source, target = FileTopic(str(tmp_path / "in")), FileTopic(str(tmp_path / "out"))
    readings = [(1.5, 7), (2.5, 8), (3.5, None)]
    source.publish(spark.createDataFrame(readings, "timestamp DOUBLE, value BIGINT"))
    run(
        stream_fan_out(
            source.stream(spark),
            [files_writer(str(tmp_path / "files")), target.writer(key="value")],
            str(tmp_path / "checkpoint"), trigger=UNTIL_CAUGHT_UP,
        )
    )
    files = read_history(spark, str(tmp_path / "files"))
    assert files.columns == ["timestamp", "value", "processed_at", "batch_id"]
    assert sorted((r[0], r[1]) for r in files.collect()) == readings
    sent = target.batch(spark).selectExpr("CAST(key AS STRING)", "CAST(value AS STRING)").collect()
    assert {r["key"] for r in sent} == {"7", "8", None}
    payload = json.loads(next(r["value"] for r in sent if r["key"] == "7"))
    assert payload["timestamp"] == 1.5 and payload["value"] == 7 and "processed_at" in payload


def test_stamp_can_be_injected(spark):
    stamp = dt.datetime(2025, 1, 1)
    messages = to_messages(spark.createDataFrame([(1.0, 2)], "timestamp DOUBLE, value BIGINT"))
    assert fan_out_messages(messages, stamp_value=F.lit(stamp)).first() == (1.0, 2, stamp)


def test_bad_messages_are_counted_on_the_way(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([('{"a":1}',), ("junk",), ('{"a":"x"}',)], "value STRING").selectExpr(
        "CAST(NULL AS BINARY) key", "CAST(value AS BINARY) value"
    ).write.parquet(path)
    parsed = parse_messages(FileTopic(path).stream(spark), "a INT", bad_record="bad")
    query = run(
        start_fan_out(
            observe_bad(parsed, "bad"), [files_writer(str(tmp_path / "out"))],
            str(tmp_path / "c"), trigger=UNTIL_CAUGHT_UP,
        )
    )
    metrics = [p.observedMetrics["messages"] for p in query.recentProgress if p.numInputRows]
    assert [(m["rows"], m["bad"]) for m in metrics] == [(3, 2)]
    out = read_history(spark, str(tmp_path / "out"))
    assert sorted(r["bad"] for r in out.filter("bad IS NOT NULL").collect()) == [
        "junk", '{"a":"x"}',
    ]


# Windows


T0 = dt.datetime(2024, 1, 1, 10)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def send_readings(spark, path, readings):
    df = spark.createDataFrame(readings, "ts TIMESTAMP_NTZ, g STRING, v DOUBLE").coalesce(1)
    df.write.mode("append").parquet(path)


def run_windows(spark, tmp_path):
    stream = spark.readStream.schema("ts TIMESTAMP_NTZ, g STRING, v DOUBLE").parquet(
        str(tmp_path / "in")
    )
    windows = windowed_averages(stream, "ts", ["g"], {"a": "v"}, scale=2, rows="n")
    return run(
        start_fan_out(
            windows, [files_writer(str(tmp_path / "out"))], str(tmp_path / "c"),
            mode="append", trigger=UNTIL_CAUGHT_UP,
        )
    )


def test_closed_windows_are_emitted_once_and_late_rows_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    send_readings(spark, source, [(at(5), "x", 1.0), (at(50), "x", 2.0), (at(65), "x", 9.0)])
    run_windows(spark, tmp_path)
    assert not (tmp_path / "out").exists()  # watermark 10:55, all windows open
    send_readings(spark, source, [(at(130), "x", 5.0), (at(40), "x", 6.0)])
    run_windows(spark, tmp_path)  # 10:40 still counts, then the watermark is 12:00
    send_readings(spark, source, [(at(45), "x", 100.0), (at(200), "x", 7.0)])
    query = run_windows(spark, tmp_path)  # 10:45 is too late now
    dropped = sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
    assert dropped == 1
    got = read_history(spark, str(tmp_path / "out")).orderBy("w_start").collect()
    assert [(r["w_start"], r["w_end"], r["n"], r["a"]) for r in got] == [
        (at(0), at(60), 3, 3.0), (at(60), at(120), 1, 9.0), (at(120), at(180), 1, 5.0),
    ]


def test_windows_work_on_a_batch(spark):
    df = spark.createDataFrame(
        [(at(5), "x", 1.0), (at(6), "x", None), (at(65), None, 9.0)], "ts TIMESTAMP, g STRING, v DOUBLE"
    )
    got = windowed_averages(df, "ts", ["g"], {"a": "v"}).orderBy("w_start").collect()
    assert [tuple(r) for r in got] == [(at(0), at(60), "x", 1.0), (at(60), at(120), None, 9.0)]


# Starting


def test_default_trigger_and_stop(spark, tmp_path):
    assert EVERY_10_SECONDS == {"processingTime": "10 seconds"}
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS)
    query = stream_stats(topic.stream(spark), bio(spark), [files_writer(out)], str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert as_stats(read_history(spark, out)) == STATS


def test_stream_table_takes_one_file_or_a_folder(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "many.parquet"))
    one = next((tmp_path / "many.parquet").glob("part-*.parquet"))
    (tmp_path / "one.parquet").write_bytes(one.read_bytes())
    for name in ("one", "many"):
        out = str(tmp_path / f"out-{name}")
        stream = stream_table(spark, str(tmp_path), name, "id BIGINT")
        run(
            start_fan_out(
                stream, [files_writer(out)], str(tmp_path / f"c-{name}"), trigger=UNTIL_CAUGHT_UP
            )
        )
        assert read_history(spark, out).count() == 5


def test_console(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id BIGINT").parquet(str(tmp_path / "in"))
    query = run(start_console(stream, trigger=UNTIL_CAUGHT_UP))
    assert "Console" in query.recentProgress[0].sink.description
    assert query.recentProgress[0].numInputRows == 3
    console_writer()(spark.range(1), 0)


def test_recommended_state_store(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS[:4])
    send(spark, topic, RESULTS[4:])
    with session_conf(spark, {k: v for k, v in SETTINGS.items() if ".streaming." in k}):
        query = run(start(spark, tmp_path, [files_writer(out)]))
    assert "rocksdbCommitCheckpointLatency" in query.recentProgress[0].stateOperators[0].customMetrics
    assert as_stats(latest_per_key(read_history(spark, out), KEYS, "batch_id")) == STATS


def test_a_sink_that_looks_at_a_few_rows_does_not_lose_state(spark, tmp_path):
    topic, seen = FileTopic(str(tmp_path / "topic")), []
    rows = [("2000", "e", "NOR", f"sport{i}", "x", "r", "Ann", 1, "1", None, "f") for i in range(60)]
    for _ in range(3):
        send(spark, topic, rows)
    run(start(spark, tmp_path, [lambda batch, batch_id: seen.append(len(batch.take(1)))]))
    assert seen == [1, 1, 1]


def test_a_new_checkpoint_into_the_same_files(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")

    def go(name):
        checkpoint = str(tmp_path / name)
        writers = [files_writer(out, run_number(spark, checkpoint))]
        run(
            stream_stats(
                topic.stream(spark, maxFilesPerTrigger=1), bio(spark), writers, checkpoint,
                trigger=UNTIL_CAUGHT_UP,
            )
        )

    send(spark, topic, [(*RESULTS[0][:2], "NZL", *RESULTS[0][3:7], 8, *RESULTS[0][8:])])
    send(spark, topic, RESULTS[:5])
    go("first")
    send(spark, topic, RESULTS[5:])
    go("second")
    numbers = [run_number(spark, str(tmp_path / name)) for name in ("first", "second")]
    assert numbers[0] < numbers[1]
    history = read_history(spark, out)
    assert {r["run"] for r in history.select("run").distinct().collect()} == set(numbers)
    latest = latest_per_key(history, KEYS, ["run", "batch_id"])
    whole = parse_messages(topic.batch(spark), ATHLETE_EVENT_RESULTS)
    assert as_stats(latest) == as_stats(reference_stats(whole, bio(spark), STREAM))


def test_state_partitions_are_the_querys_own(spark, tmp_path):
    topic, out = FileTopic(str(tmp_path / "topic")), str(tmp_path / "out")
    send(spark, topic, RESULTS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = run(start(spark, tmp_path, [files_writer(out)], state_partitions=3))
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_state_partitions_follow_the_batch_and_not_the_session(spark, monkeypatch):
    customers, started = spark.read.parquet(f"{FOLDER}/customer.parquet").withColumnRenamed("c_custkey", "user_id"), []
    cores = spark.sparkContext.defaultParallelism
    assert partitions_of_batches(spark, 1, customers) == cores
    assert partitions_of_batches(spark, 2**40) == 2**15
    monkeypatch.setattr(queries, "stream_stats", lambda *a, **named: started.append(named))
    with session_conf(spark, {"spark.sql.shuffle.partitions": "77"}):
        queries._start_event_stats(spark, spark.read.parquet(f"{FOLDER}/events.parquet"), customers, lambda run: [])
    assert started == [{"state_partitions": cores}]


def test_a_topic_is_spread_over_files(spark):
    assert queries._messages_per_file(spark.range(10)) == 3
    assert queries._messages_per_file(spark.range(4_000_000)) == 50_000
    assert queries._messages_per_file(spark.range(4096 * 60_000)) == 60_000


def test_every_run_of_the_folded_history_has_few_state_partitions(spark, monkeypatch):
    started, start_stats = [], queries._start_event_stats
    monkeypatch.setattr(queries, "_start_event_stats", lambda *a: started.append(start_stats(*a)) or started[-1])
    with session_conf(spark, {"spark.sql.shuffle.partitions": "77"}):
        rows = queries.q_folded_history(spark, FOLDER).collect()
    used = {s["numShufflePartitions"] for query in started for p in query.recentProgress for s in p["stateOperators"]}
    assert len(started) == 2 and rows and used == {spark.sparkContext.defaultParallelism}


def test_one_row_group_is_published_from_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "MESSAGES_PER_FILE", 10)
    rows = spark.range(1000).withColumn("value", F.col("id") % 7)
    rows.coalesce(1).write.parquet(str(tmp_path / "rows"))
    one, topics = spark.read.parquet(str(tmp_path / "rows")), [FileTopic(str(tmp_path / name)) for name in ("one", "even")]
    queries._publish(topics[0], one, "id")
    queries._publish(topics[1], rows.repartitionByRange(spark.sparkContext.defaultParallelism, "id"), "id")
    for topic in topics:
        sent = parse_messages(topic.batch(spark), "id BIGINT, value BIGINT", carry=["key"])
        assert sorted(map(tuple, sent.collect())) == sorted((str(i).encode(), i, i % 7) for i in range(1000))
    written = [{path.name.split("-")[1] for path in (tmp_path / name).glob("part-*")} for name in ("one", "even")]
    # Dealt out, in files of ten; and rows that lie evenly already are left where they are.
    assert len(written[0]) == 21 and len(written[1]) == spark.sparkContext.defaultParallelism


def test_short_and_empty_topics_are_not_dealt_out(spark, tmp_path):
    for name, count in (("short", 100), ("empty", 0)):
        topic = FileTopic(str(tmp_path / name))
        queries._publish(topic, spark.range(count).coalesce(1), "id")
        assert topic.batch(spark).count() == count
    assert len(list((tmp_path / "short").glob("part-*"))) == 4
