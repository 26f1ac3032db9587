"""Tables in versions, deliveries and loads that are repeated, folded histories."""

import os
import random

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from podium.operators import StatsSpec, clean_strings, deduplicate, latest_per_key, reference_stats
from podium.plans import (
    FileTopic,
    bronze_to_silver,
    gold_averages,
    landing_to_bronze,
    load_increment,
    load_silver,
    silver_by_key,
    silver_rows,
    stream_fan_out,
)
from podium.plans.incremental import BUCKET, DIGEST
from podium.sinks import Ledger, committed, files_writer, merge_writer, once, table_writer, write_layer
from podium.sources import read_layer
from podium.streaming import UNTIL_CAUGHT_UP, FoldedHistory
from podium.versions import VersionedTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def broken(df, at):
    """`df`, whose computation fails at the row with that id."""
    return df.withColumn("id", F.when(F.col("id") == at, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))


# Versions


def test_a_failed_write_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.version() is None
    with pytest.raises(ValueError, match="no version"):
        table.read()
    with pytest.raises(PySparkException):
        table.replace(broken(spark.range(0, 100, 1, 4), 99))
    assert table.version() is None
    table.replace(spark.range(10))
    with pytest.raises(PySparkException):
        table.replace(broken(spark.range(0, 100, 1, 4), 99))
    with pytest.raises(PySparkException):
        table.append(broken(spark.range(0, 100, 1, 4), 99))
    assert rows(table.read()) == [(i,) for i in range(10)] and table.version().number == 0
    assert len(os.listdir(tmp_path / "t" / "data")) == 4  # the rest of failed writes
    table.retire()
    assert len(os.listdir(tmp_path / "t" / "data")) == 1
    assert table.read().count() == 10


def test_old_versions_are_readable_until_they_are_retired(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in (3, 4, 5):
        table.replace(spark.range(n))
    old = table.read(0)
    assert [table.read(n).count() for n in range(3)] == [3, 4, 5]
    table.replace(table.read().where("id > 1"))  # made from itself
    assert old.count() == 3 and rows(table.read()) == [(2,), (3,), (4,)]
    table.retire(keep=1)
    assert rows(table.read()) == [(2,), (3,), (4,)]
    assert len(os.listdir(tmp_path / "t" / "data")) == 1


def test_a_batch_counts_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for batch in (0, 0, 1, 0, 1):
        table.append(spark.range(batch * 10, batch * 10 + 2), {"stream": batch})
    table.append(spark.range(50, 51), {"other": 0})
    table.append(spark.range(60, 61))
    assert rows(table.read()) == [(0,), (1,), (10,), (11,), (50,), (60,)]
    assert table.has("stream", 1) and not table.has("stream", 2) and not table.has("nobody", 0)
    before = table.version().number
    assert table.compact().number == before + 1 and len(table.version().loads) == 1
    assert table.read().count() == 6 and table.has("stream", 1)
    assert rows(table.added(before - 1)) == rows(table.read())


def test_partitions_are_replaced_and_read_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "part")
    frame = spark.range(100).select((F.col("id") % 4).cast("int").alias("part"), "id", F.lit("x").alias("text"))
    table.append(frame)
    table.append(frame.withColumn("id", F.col("id") + 100))
    new = spark.createDataFrame([(2, 1000, "new")], "part int, id long, text string")
    table.replace_partitions(new, [1, 2])
    assert table.read().columns == ["id", "text", "part"]
    assert rows(table.read(partitions=[1])) == []
    assert rows(table.read(partitions=[2])) == [(1000, "new", 2)]
    assert table.read().count() == 101 and table.read(1).count() == 200
    assert all("part=3" in name for name in table.read(partitions=[3]).inputFiles())
    table.retire(keep=1)
    assert table.read().count() == 101
    assert not [d for d, _, names in os.walk(tmp_path / "t" / "data") if "part=1" in d or ("part=2" in d and "0000000-" in d)]
    table.replace_partitions(new.limit(0), range(4))
    assert table.read().count() == 0


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(1))
    old = table.version()
    table.replace(spark.range(2))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(spark.range(3), {}, {}, old)
    assert table.read().count() == 2


def test_layers_in_versions(spark, tmp_path):
    lake = str(tmp_path)
    write_layer(spark.range(5), lake, "bronze", "t", versions=True)
    with pytest.raises(PySparkException):
        write_layer(broken(spark.range(0, 100, 1, 4), 50), lake, "bronze", "t", versions=True)
    assert read_layer(spark, lake, "bronze", "t").count() == 5
    write_layer(read_layer(spark, lake, "bronze", "t").where("id > 2"), lake, "bronze", "t", versions=True)
    assert rows(read_layer(spark, lake, "bronze", "t")) == [(3,), (4,)]
    write_layer(spark.range(7), lake, "silver", "plain")
    assert read_layer(spark, lake, "silver", "plain").count() == 7


# Sinks that fail


def stream(spark, tmp_path, writers, name):
    topic = FileTopic(str(tmp_path / "topic"))
    if not os.path.exists(topic.path):
        for k in range(4):
            topic.publish(spark.range(k * 10, k * 10 + 10).coalesce(1))
    return stream_fan_out(
        topic.stream(spark, maxFilesPerTrigger=1), writers, str(tmp_path / name), "id BIGINT", trigger=UNTIL_CAUGHT_UP
    )


class Failing:
    """A sink that fails after, or in the middle of, some of its batches, once each."""

    def __init__(self, write, after=(), within=()):
        self.write, self.after, self.within, self.calls = write, set(after), set(within), 0

    def __call__(self, batch, batch_id):
        self.calls += 1
        if batch_id in self.within:
            self.within.discard(batch_id)
            self.write(batch.limit(3), batch_id)
            raise RuntimeError("failed within")
        self.write(batch, batch_id)
        if batch_id in self.after:
            self.after.discard(batch_id)
            raise RuntimeError("failed after")


def until_done(start):
    for failures in range(10):
        try:
            start().awaitTermination()
            return failures
        except StreamingQueryException:
            pass
    raise AssertionError("never ends well")


def test_sinks_that_fail_give_what_an_undisturbed_run_gives(spark, tmp_path):
    def append(path):
        return lambda batch, batch_id: batch.write.mode("append").parquet(path)

    ledger, table = Ledger(spark, str(tmp_path / "ledger")), VersionedTable(spark, str(tmp_path / "table"))
    out = [str(tmp_path / name) for name in ("a", "b", "c")]
    first = Failing(append(out[0]), after=[0, 3], within=[1])
    second = Failing(append(out[1]), within=[0, 2])
    third = Failing(table_writer(table, "run1"), after=[0, 2])
    writers = [once(first, ledger, "a"), once(second, ledger, "b"), third]
    assert until_done(lambda: stream(spark, tmp_path, writers, "checkpoint")) == 7
    expected = rows(spark.range(40))
    assert spark.read.parquet(out[0]).count() > 40  # repeated rows are there, and left out on reading
    for name, path in zip("ab", out):
        assert rows(committed(spark.read.parquet(path), ledger, name).select("id")) == expected
    assert rows(table.read().select("id")) == expected
    # A sink that had taken its batch is not called again because another one failed.
    assert first.calls == 4 + 3
    ledger.fold()
    assert os.listdir(tmp_path / "ledger" / "entries" / "a" / "0") == [] and ledger.has("a", 3) and not ledger.has("a", 4)
    assert rows(committed(spark.read.parquet(out[0]), ledger, "a").select("id")) == expected
    ledger.enter("a", 4, "later")
    assert ledger.entries("a").count() == 5 and ledger.has("a", 4)
    ledger.fold()
    assert ledger.entries("a").count() == 5 and ledger.entries().count() == 9


def test_a_new_run_is_not_taken_for_a_repeat(spark, tmp_path):
    ledger, out = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "out")
    for run in (1, 2):
        write = once(lambda batch, batch_id: batch.write.mode("append").parquet(out), ledger, "s", run)
        for _ in range(2):
            write(spark.range(3), 0)
    assert committed(spark.read.parquet(out), ledger, "s").count() == 6
    assert committed(spark.read.parquet(out), ledger, "unknown").count() == 0


def test_merging_keeps_the_newest_row_of_a_key(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "bucket")
    write = merge_writer(table, ["a", "b"], "s", buckets=8)
    frame = lambda data: spark.createDataFrame(data, "a string, b int, n int")
    write(frame([("x", 1, 1), ("x", None, 2), (None, None, 3)]), 0)
    write(frame([("x", None, 20), ("y", 1, 4)]), 1)
    write(frame([("x", 1, 999)]), 1)  # the same batch again
    assert rows(table.read().select("a", "b", "n")) == rows(frame([("x", 1, 1), ("x", None, 20), (None, None, 3), ("y", 1, 4)]))
    touched = [load for load in table.version().loads.values()]
    assert len(touched) == 2 and touched[0]  # buckets without changes were left as they were
    with pytest.raises(ValueError, match="partition column"):
        merge_writer(VersionedTable(spark, str(tmp_path / "u")), ["a"], "s")


# Folded histories


def test_folds_change_nothing_and_save_reading(spark, tmp_path):
    chance = random.Random(1)
    history, keys = str(tmp_path / "history"), ["a", "b"]
    folded = FoldedHistory(spark, history, str(tmp_path / "base"), keys)
    with pytest.raises(ValueError, match="no batch"):
        folded.read()
    assert folded.fold() is None
    schema = "a string, b int, value double"

    def batch(run, number):
        data = {(chance.choice("xyz"), chance.choice([1, 2, None])): chance.random() for _ in range(5)}
        files_writer(history, run)(spark.createDataFrame([(*k, v) for k, v in data.items()], schema), number)

    def check():
        whole = latest_per_key(spark.read.parquet(history), keys, ["run", "batch_id"])
        names = [*keys, "value", "run", "batch_id"]
        assert rows(folded.read().select(names)) == rows(whole.select(names))

    for number in range(4):
        batch(1, number)
    check()
    folded.fold((1, 1))
    check()
    assert folded.folded_up_to() == (1, 1)
    files = folded.read().inputFiles()
    assert not [f for f in files if "batch_id=0" in f or "batch_id=1" in f] and [f for f in files if "/base/" in f]
    folded.fold()
    check()
    assert all("/base/" in f for f in folded.read().inputFiles())
    batch(2, 0)  # numbers start again in a new run
    check()
    folded.fold()
    batch(2, 1)
    check()
    expected = rows(folded.read())
    folded.fold(forget=True)
    assert rows(folded.read()) == expected and not [d for d, _, _ in os.walk(history) if d.endswith("run=2/batch_id=1")]


def test_a_fold_that_fails_leaves_the_base(spark, tmp_path, monkeypatch):
    history = str(tmp_path / "history")
    files_writer(history, 1)(spark.createDataFrame([("x", 1)], "a string, n int"), 0)
    folded = FoldedHistory(spark, history, str(tmp_path / "base"), ["a"])
    folded.fold()
    files_writer(history, 1)(spark.createDataFrame([("x", 2)], "a string, n int"), 1)
    before = rows(folded.read())
    monkeypatch.setattr(VersionedTable, "_write", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        folded.fold()
    monkeypatch.undo()
    assert folded.folded_up_to() == (1, 0) and rows(folded.read()) == before


# Loads


SPEC = StatsSpec(key="id", group_by=["g", "k"], averages={"h": "x", "w": "y"}, scale=2, measure_type="double")


def load_frames(spark, chance, count):
    ref = [(str(chance.randrange(40)), chance.choice(["M", "F", None]), chance.choice(["1.5", "2", "bad", None])) for _ in range(count)]
    facts = [(str(chance.randrange(40)), chance.choice("pqr"), chance.choice(["10", "20.25", "", None])) for _ in range(3 * count)]
    return spark.createDataFrame(ref, "id string, g string, x string"), spark.createDataFrame(facts, "id string, k string, y string")


def test_loads_add_up_to_everything_at_once(spark, tmp_path):
    chance = random.Random(2)
    loads = [load_frames(spark, chance, n) for n in (10, 1, 15, 8)]
    silver = [VersionedTable(spark, str(tmp_path / name), BUCKET) for name in ("ref", "facts")]
    state = VersionedTable(spark, str(tmp_path / "gold"), BUCKET)
    whole = None
    for load, pair in enumerate(loads):
        load_increment(pair, silver, state, load, SPEC)
        whole = pair if whole is None else [a.unionByName(b) for a, b in zip(whole, pair)]
        clean = [deduplicate(clean_strings(frame)) for frame in whole]
        for table, frame in zip(silver, clean):
            assert rows(silver_rows(table.read())) == rows(frame)
        assert rows(gold_averages(state, SPEC)) == rows(reference_stats(clean[1], clean[0], SPEC))
    versions = state.version().number, silver[0].version().number
    load_increment(loads[-1], silver, state, len(loads) - 1, SPEC)  # again: nothing happens
    assert (state.version().number, silver[0].version().number) == versions


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_load_that_fails_is_repeated(spark, tmp_path, monkeypatch, step):
    chance = random.Random(3)
    first, second = load_frames(spark, chance, 10), load_frames(spark, chance, 10)
    silver = [VersionedTable(spark, str(tmp_path / name), BUCKET) for name in ("ref", "facts")]
    state = VersionedTable(spark, str(tmp_path / "gold"), BUCKET)
    load_increment(first, silver, state, 0, SPEC)
    write, left = VersionedTable._write, [step]

    def failing(table, frame, number):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("disk")
        return write(table, frame, number)

    monkeypatch.setattr(VersionedTable, "_write", failing)
    with pytest.raises(OSError):
        load_increment(second, silver, state, 1, SPEC)
    monkeypatch.undo()
    load_increment(second, silver, state, 1, SPEC)
    clean = [deduplicate(clean_strings(a.unionByName(b))) for a, b in zip(first, second)]
    assert rows(silver_rows(silver[1].read())) == rows(clean[1])
    assert rows(gold_averages(state, SPEC)) == rows(reference_stats(clean[1], clean[0], SPEC))


def test_a_digest_shared_by_chance_loses_no_row(spark, tmp_path):
    silver = VersionedTable(spark, str(tmp_path / "t"), BUCKET)
    load_silver(spark.createDataFrame([("a", 1), ("b", 2)], "t string, n int"), silver, 0, buckets=1)
    table = VersionedTable(spark, str(tmp_path / "u"), BUCKET)
    # Every old row gets the digest of the new one.
    new = spark.createDataFrame([("c", 3)], "t string, n int")
    digest = new.select(F.xxhash64("t", "n")).first()[0]
    table.append(silver.read().withColumn(DIGEST, F.lit(digest)))
    load_silver(new.unionByName(spark.createDataFrame([("a", 1)], "t string, n int")), table, 1, buckets=1)
    assert ("c", 3) in rows(silver_rows(table.read()))
    again = table.version().number
    load_silver(new, table, 2, buckets=1)
    assert rows(silver_rows(table.read())).count(("c", 3)) == 1 and table.version().number == again + 1


def test_a_load_touches_only_its_buckets(spark, tmp_path):
    silver = VersionedTable(spark, str(tmp_path / "t"), BUCKET)
    load_silver(spark.range(500).select(F.col("id").cast("string").alias("t")), silver, 0)
    load_silver(spark.createDataFrame([("7",), ("new",)], "t string"), silver, 1)
    assert silver.read().count() == 501 and silver_rows(silver.added(0)).collect() == [("new",)]
    assert set(silver.read(partitions=[3]).select(BUCKET).distinct().collect()) == {(3,)}


def test_gold_over_buckets_shuffles_no_side(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for name, columns in (("ref", ["id", "g", "x"]), ("facts", ["id", "k", "y"])):
        data = [(str(i % 90), "pq"[i % 2], str(i % 7)) for i in range(300)]
        spark.createDataFrame(data, columns).write.option("header", True).csv(f"{tmp_path}/landing/{name}.csv")
    landing_to_bronze(spark, f"{tmp_path}/landing", lake, ["ref", "facts"])
    bronze_to_silver(spark, lake, ["ref", "facts"])
    spark.sql("CREATE DATABASE by_key")
    try:
        reference, facts = silver_by_key(spark, lake, "id", 4, ["ref", "facts"], "by_key")
        plain = [read_layer(spark, lake, "silver", name) for name in ("ref", "facts")]
        stats = reference_stats(facts.hint("merge"), reference, SPEC)
        plan = stats._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("SortMergeJoin") :]
        assert "Exchange" not in below and "Exchange" in plan
        assert rows(stats) == rows(reference_stats(plain[1], plain[0], SPEC))
    finally:
        spark.sql("DROP DATABASE by_key CASCADE")
