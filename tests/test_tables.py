"""Database tables (Derby inside the test's own Spark process) and topic options."""

import datetime as dt
import uuid
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from podium.checks.database import database
from podium.operators import StatsSpec, parse_messages
from podium.plans import FileTopic, KafkaTopic, publish_table, read_stats, round_trip_stats, stream_stats
from podium.schemas import ATHLETE_BIO, ATHLETE_EVENT_RESULTS, STREAM_STATS
from podium.session import scratch_dir, shared_dir
from podium.sinks import create_jdbc_table, jdbc_writer, publish, write_jdbc
from podium.sources import Jdbc, kafka_options, key_range, read_jdbc, read_topic_stream
from podium.streaming import UNTIL_CAUGHT_UP
from tests.athletes import STATS, as_stats, bio, results


@pytest.fixture
def db():
    return Jdbc(
        f"jdbc:derby:memory:test{uuid.uuid4().hex};create=true",
        "org.apache.derby.jdbc.EmbeddedDriver",
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# JDBC


def test_write_and_read_back(spark, db):
    write_jdbc(results(spark), db, "results", max_connections=2)
    back = read_jdbc(spark, db, "results")
    assert back.columns == results(spark).columns
    assert rows(back) == rows(results(spark))
    write_jdbc(results(spark), db, "results")
    assert read_jdbc(spark, db, "results").count() == 20


def test_parallel_reads_return_every_row_once(spark, db):
    write_jdbc(spark.range(1000).selectExpr("id AS k", "id * 2 AS v"), db, "t")
    ranges = key_range(spark, db, "t", "k", tasks=5)
    assert ranges == ("k", 0, 999, 5)
    by_range = read_jdbc(spark, db, "t", partition=ranges)
    by_condition = read_jdbc(
        spark, db, "t", predicates=[f'MOD("k", 3) = {i}' for i in range(3)]
    )
    assert by_range.rdd.getNumPartitions() == 5
    assert by_condition.rdd.getNumPartitions() == 3
    expected = sorted(((i, 2 * i) for i in range(1000)), key=repr)
    assert rows(by_range) == rows(by_condition) == expected
    with pytest.raises(ValueError):
        read_jdbc(spark, db, "t", partition=ranges, predicates=["1 = 1"])


def test_key_range_of_an_empty_table(spark, db):
    create_jdbc_table(spark, "k BIGINT", db, "t")
    assert key_range(spark, db, "t", "k", tasks=5) is None
    assert read_jdbc(spark, db, "t", partition=None).count() == 0


def test_not_null_filters_and_columns_reach_the_database(spark, db):
    write_jdbc(bio(spark), db, "bio")
    plan = read_jdbc(spark, db, "bio").filter("height IS NOT NULL").select("athlete_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(height)]" in text
    assert "ReadSchema: struct<athlete_id:string>" in text


def test_create_table_has_typed_columns_and_replaces(spark, db):
    create_jdbc_table(spark, STREAM_STATS, db, "stats")
    created = read_jdbc(spark, db, "stats")
    assert created.count() == 0
    assert dict(created.dtypes)["timestamp"] == "timestamp"
    row = ("Judo", "Gold", "F", "NOR", 1.0, 2.0, dt.datetime(2025, 4, 8))
    write_jdbc(spark.createDataFrame([row], STREAM_STATS), db, "stats")
    assert rows(read_jdbc(spark, db, "stats")) == [row]
    create_jdbc_table(spark, STREAM_STATS, db, "stats")
    assert read_jdbc(spark, db, "stats").count() == 0


def test_password_is_not_shown():
    connection = Jdbc("jdbc:x", "d", "me", "secret")
    assert "secret" not in repr(connection)
    assert connection.as_options() == {
        "url": "jdbc:x", "driver": "d", "user": "me", "password": "secret",
    }


def _session(master, **setting):
    """What `database` looks at of a session."""
    conf = {f"spark.podium.jdbc.{part}": value for part, value in setting.items()}
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["local-cluster[3,2,5000]", "spark://host:7077", "yarn"])
def test_executors_need_a_named_database(master):
    with pytest.raises(ValueError, match="spark.podium.jdbc.url"):
        database(_session(master))
    assert database(_session(master, url="jdbc:x", driver="d")) == Jdbc("jdbc:x", "d")


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*,4]"])
def test_one_process_may_use_a_database_of_its_own(master):
    assert database(_session(master)).url.startswith("jdbc:derby:memory:")


# Jobs


def test_publish_table(spark, db, tmp_path):
    write_jdbc(results(spark), db, "results")
    topic = FileTopic(str(tmp_path / "topic"))
    publish_table(spark, db, "results", topic, key="athlete_id")
    messages = topic.batch(spark)
    assert messages.dtypes == [("key", "binary"), ("value", "binary")]
    keys = [r[0] for r in messages.select(F.col("key").cast("string")).collect()]
    assert sorted(k or "" for k in keys) == ["", "1", "1", "2", "5", "7", "7", "8", "8", "9"]
    assert rows(parse_messages(messages, ATHLETE_EVENT_RESULTS)) == rows(results(spark))


def test_stream_from_and_to_the_database(spark, db, tmp_path):
    write_jdbc(results(spark), db, "results")
    write_jdbc(bio(spark), db, "bio")
    create_jdbc_table(spark, STREAM_STATS + ", batch_id BIGINT", db, "stats")
    topic = FileTopic(str(tmp_path / "topic"))
    publish_table(spark, db, "results", topic, key="athlete_id")
    for _ in range(2):  # the second run finds nothing new
        stream_stats(
            topic.stream(spark), read_jdbc(spark, db, "bio"),
            [jdbc_writer(db, "stats", batch_column="batch_id")],
            str(tmp_path / "checkpoint"), trigger=UNTIL_CAUGHT_UP,
        ).awaitTermination()
    stats = read_stats(spark, db, "stats")
    assert stats.columns[-1] == "batch_id" and as_stats(stats) == STATS
    keys = ["sport", "medal", "sex", "country_noc"]
    write_jdbc(stats.withColumn("batch_id", F.lit(9)).withColumn("avg_height", F.lit(0.0)), db, "stats")
    newest = read_stats(spark, db, "stats", keys)
    assert newest.count() == len(STATS)
    assert {r["avg_height"] for r in newest.collect()} == {0.0}


def test_round_trip_stats(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    reference = bio(spark).withColumn("athlete_id", F.col("athlete_id").try_cast("int"))
    spec = StatsSpec(
        "athlete_id", ["sport", "medal", "sex", "country_noc"],
        {"avg_height": "height", "avg_weight": "weight"}, stamp="calculated_at",
    )
    stats = round_trip_stats(spark, reference, results(spark), topic, ATHLETE_BIO, spec)
    assert stats.columns[-1] == "calculated_at"
    assert as_stats(stats) == STATS
    assert topic.batch(spark).count() == 5  # only athletes with both measures travel
    assert stats.count() == stats.dropDuplicates().count()


# Kafka: options only, there is no connector or broker here


def test_kafka_options():
    assert kafka_options("b:9092") == {"kafka.bootstrap.servers": "b:9092"}
    options = kafka_options("b:9092", "SASL_PLAINTEXT", "PLAIN", "me", 'se"cr\\et')
    assert options == {
        "kafka.bootstrap.servers": "b:9092",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config":
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            'username="me" password="se\\"cr\\\\et";',
    }
    assert "cr" not in repr(KafkaTopic(options, "t"))


class Recorder:
    """Stands in for a session's reader or a frame's writer and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        return self

    def __call__(self):
        return self

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self


def test_kafka_readers_and_writers_get_their_options(spark):
    session = Recorder()
    topic = KafkaTopic(kafka_options("b:9092"), "results")
    base = {"format": "kafka", "kafka.bootstrap.servers": "b:9092", "subscribe": "results"}
    topic.stream(session)
    assert session.told == {**base, "startingOffsets": "earliest"}
    session.told.clear()
    topic.stream(session, starting="latest", max_messages=1000, min_partitions=64)
    assert session.told == {
        **base, "startingOffsets": "latest", "maxOffsetsPerTrigger": 1000, "minPartitions": 64,
    }
    session.told.clear()
    topic.batch(session, min_partitions=8)
    assert session.told == {
        **base, "startingOffsets": "earliest", "endingOffsets": "latest", "minPartitions": 8,
    }


def test_without_the_connector_spark_says_so(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_topic_stream(spark, kafka_options("b:9092"), "t")
    with pytest.raises(AnalysisException, match="kafka"):
        publish(results(spark), kafka_options("b:9092"), "t", key="athlete_id")
    with pytest.raises(AnalysisException, match="kafka"):
        KafkaTopic(kafka_options("b:9092"), "t").writer()(results(spark), 0)


# Session


def test_scratch_folders_are_below_the_shared_folder(spark):
    shared = shared_dir(spark)
    assert shared == spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(f"{shared}/podium/x-")


class FakeSession:
    def __init__(self, master, checkpoint=None):
        self.conf = {} if checkpoint is None else {"spark.checkpoint.dir": checkpoint}
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_needs_a_shared_folder():
    assert shared_dir(FakeSession("yarn", "s3a://bucket/shared/")) == "s3a://bucket/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_dir(local) == local.folder == shared_dir(local)
