"""The commands, run in the test's session."""

import uuid

import pytest

from podium import cli
from podium.cli import main
from podium.plans import FileTopic
from podium.session import KAFKA_CONNECTOR
from podium.sinks import write_jdbc
from podium.sources import Jdbc, read_jdbc, read_layer
from tests.athletes import BIO_TEXT, STATS, as_stats, bio, results


def test_lake_steps(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    bio(spark).write.option("header", True).csv(f"{landing}/athlete_bio.csv")
    results(spark).write.option("header", True).csv(f"{landing}/athlete_event_results.csv")
    main(["landing-to-bronze", "--landing", landing, "--lake", lake], spark)
    main(["bronze-to-silver", "--lake", lake], spark)
    main(["silver-to-gold", "--lake", lake], spark)
    apart = spark.read.parquet(f"{lake}/gold/avg_stats").drop("timestamp").collect()
    main(["lake", "--landing", landing, "--lake", f"{lake}2"], spark)
    at_once = spark.read.parquet(f"{lake}2/gold/avg_stats").drop("timestamp").collect()
    assert sorted(apart) == sorted(at_once) and len(apart) == 6
    for _ in range(2):
        main(["lake", "--landing", landing, "--lake", f"{lake}3", "--versions"], spark)
    versions = read_layer(spark, f"{lake}3", "gold", "avg_stats").drop("timestamp").collect()
    assert sorted(versions) == sorted(at_once)


def test_stream_steps(spark, tmp_path, monkeypatch, capsys):
    db = Jdbc(
        f"jdbc:derby:memory:cli{uuid.uuid4().hex};create=true",
        "org.apache.derby.jdbc.EmbeddedDriver",
    )
    monkeypatch.setenv("PODIUM_JDBC_URL", db.url)
    monkeypatch.setenv("PODIUM_JDBC_DRIVER", db.driver)
    write_jdbc(bio(spark), db, "bio")
    write_jdbc(results(spark), db, "results")
    source, target = f"files:{tmp_path}/in", f"files:{tmp_path}/out"
    main(["create-table", "--table", "stats"], spark)
    main(
        ["publish", "--table", "results", "--topic", source, "--key", "athlete_id",
         "--split", "athlete_id", "--tasks", "3"],
        spark,
    )
    main(
        ["stream", "--topic", source, "--reference", "bio", "--to-topic", target,
         "--to-table", "stats", "--checkpoint", f"{tmp_path}/c", "--catch-up",
         "--snapshot", f"{tmp_path}/bio"],
        spark,
    )
    assert as_stats(read_jdbc(spark, db, "stats")) == STATS
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(STATS)
    main(["read-stats", "--table", "stats", "--latest", "--rows", "3"], spark)
    shown = capsys.readouterr().out
    assert "avg_height: double" in shown and "only showing top 3 rows" in shown


def test_fan_out_and_round_trip(spark, tmp_path):
    source = FileTopic(f"{tmp_path}/in")
    source.publish(spark.createDataFrame([("a", 1.5), ("b", None)], "device STRING, t DOUBLE"))
    main(
        ["fan-out", "--topic", f"files:{tmp_path}/in", "--to-topic", f"files:{tmp_path}/copy",
         "--to-files", f"{tmp_path}/files", "--schema", "device STRING, t DOUBLE",
         "--checkpoint", f"{tmp_path}/c", "--max-bytes", "1000000", "--catch-up"],
        spark,
    )
    rows = spark.read.parquet(f"{tmp_path}/files")
    assert {"run", "batch_id", "processed_at"} < set(rows.columns)
    assert sorted(r["device"] for r in rows.collect()) == ["a", "b"]
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 2
    bio(spark).write.parquet(f"{tmp_path}/bio")
    results(spark).write.parquet(f"{tmp_path}/results")
    main(
        ["round-trip", "--reference", f"files:{tmp_path}/bio", "--facts", f"files:{tmp_path}/results",
         "--topic", f"files:{tmp_path}/t", "--to-files", f"{tmp_path}/out",
         "--schema", BIO_TEXT],
        spark,
    )
    assert as_stats(spark.read.parquet(f"{tmp_path}/out")) == STATS


def test_limits_of_the_other_kind_of_topic_are_refused(spark, tmp_path, monkeypatch):
    common = ["--topic", f"files:{tmp_path}/in", "--to-topic", "files:x", "--checkpoint", f"{tmp_path}/c"]
    for extra in (["--max-messages", "5"], ["--starting", "latest"]):
        with pytest.raises(SystemExit, match="Kafka"):
            main(["fan-out", *common, *extra], spark)
    with pytest.raises(SystemExit, match="needs --to-topic"):
        main(["fan-out", "--topic", "files:x", "--checkpoint", f"{tmp_path}/c"], spark)
    monkeypatch.setenv("PODIUM_KAFKA_BOOTSTRAP", "nowhere:9092")
    with pytest.raises(SystemExit, match="message files"):
        main(["fan-out", "--topic", "t", *common[2:], "--max-bytes", "5"], spark)


def test_a_kafka_topic_brings_its_connector(monkeypatch):
    asked = {}

    def session(name, packages, jars):
        asked.update(packages=packages, jars=jars)
        raise SystemExit("no session")

    monkeypatch.setattr(cli, "build_session", session)
    for topic, packages in (("t", [KAFKA_CONNECTOR, "a:b:1"]), ("files:t", ["a:b:1"])):
        with pytest.raises(SystemExit, match="no session"):
            main(["--package", "a:b:1", "--jar", "x.jar", "fan-out", "--topic", topic, "--checkpoint", "c"])
        assert asked == {"packages": packages, "jars": ["x.jar"]}


def test_missing_connections_are_named(spark, monkeypatch):
    monkeypatch.delenv("PODIUM_JDBC_URL", raising=False)
    monkeypatch.delenv("PODIUM_KAFKA_BOOTSTRAP", raising=False)
    with pytest.raises(SystemExit, match="PODIUM_JDBC_URL"):
        main(["create-table", "--table", "t"], spark)
    monkeypatch.setenv("PODIUM_JDBC_URL", "jdbc:derby:memory:none")
    monkeypatch.setenv("PODIUM_JDBC_DRIVER", "org.apache.derby.jdbc.EmbeddedDriver")
    with pytest.raises(SystemExit, match="PODIUM_KAFKA_BOOTSTRAP"):
        main(["publish", "--table", "t", "--topic", "t"], spark)
