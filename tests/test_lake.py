"""Files, layers and the lake jobs."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from podium.operators import clean_strings, deduplicate
from podium.plans import bronze_to_silver, landing_to_bronze, run_lake, silver_to_gold
from podium.schemas import GOLD_STATS
from podium.session import sized_shuffles
from podium.sinks import write_layer
from podium.sources import empty_like, layer_path, read_landing_csv, read_layer
from tests.athletes import bio, results
from tests.settings import session_conf


def write_text(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Sources and sinks


def test_csv_reads_text_with_reader_defaults(spark, tmp_path):
    path = write_text(
        tmp_path / "t.csv",
        'id,height,note\n1,180,"a, b"\n2,,"say \\"hi\\""\n3,x,"line\nbreak"\n',
    )
    df = read_landing_csv(spark, path)
    assert df.dtypes == [("id", "string"), ("height", "string"), ("note", "string")]
    got = rows(df)
    assert ("1", "180", "a, b") in got and ("2", None, 'say "hi"') in got
    # A quoted line break splits the row unless asked otherwise.
    assert len(got) == 4
    assert read_landing_csv(spark, path, multiLine=True).count() == 3


def test_layer_round_trip_and_replace(spark, tmp_path):
    lake = str(tmp_path)
    assert write_layer(spark.range(3), lake, "bronze", "t") == f"{lake}/bronze/t"
    write_layer(spark.range(5), lake + "/", "bronze", "t")
    assert read_layer(spark, lake, "bronze", "t").count() == 5
    assert layer_path("s3a://b/", "gold", "t") == "s3a://b/gold/t"


def test_a_layer_is_not_overwritten_with_itself(spark, tmp_path):
    lake = str(tmp_path)
    write_layer(spark.range(3), lake, "bronze", "t")
    write_layer(spark.range(3), lake, "bronze", "t2")
    again = read_layer(spark, lake, "bronze", "t").filter("id > 0").union(spark.range(1))
    with pytest.raises(ValueError, match="input of the frame"):
        write_layer(again, lake, "bronze", "t")
    assert read_layer(spark, lake, "bronze", "t").count() == 3
    # A neighbour whose name starts alike is not an input.
    write_layer(read_layer(spark, lake, "bronze", "t2"), lake, "bronze", "t")


def test_empty_like(spark):
    df = empty_like(spark, GOLD_STATS)
    assert df.count() == 0
    assert dict(df.dtypes)["timestamp"] == "timestamp"


def test_shuffles_follow_the_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with sized_shuffles(spark, 10**9):
        assert spark.conf.get(name, None) is None  # the usual number is enough
    with sized_shuffles(spark, 10**12):
        assert spark.conf.get(name) == "3726"
        # Really used, and merged again where there is little to shuffle.
        spread = spark.range(10_000).selectExpr("id % 100 AS k").groupBy("k").count()
        spread.collect()
        plan = spread._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" in plan and ", 3726)" in plan and "AQEShuffleRead" in plan
    assert spark.conf.get(name, None) is None
    with pytest.raises(RuntimeError), sized_shuffles(spark, 10**14):
        assert spark.conf.get(name) == "372530"  # no upper limit
        raise RuntimeError
    assert spark.conf.get(name, None) is None
    with session_conf(spark, {name: "12"}), sized_shuffles(spark, 10**14):
        assert spark.conf.get(name) == "12"


# Jobs


@pytest.fixture
def landing(spark, tmp_path):
    tables = {"athlete_bio": bio(spark), "athlete_event_results": results(spark)}
    for name, df in tables.items():
        df.coalesce(1).write.option("header", True).csv(str(tmp_path / "landing" / f"{name}.csv"))
    return str(tmp_path / "landing")


GOLD = {
    # Ed's "176-180" becomes 176180 once the hyphen is gone, Di's "63,65" stays no number.
    ("Golf", "Gold", "M", "ESP"): (75.0, 176180.0),
    ("Judo", "Gold", "F", "GBR"): (70.0, 180.0),
    ("Judo", "Gold", "F", "NZL"): (70.0, 180.0),
    ("Judo", "Gold", "M", "CUB"): (100.0, 200.0),
    ("Judo", "None", "F", "CUB"): (50.0, 160.0),
    ("Judo", "Silver", "M", "NOR"): (90.5, 190.0),
    # The keyless result and the keyless athlete both became "None"; they do not meet.
}


def test_landing_to_gold(spark, tmp_path, landing):
    lake = str(tmp_path / "lake")
    gold = spark.read.parquet(run_lake(spark, landing, lake))
    assert gold.columns == [
        "sport", "medal", "sex", "country_noc", "avg_weight", "avg_height", "timestamp",
    ]
    assert gold.schema.simpleString() == empty_like(spark, GOLD_STATS).schema.simpleString()
    got = {tuple(r[:4]): (r["avg_weight"], r["avg_height"]) for r in gold.collect()}
    assert got == GOLD
    assert gold.select("timestamp").distinct().count() == 1


def test_steps_can_be_repeated(spark, tmp_path, landing):
    lake = str(tmp_path / "lake")
    landing_to_bronze(spark, landing, lake)
    bronze = read_layer(spark, lake, "bronze", "athlete_bio")
    assert {t for _, t in bronze.dtypes} == {"string"}
    assert bronze.filter("name = 'Ann Lee'").count() == 1
    for _ in range(2):
        bronze_to_silver(spark, lake)
        silver = read_layer(spark, lake, "silver", "athlete_bio")
        assert silver.filter("name = 'AnnLee' AND country = 'GreatBritain'").count() == 1
        assert silver.filter("name = 'Zo'").first()["description"] == 'say"hi"'
        assert silver_to_gold(spark, lake) == f"{lake}/gold/avg_stats"
    results_silver = read_layer(spark, lake, "silver", "athlete_event_results")
    assert results_silver.filter("medal IS NULL").count() == 0
    assert results_silver.filter("medal = 'None'").count() == 2


def test_duplicates_do_not_weigh_in(spark, tmp_path):
    write_text(
        tmp_path / "l" / "athlete_bio.csv",
        "athlete_id,sex,height,weight\n1,M,180,70\n1,M,1-80,70\n2,M,190,80\n",
    )
    write_text(
        tmp_path / "l" / "athlete_event_results.csv",
        "athlete_id,sport,medal,country_noc,event\n"
        "1,Judo,Gold,NOR,A B\n1,Judo,Gold,NOR,AB\n2,Judo,Gold,NOR,AB\n",
    )
    gold = spark.read.parquet(run_lake(spark, str(tmp_path / "l"), str(tmp_path / "lake")))
    assert gold.drop("timestamp").collect() == [("Judo", "Gold", "M", "NOR", 75.0, 185.0)]


def test_a_failing_step_ends_the_run(spark, tmp_path):
    write_text(tmp_path / "l" / "athlete_bio.csv", "athlete_id\n1\n")
    with pytest.raises(PySparkException):
        run_lake(spark, str(tmp_path / "l"), str(tmp_path / "lake"))
    assert not (tmp_path / "lake" / "silver").exists()


def test_silver_needs_one_exchange_and_no_python(spark, tmp_path):
    write_layer(spark.range(100).selectExpr("CAST(id AS STRING) a"), str(tmp_path), "bronze", "t")
    plan = deduplicate(clean_strings(read_layer(spark, str(tmp_path), "bronze", "t")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Python" not in text
    assert plan.agg(F.count("*")).first()[0] == 100
