"""Layout by several columns, even ranges, references by version, payloads without a schema."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from podium.operators import along_curve, as_of, parse_variants, payload_schema, quantile_bounds, variant_fields
from podium.sources import quantile_predicates


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files_with(path, **ranges):
    """Files that may hold rows inside all ranges, by their smallest and largest values, and all files."""
    kept, names = 0, glob.glob(f"{path}/*.parquet")
    for name in names:
        meta = pq.ParquetFile(name).metadata
        fits = True
        for k in range(meta.num_columns):
            column = meta.row_group(0).column(k)
            if column.path_in_schema in ranges and column.statistics.has_min_max:
                low, high = ranges[column.path_in_schema]
                fits &= column.statistics.min <= high and column.statistics.max >= low
        kept += fits
    return kept, len(names)


@pytest.mark.parametrize("uneven", [False, True])
def test_a_filter_on_both_columns_passes_over_most_files(spark, tmp_path, uneven):
    spread = (F.pow(F.rand(1), 6 if uneven else 1) * 100_000).cast("int")
    df = spark.range(40_000).select("id", spread.alias("a"), (F.rand(2) * 1000).cast("int").alias("b"))
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    along_curve(df, ["a", "b"], 64).write.parquet(str(tmp_path / "curve"))
    low, high = df.agg(F.percentile_approx("a", F.array(F.lit(0.4), F.lit(0.5)))).first()[0]
    for ranges in ({"a": (low, high), "b": (300, 400)}, {"a": (low, high)}, {"b": (300, 400)}):
        kept, files = files_with(tmp_path / "curve", **ranges)
        assert files >= 56 and kept < files * (0.25 if len(ranges) == 2 else 0.5)
    assert rows(spark.read.parquet(str(tmp_path / "curve"))) == rows(df)


def test_curves_of_nulls_text_and_no_rows(spark, tmp_path):
    data = [(None, "x"), (1, None), (2, "é"), (2, "é"), (None, None)]
    df = spark.createDataFrame(data, "a int, b string")
    assert rows(along_curve(df, ["a"], 3)) == rows(df)
    assert rows(along_curve(df.limit(0), ["a"], 3)) == []
    dates = spark.range(100).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    assert rows(along_curve(dates, ["d", "id"], 4)) == rows(dates)


def test_bounds_part_rows_evenly(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("x"), F.lit(5).alias("same"), F.lit(None).cast("int").alias("none"))
    squares, same, none = quantile_bounds(df, ["x", "same", "none"], 4)
    assert [round(b**0.5) for b in squares] == pytest.approx([250, 500, 750], abs=2)
    assert same == [5] and none == []


def test_even_ranges_of_uneven_ids(spark):
    """Nine in ten ids lie in a hundredth of the range."""
    chance = random.Random(1)
    ids = [chance.randrange(10_000) if k % 10 else chance.randrange(1_000_000) for k in range(5000)] + [None] * 20
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    ranges = quantile_predicates(df, "id", 16, "`")
    counts = [df.where(text).count() for text in ranges]
    assert sum(counts) == len(ids) and len(ranges) == 16
    assert max(counts) < 2 * sum(counts) / len(counts)
    assert quantile_predicates(df.limit(0), "id", 8) == ['"id" IS NULL OR "id" IS NOT NULL']
    one = spark.createDataFrame([(7,)] * 50 + [(None,)], "id long")
    assert sum(one.where(text).count() for text in quantile_predicates(one, "id", 8, "`")) == 51
    assert quantile_predicates(one, 'a"b', 4) if 'a"b' in one.columns else True


def day(n):
    return dt.datetime(2024, 1, n)


def test_reference_rows_by_time(spark):
    versions = spark.createDataFrame(
        [(1, None, "old", 1), (1, day(5), "mid", 2), (1, day(9), "new", 3), (2, day(3), "only", 4), (2, day(3), "also", 9), (None, None, "x", 5)],
        "id int, since timestamp, name string, note int",
    )
    facts = spark.createDataFrame(
        [(1, day(1), "a"), (1, day(5), "b"), (1, day(8), "c"), (1, day(20), "d"), (2, day(2), "e"), (2, day(4), "f"),
         (None, day(4), "g"), (1, None, "h"), (3, day(4), "i")],
        "id int, at timestamp, note string",
    )
    got = as_of(facts, versions, "id", "at", "since")
    assert got.columns == ["id", "at", "note", "name"]
    assert {r.note: r.name for r in got.collect()} == {"a": "old", "b": "mid", "c": "mid", "d": "new", "f": "only"}


def test_reference_rows_by_time_on_a_stream(spark, tmp_path):
    versions = spark.createDataFrame([(1, None, "old"), (1, day(5), "new")], "id int, since timestamp, name string")
    facts = spark.createDataFrame([(1, day(4)), (1, day(6))], "id int, at timestamp")
    facts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(facts.schema).parquet(str(tmp_path / "in"))
    query = as_of(stream, versions, "id", "at", "since").writeStream.trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "c")).format("parquet").start(str(tmp_path / "out")).awaitTermination()
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("name").sort("at").collect()] == ["old", "new"]


def test_payloads_without_a_schema(spark):
    texts = ['{"a": 1, "b": {"c": [1, 2]}}', '{"a": "x", "d": true}', '{"a": 2.5}', "no json", None, "[1]", '"text"', '{"b": 7}']
    messages = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    parsed = parse_variants(messages, carry=["n"])
    assert parsed.columns == ["n", "payload"]
    got = variant_fields(parsed, {"a": ("$.a", "int"), "t": ("$.a", "string"), "c": ("$.b.c[1]", "int"), "d": ("$.d", "boolean")})
    assert got.columns == ["n", "a", "t", "c", "d"]
    found = {r.n: tuple(r)[1:] for r in got.collect()}
    assert found[0] == (1, "1", 2, None) and found[1] == (None, "x", None, True) and found[2][1] == "2.5"
    assert all(found[k] == (None,) * 4 for k in (3, 4, 5, 6, 7))
    schema = payload_schema(messages.where("n in (0, 1)"))
    assert schema.startswith("OBJECT<") and "a: VARIANT" in schema and "c: ARRAY<BIGINT>" in schema and "d: BOOLEAN" in schema
