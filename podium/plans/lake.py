"""Landing files to gold averages, one layer at a time.

The layers hand over through Parquet folders, so each step can be run again on its own. No step
looks at its rows on the driver, each computes its plan once, and each sizes its shuffles by its
input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from podium.functions.text import KEEP_CLASS, NULL_TOKEN
from podium.operators.cleaning import clean_strings, deduplicate
from podium.operators.joins import plan_bytes
from podium.operators.stats import GOLD, StatsSpec, reference_stats
from podium.schemas import GOLD_TABLE, TABLES
from podium.session import sized_shuffles
from podium.sinks.lake import write_layer
from podium.sources.lake import layer_path, read_landing_csv, read_layer
from podium.streaming.tables import bucketed_snapshot


def _side_by_side(
    spark: SparkSession, tables: Sequence[str], step: Callable[[str], object]
) -> None:
    """Run `step` for every table at once: one table's last tasks leave room for the next one's."""
    target = inheritable_thread_target(spark)(step)
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        for done in [pool.submit(target, table) for table in tables]:
            done.result()


def landing_to_bronze(
    spark: SparkSession,
    landing: str,
    lake: str,
    tables: Sequence[str] = TABLES,
    versions: bool = False,
    **csv_options: Any,
) -> None:
    """``<landing>/<table>.csv`` to the bronze layer, as text.

    Here and in the next steps, `versions` keeps the old table until the new one is complete, see
    :func:`podium.sinks.lake.write_layer`.
    """

    def step(table: str) -> None:
        rows = read_landing_csv(spark, f"{landing.rstrip('/')}/{table}.csv", **csv_options)
        write_layer(rows, lake, "bronze", table, versions)

    _side_by_side(spark, tables, step)


def bronze_to_silver(
    spark: SparkSession,
    lake: str,
    tables: Sequence[str] = TABLES,
    keep: str = KEEP_CLASS,
    null_token: str | None = NULL_TOKEN,
    versions: bool = False,
) -> None:
    """Bronze to silver: clean all text, then drop rows that have become equal."""
    bronze = {table: read_layer(spark, lake, "bronze", table) for table in tables}

    def step(table: str) -> None:
        rows = clean_strings(bronze[table], None, keep, null_token)
        write_layer(deduplicate(rows), lake, "silver", table, versions)

    with sized_shuffles(spark, max(map(plan_bytes, bronze.values()), default=0)):
        _side_by_side(spark, tables, step)


def silver_to_gold(
    spark: SparkSession,
    lake: str,
    spec: StatsSpec = GOLD,
    tables: Sequence[str] = TABLES,
    gold_table: str = GOLD_TABLE,
    stamp_value: Column | None = None,
    versions: bool = False,
    silver: Sequence[DataFrame] | None = None,
) -> str:
    """Silver to gold: averages per group. `tables` are the reference table and the facts.

    `silver` has their frames, where they are not those of the layer: such as the catalog tables of
    :func:`silver_by_key`, which are joined without a shuffle.
    """
    reference, facts = silver or (read_layer(spark, lake, "silver", table) for table in tables)
    stats = reference_stats(facts, reference, spec, stamp_value=stamp_value)
    with sized_shuffles(spark, plan_bytes(facts) + plan_bytes(reference)):
        return write_layer(stats, lake, "gold", gold_table, versions)


def silver_by_key(
    spark: SparkSession,
    lake: str,
    key: str,
    buckets: int,
    tables: Sequence[str] = TABLES,
    database: str = "default",
) -> list[DataFrame]:
    """The silver tables as catalog tables ``silver_<table>`` in `buckets` files by `key`, sorted.

    They lie below the lake, in ``silver_by_key``. Each table is dealt out once, when it is written;
    every join on the key after that merges bucket with bucket as they lie, and shuffles nothing. That
    pays as soon as a table is joined more than once, and only for sides too big to broadcast. Choose
    `buckets` so that one of the larger table is read by one task.
    """
    frames = []
    for table in tables:
        rows = read_layer(spark, lake, "silver", table)
        name, path = f"{database}.silver_{table}", layer_path(lake, "silver_by_key", table)
        frames.append(bucketed_snapshot(rows, name, path, key, buckets))
    return frames


def run_lake(
    spark: SparkSession,
    landing: str,
    lake: str,
    spec: StatsSpec = GOLD,
    tables: Sequence[str] = TABLES,
    gold_table: str = GOLD_TABLE,
    versions: bool = False,
) -> str:
    """All three steps in order; the first failure ends the run. Returns the gold path."""
    landing_to_bronze(spark, landing, lake, tables, versions)
    bronze_to_silver(spark, lake, tables, versions=versions)
    return silver_to_gold(spark, lake, spec, tables, gold_table, versions=versions)
