"""Facts joined to their reference table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.names import column, folded

_SALT = "__salt"


def join_reference(
    facts: DataFrame,
    reference: DataFrame,
    key: str,
    reference_first: bool = False,
    hot: Sequence[Any] = (),
    ways: int = 16,
) -> DataFrame:
    """Inner equi-join on `key`, which appears once and first, followed by the left side's columns.

    Columns both sides have (other than the key) are taken from the facts; names are compared as the
    session compares them, by default without case. Null keys and facts without a reference row
    drop out.

    No side is broadcast by hand: Spark broadcasts one when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges. In a batch job,
    adaptive execution splits a hot key's partition at run time, so nothing else is needed. A
    stateful stream runs without adaptive execution; there, name the heavy keys in `hot` (see
    :func:`hot_keys`): their facts are dealt out over `ways` tasks and only their reference rows
    are repeated, `ways` times. The result is the same for any choice of `hot`.

    `facts` should be a scan with projections and filters when `hot` is used. The salt is drawn
    from a seeded generator in scan order, so that a task that is run again after a lost executor
    draws the same salts.
    """
    spark = facts.sparkSession
    taken = folded(spark, facts.columns) - folded(spark, [key])
    shared = [name for name in reference.columns if folded(spark, [name]) <= taken]
    reference = reference.drop(*shared)
    on = [key]
    if hot:
        on.append(_SALT)
        is_hot = column(key).isin(list(hot))
        facts = facts.filter(column(key).isNotNull()).withColumn(
            _SALT,
            F.when(is_hot, F.floor(F.rand(seed=17) * ways).cast("int")).otherwise(F.lit(0)),
        )
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(
            F.array(F.lit(0))
        )
        reference = reference.withColumn(_SALT, F.explode(copies))
    left, right = (reference, facts) if reference_first else (facts, reference)
    return left.join(right, on=on, how="inner").drop(_SALT)


def hot_keys(df: DataFrame, key: str, share: float = 0.05) -> list[Any]:
    """Keys that hold more than `share` of the rows of the batch frame `df`.

    One pass keeps a sketch of frequent keys, whose size depends on `share` alone and which misses
    no key of that share; a second one counts the keys it names, and no others. The list has at
    most ``1 / share`` entries, whatever the size of the data.
    """
    named = int(2 / share)
    sketch = F.call_function("approx_top_k", column(key), F.lit(named), F.lit(20 * named))
    rows, top = df.agg(F.count(F.lit(1)), sketch).first()
    candidates = [row["item"] for row in top or () if row["item"] is not None]
    if not candidates:
        return []
    counts = df.filter(column(key).isin(candidates)).groupBy(column(key).alias("key")).count()
    found = sorted(counts.collect(), key=lambda row: -row["count"])
    return [row["key"] for row in found if row["count"] > rows * share]


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of `df`; for a scan of files, the size of the files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark, by its size estimate and threshold, would broadcast `df` in a join."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return plan_bytes(df) <= conf.autoBroadcastJoinThreshold()
