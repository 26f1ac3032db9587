"""Grouped averages of facts joined to a reference table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from podium.functions.names import column, folded
from podium.functions.numbers import as_whole
from podium.functions.text import NULL_TOKEN
from podium.operators.cleaning import numeric_rows
from podium.operators.joins import join_reference


@dataclass(frozen=True)
class StatsSpec:
    """What :func:`reference_stats` computes.

    `averages` maps output names to measures, in output order. `scale` is the number of decimals,
    None for unrounded. `stamp` names the column with the processing time, None for none.
    `measure_type` is the type measures are converted to before averaging; the average itself is
    always a double, so ``float`` measures show float rounding in it. `key_type`, where set, is
    the whole-number type both keys are converted to. `null_key` is the text that stands for a
    missing key, as the cleaner writes it: rows with it are nobody's and are not joined. None joins
    them like any other key.
    """

    key: str
    group_by: Sequence[str]
    averages: Mapping[str, str] = field(default_factory=dict)
    measure_type: str = "double"
    scale: int | None = None
    stamp: str | None = None
    key_type: str | None = None
    reference_first: bool = False
    drop_nan: bool = False
    null_key: str | None = NULL_TOKEN

    def __post_init__(self) -> None:
        if not all(isinstance(name, str) for name in self.group_by):
            raise TypeError("group_by takes column names; add a computed column to the facts first")

    def columns(self) -> list[str]:
        """Names of the input columns: key, groups and measures."""
        return list(dict.fromkeys([self.key, *self.group_by, *self.averages.values()]))


# Grouping, rounding, measure type and column order of the two published results.
GOLD = StatsSpec(
    key="athlete_id",
    group_by=("sport", "medal", "sex", "country_noc"),
    averages={"avg_weight": "weight", "avg_height": "height"},
    measure_type="float",
    scale=2,
    stamp="timestamp",
    reference_first=True,
)
STREAM = StatsSpec(
    key="athlete_id",
    group_by=("sport", "medal", "sex", "country_noc"),
    averages={"avg_height": "height", "avg_weight": "weight"},
    measure_type="double",
    scale=3,
    stamp="timestamp",
    key_type="int",
)


def group_averages(
    df: DataFrame,
    group_by: Sequence[str | Column],
    averages: Mapping[str, str],
    scale: int | None = None,
    stamp: str | None = None,
    stamp_value: Column | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Averages of measures per group, rounded half up to `scale` decimals.

    Rows with a null in a grouping column form a group of their own. `stamp` adds the processing
    time, one value per query (per micro-batch on a stream), or `stamp_value` where given. `rows`
    names a column, placed before the averages, with the number of rows of the group.

    Sums and counts are built per task before the shuffle, so the shuffle carries one row per
    group and task however unevenly the groups are filled.
    """

    def average(measure: str) -> Column:
        mean = F.avg(column(measure))
        return mean if scale is None else F.round(mean, scale)

    results = [] if rows is None else [F.count(F.lit(1)).alias(rows)]
    results += [average(measure).alias(name) for name, measure in averages.items()]
    if stamp is not None:
        now = F.current_timestamp() if stamp_value is None else stamp_value
        results.append(now.alias(stamp))
    keys = [column(key) for key in group_by]
    return df.groupBy(*keys).agg(*results)


def measured_facts(
    facts: DataFrame, reference: DataFrame, spec: StatsSpec, hot: Sequence[Any] = ()
) -> DataFrame:
    """Facts with their reference row, restricted to rows whose measures are numbers.

    Only the columns the statistics need go into the join. A measure is converted on the side it
    comes from, before the join, so rows that cannot count are dropped before any shuffle.
    """
    spark = facts.sparkSession
    wanted = folded(spark, spec.columns()) - (
        folded(spark, facts.columns) - folded(spark, [spec.key])
    )
    reference = reference.select(
        *[column(c) for c in reference.columns if folded(spark, [c]) <= wanted]
    )
    sides = []
    for side in (facts, reference):
        kind = side.select(column(spec.key)).schema[0].dataType
        if spec.null_key is not None and isinstance(kind, StringType):
            # Not a plain comparison, which would be pushed down: a database may keep text as a
            # large object, which it cannot compare.
            side = side.filter(F.concat(column(spec.key), F.lit("")) != spec.null_key)
        if spec.key_type not in (None, kind.simpleString()):
            side = side.withColumn(spec.key, as_whole(spec.key, spec.key_type))
        names = folded(spark, side.columns)
        measures = [m for m in dict.fromkeys(spec.averages.values()) if folded(spark, [m]) <= names]
        sides.append(numeric_rows(side, measures, spec.measure_type, spec.drop_nan))
    return join_reference(*sides, key=spec.key, reference_first=spec.reference_first, hot=hot)


def reference_stats(
    facts: DataFrame,
    reference: DataFrame,
    spec: StatsSpec,
    hot: Sequence[Any] = (),
    stamp_value: Column | None = None,
) -> DataFrame:
    """Join `facts` to `reference` and average the measures per group.

    Works on a batch frame and, with streaming `facts`, as a running aggregate.
    """
    return group_averages(
        measured_facts(facts, reference, spec, hot),
        spec.group_by,
        spec.averages,
        spec.scale,
        spec.stamp,
        stamp_value,
    )
