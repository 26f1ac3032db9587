"""Silver and gold kept up to date by what is new, equal to computing them anew.

Each step is given the number of its load. The tables remember it together with the rows, so a step that
is repeated after a failure changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.names import column
from podium.functions.text import KEEP_CLASS, NULL_TOKEN
from podium.operators.cleaning import clean_strings, deduplicate
from podium.operators.stats import GOLD, StatsSpec, measured_facts
from podium.session import scratch_dir
from podium.versions import Version, VersionedTable, bucket_of
from podium.storage import delete

# Partitions of a table that is kept up to date: what one load does not touch stays as it is. A table
# keeps the number it began with; a bucket of a large one should still be many files.
BUCKETS = 64
DIGEST, BUCKET = "_digest", "_bucket"
_SUM, _COUNT = "_sum_", "_count_"


def load_silver(
    bronze: DataFrame,
    silver: VersionedTable,
    load: int,
    keep: str = KEEP_CLASS,
    null_token: str | None = NULL_TOKEN,
    buckets: int = BUCKETS,
) -> Version:
    """Clean `bronze` rows and append those that `silver` does not have yet, each once.

    `silver` has to have :data:`BUCKET` as its partition. Every row carries a 64-bit digest of its
    columns, which is the key filter: of the old rows only digests are read, and only in the buckets
    that new rows fall in. New rows whose digest is not there are new. The others are compared with the
    old rows of equal digests, column by column, so a digest shared by chance loses no row.
    """
    spark = bronze.sparkSession
    rows = deduplicate(clean_strings(bronze, None, keep, null_token))
    names = rows.columns
    digest = F.xxhash64(*[column(name) for name in names])
    path = scratch_dir(spark, "silver-load")
    rows.withColumn(DIGEST, digest).withColumn(BUCKET, bucket_of([DIGEST], buckets)).write.parquet(path)
    new = spark.read.parquet(path)
    if silver.version() is not None:
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # `buckets` at most
        key = [BUCKET, DIGEST]
        old = silver.read(partitions=touched)
        known = old.select(*key).join(new.select(*key), key, "left_semi").distinct()
        place = {name: f"_{i}" for i, name in enumerate([*key, *names])}
        suspects = old.join(known, key, "left_semi").select(*[column(name).alias(own) for name, own in place.items()])
        same = reduce(
            lambda a, b: a & b, (new[f"`{name}`"].eqNullSafe(suspects[place[name]]) for name in [*key, *names])
        )
        new = new.join(suspects, same, "left_anti")
    version = silver.append(new.hint("rebalance", BUCKET), {"load": load})
    delete(spark, path)
    return version


def silver_rows(rows: DataFrame) -> DataFrame:
    """Rows of a silver table without what :func:`load_silver` has added."""
    return rows.drop(DIGEST, BUCKET)


def _sums(rows: DataFrame, spec: StatsSpec) -> DataFrame:
    measures = dict.fromkeys(spec.averages.values())
    sums = [F.sum(column(m).cast("double")).alias(f"{_SUM}{i}") for i, m in enumerate(measures)]
    counts = [F.count(column(m)).alias(f"{_COUNT}{i}") for i, m in enumerate(measures)]
    return rows.groupBy(*[column(name) for name in spec.group_by]).agg(*sums, *counts)


def update_gold(
    state: VersionedTable,
    load: int,
    new_facts: DataFrame,
    reference: DataFrame,
    old_facts: DataFrame | None = None,
    new_reference: DataFrame | None = None,
    spec: StatsSpec = GOLD,
    buckets: int = BUCKETS,
) -> Version:
    """Add what a load brings to the sums and counts of the groups in `state`.

    New facts meet the whole reference table, new rows included; old facts meet the new reference rows
    only. Together these are the rows that the full join gained, so the state is that of the full join,
    for any order in which facts and reference rows arrive. Rows are only ever added. `state` has to
    have :data:`BUCKET` as its partition; only buckets of changed groups are read and written again.
    """
    gained = [measured_facts(new_facts, reference, spec)]
    if old_facts is not None and new_reference is not None:
        gained.append(measured_facts(old_facts, new_reference, spec))
    sums = [_sums(rows, spec) for rows in gained]
    spark, path = new_facts.sparkSession, scratch_dir(new_facts.sparkSession, "gold-load")
    changed = reduce(DataFrame.unionByName, sums).withColumn(BUCKET, bucket_of(spec.group_by, buckets))
    changed.write.parquet(path)
    changed = spark.read.parquet(path)
    touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]  # `buckets` at most
    now = changed
    if state.version() is not None:
        now = now.unionByName(state.read(partitions=touched))
    totals = [name for name in changed.columns if name.startswith((_SUM, _COUNT))]
    keys = [column(name) for name in (*spec.group_by, BUCKET)]
    now = now.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in totals])
    version = state.replace_partitions(now.hint("rebalance", BUCKET), touched, {"load": load})
    delete(spark, path)
    return version


def gold_averages(state: VersionedTable, spec: StatsSpec = GOLD, stamp_value: Column | None = None) -> DataFrame:
    """The averages per group, as :func:`podium.operators.stats.reference_stats` gives them."""
    place = {m: i for i, m in enumerate(dict.fromkeys(spec.averages.values()))}

    def average(measure: str) -> Column:
        mean = F.col(f"{_SUM}{place[measure]}") / F.col(f"{_COUNT}{place[measure]}")
        return mean if spec.scale is None else F.round(mean, spec.scale)

    results = [average(measure).alias(name) for name, measure in spec.averages.items()]
    if spec.stamp is not None:
        results.append((F.current_timestamp() if stamp_value is None else stamp_value).alias(spec.stamp))
    return state.read().select(*[column(name) for name in spec.group_by], *results)


def load_increment(
    bronze: tuple[DataFrame, DataFrame],
    silver: tuple[VersionedTable, VersionedTable],
    state: VersionedTable,
    load: int,
    spec: StatsSpec = GOLD,
    buckets: int = BUCKETS,
) -> Version:
    """One load through silver and gold; the pairs are the reference table and the facts.

    After a failure, the same load is given again: steps that were completed are passed over. Between
    the loads the silver tables are only appended to.
    """
    before: list[int | None] = []
    for rows, table in zip(bronze, silver):
        version = table.version()
        loaded = table.has("load", load)
        number = -1 if version is None else version.number - loaded
        before.append(None if number < 0 else number)
        if not loaded:
            load_silver(rows, table, load, buckets=buckets)
    if state.has("load", load):
        return state.version()
    reference, facts = silver
    old_facts = None if before[1] is None else silver_rows(facts.read(before[1]))
    return update_gold(
        state, load,
        silver_rows(facts.added(before[1])), silver_rows(reference.read()),
        old_facts, silver_rows(reference.added(before[0])), spec, buckets,
    )
