"""Effectively-once delivery to sinks that can only append.

A micro-batch that failed is delivered again, and a sink that had taken some or all of it takes it
twice. Every attempt at writing a batch therefore marks its rows, and a ledger says which attempt
counts. It is entered after the sink has taken everything, so an attempt that is in the ledger is
complete, and rows of the others are left out on reading.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium import storage
from podium.operators.history import merged
from podium.sinks.fan_out import Writer
from podium.versions import VersionedTable, bucket_of

ATTEMPT = "attempt"
_ENTRY = "sink STRING, run BIGINT, batch_id BIGINT, attempt STRING"


class Ledger:
    """The attempts that count, below `path` on storage all executors share.

    An entry is a file of its own, moved into place complete. :meth:`fold` puts the entries of long
    runs together. Sinks of several streams may share a ledger if their names differ.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._folded = VersionedTable(spark, f"{self.path}/folded")

    def _folder(self, sink: str, run: int) -> str:
        return f"{self.path}/entries/{sink}/{run}"

    def has(self, sink: str, batch_id: int, run: int = 0) -> bool:
        """Whether that batch is in the ledger."""
        if f"{batch_id}.json" in storage.names(self.spark, self._folder(sink, run)):
            return True
        return self._folded.has(f"{sink}/{run}", batch_id)

    def enter(self, sink: str, batch_id: int, attempt: str, run: int = 0) -> None:
        """The attempt that counts for a batch; the first one entered stays."""
        entry = {"sink": sink, "run": run, "batch_id": batch_id, ATTEMPT: attempt}
        storage.write_new(self.spark, f"{self._folder(sink, run)}/{batch_id}.json", json.dumps(entry))

    def _loose(self) -> list[tuple[str, str, str]]:
        root = f"{self.path}/entries"
        return [
            (sink, run, name)
            for sink in storage.names(self.spark, root)
            for run in storage.names(self.spark, f"{root}/{sink}")
            for name in storage.names(self.spark, f"{root}/{sink}/{run}")
            if name.endswith(".json") and not name.startswith(".")
        ]

    def entries(self, sink: str | None = None) -> DataFrame:
        """All entries, of all sinks or of one: one row per batch, a few bytes each."""
        paths = [f"{self.path}/entries/{s}/{run}/{name}" for s, run, name in self._loose()]
        found = self.spark.createDataFrame([], _ENTRY)
        if paths:
            found = self.spark.read.schema(_ENTRY).json(paths)
        if self._folded.version() is not None:
            found = found.unionByName(self._folded.read())
        return (found if sink is None else found.where(F.col("sink") == sink)).distinct()

    def fold(self) -> None:
        """Put all entries into one table; only then are their files deleted."""
        loose = self._loose()
        if not loose:
            return
        last: dict[str, int] = {}
        for sink, run, name in loose:
            key = f"{sink}/{run}"
            last[key] = max(last.get(key, -1), int(name.removesuffix(".json")))
        self._folded.replace(self.entries().coalesce(1), last)
        for sink, run, name in loose:
            storage.delete(self.spark, f"{self.path}/entries/{sink}/{run}/{name}")


def once(write: Writer, ledger: Ledger, sink: str, run: int = 0) -> Writer:
    """`write`, with the column ``attempt`` added to its rows, and not called for a batch that it has
    completed already.

    Give each sink of a fan-out its own name, so that one sink's failure does not repeat the others.
    Read the sink with :func:`committed`.
    """

    def write_once(batch: DataFrame, batch_id: int) -> None:
        if ledger.has(sink, batch_id, run):
            return
        attempt = uuid.uuid4().hex
        write(batch.withColumn(ATTEMPT, F.lit(attempt)), batch_id)
        ledger.enter(sink, batch_id, attempt, run)

    return write_once


def committed(rows: DataFrame, ledger: Ledger, sink: str) -> DataFrame:
    """The rows of the attempts that count, without the attempt: every batch once.

    The ledger has one row per batch, far fewer than the sink; Spark broadcasts it below its threshold.
    """
    counted = ledger.entries(sink).select(ATTEMPT)
    return rows.join(counted, ATTEMPT, "left_semi").drop(ATTEMPT)


def table_writer(table: VersionedTable, writer: str) -> Writer:
    """Append each micro-batch to a versioned table, exactly once.

    The table remembers the last batch together with the rows; `writer` is a name for this stream
    and run, as batch ids start again with a new checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, {writer: batch_id})

    return write


def merge_writer(table: VersionedTable, keys: list[str], writer: str, buckets: int = 64) -> Writer:
    """Keep the newest row of every key in a versioned table: a batch's rows take the place of those with
    equal keys (nulls are equal). Exactly once, as in :func:`table_writer`.

    The table's partition column holds the bucket of the keys; only buckets that a batch touches are
    read and written again. A batch has one row per key at most, as an update-mode aggregate gives it.
    """
    if table.partition is None:
        raise ValueError("the table needs a partition column for the buckets")

    def write(batch: DataFrame, batch_id: int) -> None:
        if table.has(writer, batch_id):
            return
        rows = batch.withColumn(table.partition, bucket_of(keys, buckets))
        touched = [r[0] for r in rows.select(table.partition).distinct().collect()]  # `buckets` at most
        if table.version() is None:
            table.replace_partitions(rows, touched, {writer: batch_id})
            return
        now = merged(table.read(partitions=touched), rows, keys)
        table.replace_partitions(now.hint("rebalance", table.partition), touched, {writer: batch_id})

    return write
