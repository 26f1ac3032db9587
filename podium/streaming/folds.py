"""A stream's history of versions, folded into its current state from time to time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from podium import storage
from podium.operators.history import latest_per_key
from podium.versions import Version, VersionedTable

_RUN, _BATCH = "run", "batch_id"


class FoldedHistory:
    """The newest row of every key in a history that :func:`podium.sinks.fan_out.files_writer` writes,
    with a run number.

    The history up to some batch is kept as a base of one row per key. Reading merges the base with
    the batches after it, so its cost follows the keys and those batches, not the length of the history.
    """

    def __init__(self, spark: SparkSession, history: str, base: str, keys: Sequence[str]) -> None:
        self.spark, self.history, self.keys = spark, history.rstrip("/"), list(keys)
        self.base = VersionedTable(spark, base)

    def _batches(self) -> list[tuple[int, int]]:
        """All batches of the history by run and number. A batch that is being written is not there yet
        or has no rows yet."""
        found = []
        for run in storage.names(self.spark, self.history):
            if run.startswith(f"{_RUN}="):
                own = storage.names(self.spark, f"{self.history}/{run}")
                numbers = [name.removeprefix(f"{_BATCH}=") for name in own if name.startswith(f"{_BATCH}=")]
                found += [(int(run.removeprefix(f"{_RUN}=")), int(number)) for number in numbers]
        return sorted(found)

    def folded_up_to(self) -> tuple[int, int]:
        """Run and number of the last batch in the base."""
        version = self.base.version()
        return (-1, -1) if version is None else (version.marks[_RUN], version.marks[_BATCH])

    def _rows(self, batches: Sequence[tuple[int, int]]) -> DataFrame | None:
        """The base and some batches of the history; None if there is neither."""
        paths = [f"{self.history}/{_RUN}={run}/{_BATCH}={number}" for run, number in batches]
        newer = self.spark.read.option("basePath", self.history).parquet(*paths) if paths else None
        if newer is not None:
            newer = newer.withColumns({name: newer[name].cast("bigint") for name in (_RUN, _BATCH)})
        if self.base.version() is None:
            return newer
        base = self.base.read()
        return base if newer is None else base.unionByName(newer)

    def read(self) -> DataFrame:
        """The newest row of every key, with its run and batch id. Only the base and later batches are
        read."""
        last = self.folded_up_to()
        rows = self._rows([batch for batch in self._batches() if batch > last])
        if rows is None:
            raise ValueError(f"{self.history} has no batch")
        return latest_per_key(rows, self.keys, [_RUN, _BATCH])

    def fold(self, up_to: tuple[int, int] | None = None, forget: bool = False) -> Version | None:
        """Take the batches up to one, by run and number, into the base; all there are for None.

        Batches have to be folded after they are committed: while a stream runs, leave out its last one.
        `forget` deletes the folded batches. A fold that fails leaves the base as it was.
        """
        last = self.folded_up_to()
        chosen = [batch for batch in self._batches() if batch > last and (up_to is None or batch <= up_to)]
        if not chosen:
            return self.base.version()
        run, number = chosen[-1]
        rows = latest_per_key(self._rows(chosen), self.keys, [_RUN, _BATCH])
        # Numbers of batches start again with every run, so the marks do not tell which one is later.
        version = self.base.replace(rows, {_RUN: run, _BATCH: number}, always=True)
        self.base.retire()
        if forget:
            for own_run, own_number in chosen:
                storage.delete(self.spark, f"{self.history}/{_RUN}={own_run}/{_BATCH}={own_number}")
        return version
