"""Parquet tables in versions: a reader sees the whole old table or the whole new one.

A write puts its files into a folder of their own. What the table consists of is one small file, the
version, which is moved into place last: until then nothing has changed for readers, and a write that
fails half-way leaves files that no version names. A version also remembers which batches it holds, so
data and that memory change together and a batch that is delivered again is recognised.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from podium import storage
from podium.functions.names import column, quoted

_DIGITS = 12
Marks = Mapping[str, int]


def _holds(version: Version | None, marks: Marks) -> bool:
    return version is not None and bool(marks) and all(version.marks.get(k, -1) >= n for k, n in marks.items())


@dataclass(frozen=True)
class Version:
    """What a table consists of.

    `loads` has the folders that count, each with the partitions of it that still do, or None for all.
    `marks` has the last batch of every writer that is in the table.
    """

    number: int
    schema: StructType
    loads: Mapping[str, list[int] | None]
    marks: Mapping[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        fields = {"schema": self.schema.jsonValue(), "loads": self.loads, "marks": self.marks}
        return json.dumps(fields)

    @classmethod
    def from_json(cls, number: int, text: str) -> Version:
        fields = json.loads(text)
        return cls(number, StructType.fromJson(fields["schema"]), fields["loads"], fields["marks"])


class VersionedTable:
    """A table below `path`, for one writer at a time and any number of readers.

    `partition` names a whole-number column by which files are kept apart, so that partitions can be
    read and replaced alone; the number of partitions should be bounded.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str | None = None) -> None:
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition

    # Reading

    def _numbers(self) -> list[int]:
        found = storage.names(self.spark, f"{self.path}/versions")
        return sorted(int(name.removesuffix(".json")) for name in found if name.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        """A version by its number, or the newest one; None if there is none yet."""
        if number is None:
            numbers = self._numbers()
            if not numbers:
                return None
            number = numbers[-1]
        text = storage.read_text(self.spark, f"{self.path}/versions/{number:0{_DIGITS}}.json")
        return Version.from_json(number, text)

    def read(self, number: int | None = None, partitions: Iterable[int] | None = None) -> DataFrame:
        """The table as of a version, the newest if none is given; only some `partitions` on request.

        The frame goes on reading that version, whatever is written later, until it is retired.
        """
        version = self.version(number)
        if version is None:
            raise ValueError(f"{self.path} has no version")
        wanted = None if partitions is None else set(partitions)
        paths = []
        for load, live in version.loads.items():
            if live is None and wanted is None:
                paths.append(f"{self.path}/data/load={load}")
            else:
                parts = self._partitions(load) if live is None else live
                kept = parts if wanted is None else [p for p in parts if p in wanted]
                paths += [f"{self.path}/data/load={load}/{self.partition}={p}" for p in kept]
        return self._frame(version, paths)

    def _frame(self, version: Version, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        reader = self.spark.read.schema(version.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).select(*[quoted(name) for name in version.schema.names])

    def added(self, since: int | None) -> DataFrame:
        """The rows appended after version `since`, all rows for None; reads only their files."""
        newest, old = self.version(), None if since is None else self.version(since)
        paths = [f"{self.path}/data/load={load}" for load in newest.loads if old is None or load not in old.loads]
        return self._frame(newest, paths)

    def _partitions(self, load: str) -> list[int]:
        prefix = f"{self.partition}="
        found = storage.names(self.spark, f"{self.path}/data/load={load}")
        return [int(name.removeprefix(prefix)) for name in found if name.startswith(prefix)]

    def has(self, writer: str, batch: int) -> bool:
        """Whether the newest version holds that batch of `writer`, or a later one."""
        return _holds(self.version(), {writer: batch})

    # Writing

    def _write(self, rows: DataFrame, number: int) -> str:
        load = f"{number:0{_DIGITS}}-{uuid.uuid4().hex[:8]}"
        writer = rows.write.partitionBy(self.partition) if self.partition else rows.write
        writer.parquet(f"{self.path}/data/load={load}")
        return load

    def _commit(
        self, rows: DataFrame, marks: Mapping[str, int], keep: Mapping[str, list[int] | None], old: Version | None
    ) -> Version:
        number = 0 if old is None else old.number + 1
        load = self._write(rows, number)
        marks = {**(old.marks if old else {}), **marks}
        # Partition columns are read back behind the others.
        fields = sorted(rows.schema.fields, key=lambda f: f.name == self.partition)
        version = Version(number, StructType(fields), {**keep, load: None}, marks)
        if not storage.write_new(self.spark, f"{self.path}/versions/{number:0{_DIGITS}}.json", version.to_json()):
            raise RuntimeError(f"{self.path} got version {number} from another writer")
        return version

    def replace(self, rows: DataFrame, marks: Marks = MappingProxyType({}), always: bool = False) -> Version:
        """A version that holds `rows` and nothing else. `rows` may be made from this table.

        With `marks`, names of writers and the number of their last batch, nothing is done if the table
        holds all of these batches, or later ones, already; unless it is to be done `always`.
        """
        old = self.version()
        return old if _holds(old, marks) and not always else self._commit(rows, marks, {}, old)

    def append(self, rows: DataFrame, marks: Marks = MappingProxyType({})) -> Version:
        """A version with `rows` added, which have the table's columns; `marks` as in :meth:`replace`."""
        old = self.version()
        return old if _holds(old, marks) else self._commit(rows, marks, old.loads if old else {}, old)

    def replace_partitions(
        self, rows: DataFrame, partitions: Iterable[int], marks: Marks = MappingProxyType({})
    ) -> Version:
        """A version in which `partitions` hold `rows`, all of which belong there, and the others are as
        they were; `marks` as in :meth:`replace`."""
        old, gone = self.version(), set(partitions)
        if _holds(old, marks):
            return old
        keep = {}
        for load, live in (old.loads if old else {}).items():
            live = [p for p in (self._partitions(load) if live is None else live) if p not in gone]
            if live:
                keep[load] = live
        return self._commit(rows, marks, keep, old)

    def compact(self) -> Version | None:
        """The same rows in one load, after many were appended."""
        version = self.version()
        return version if version is None or len(version.loads) < 2 else self.replace(self.read())

    def retire(self, keep: int = 2) -> None:
        """Delete all versions but the newest `keep`, and the files that none of those needs.

        What failed writes have left goes too, so nobody may be writing meanwhile.
        """
        numbers = self._numbers()
        kept = [self.version(number) for number in numbers[-keep:]]
        needed: dict[str, set[int] | None] = {}
        for version in kept:
            for load, live in version.loads.items():
                if live is None or needed.get(load, set()) is None:
                    needed[load] = None
                else:
                    needed[load] = needed.get(load, set()) | set(live)
        for number in numbers[: -keep]:
            storage.delete(self.spark, f"{self.path}/versions/{number:0{_DIGITS}}.json")
        for name in storage.names(self.spark, f"{self.path}/data"):
            load = name.removeprefix("load=")
            if load not in needed:
                storage.delete(self.spark, f"{self.path}/data/{name}")
            elif needed[load] is not None:
                for p in set(self._partitions(load)) - needed[load]:
                    storage.delete(self.spark, f"{self.path}/data/{name}/{self.partition}={p}")


def bucket_of(columns: Iterable[str], buckets: int) -> Column:
    """Which of so many partitions a row belongs to, by the values of some columns; an int."""
    return F.pmod(F.xxhash64(*[column(name) for name in columns]), F.lit(buckets)).cast("int")
