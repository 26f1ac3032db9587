"""What the operators share: reading tables, intermediate tables, filters by id."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import scratch_dir

# Words of all word-based operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Most rows that Spark hands to Python at a time where whole texts go there: a batch is in the memory of
# the JVM and of the Python worker, several times over.
TEXTS_PER_BATCH = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _batches(spark: SparkSession, most_rows: int | None) -> Iterator[None]:
    """At most so many rows in an Arrow batch of the jobs inside the block; a lower number of the caller's
    stays."""
    before = spark.conf.get(_BATCH)
    if most_rows is None or 0 < int(before) <= most_rows:
        yield
        return
    spark.conf.set(_BATCH, str(most_rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def staged(frame: DataFrame, label: str, rows_per_batch: int | None = None) -> DataFrame:
    """`frame` written once to the shared folder and read back.

    Later jobs reread the files, so nothing is computed twice, lineage ends here, and a lost
    executor loses nothing. `rows_per_batch` bounds what Python gets at a time while it is written.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    with _batches(spark, rows_per_batch):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return scratch_dir(spark, f"llm-{label}")


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared storage with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unstage(frame: DataFrame | None) -> None:
    """Delete the files of a staged frame that nothing reads any more."""
    if frame is None:
        return
    for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        delete(frame.sparkSession, folder)


def is_small(keys: DataFrame, most_bytes: int) -> bool:
    """Whether the rows of a staged frame of numbers, texts and bytes take no more than so many bytes."""
    sizes = [
        F.coalesce(F.octet_length(name), F.lit(0)) + 24 if kind in ("string", "binary") else F.lit(8)
        for name, kind in keys.dtypes
    ]
    total = keys.agg(F.sum(sum(sizes, F.lit(16)).cast("long"))).first()[0]
    return (total or 0) <= most_bytes


def hinted(keys: DataFrame, most_bytes: int) -> DataFrame:
    """`keys` to be sent to all executors if they are small, else to be joined by a shuffle."""
    return keys.hint("broadcast" if is_small(keys, most_bytes) else "shuffle_hash")


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves `remainder`; a null id never does."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    rest = F.crc32(column.cast("string").cast("binary")) % modulus
    return F.coalesce(rest == remainder, F.lit(False))


# What tells rows apart: a hash of their file and the place in it.
ROW = ("_podium_file", "_podium_row")
# Most rows to leave out that are sent to all executors, 16 bytes each; above it they are joined by a
# shuffle. The results do not depend on it.
MOST_BROADCAST_ROWS = 1_000_000
_PLAIN = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def _is_scan(frame: DataFrame) -> bool:
    """Whether each row of `frame` is a row of a file: a scan, with columns and rows left out at most."""
    node = frame._jdf.queryExecution().analyzed()
    while node.nodeName() in _PLAIN:
        if node.children().isEmpty():
            return node.nodeName() == "LogicalRelation"
        node = node.children().head()
    return False


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with the columns :data:`ROW`, which are different for all rows and the same in every job.

    Rows read from Parquet files have a place there; any other frame is written once and read back.
    """
    names = F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1])
    if "_metadata" not in docs.columns and _is_scan(docs):
        try:
            return docs.select("*", *names)
        except AnalysisException:
            pass  # a file format whose rows have no numbers
    return staged(docs.withColumns({ROW[0]: F.lit(0).cast("long"), ROW[1]: F.monotonically_increasing_id()}), "rows")


def without_rows(docs: DataFrame, dropped: DataFrame, most_broadcast: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """`docs`, as :func:`numbered` returned it, without the rows in `dropped`, and without :data:`ROW`.

    The numbers are the hashed side, so the texts are never sorted, and not even dealt out where the
    rows to leave out are few.
    """
    gone = staged(dropped.select(*ROW), "dropped")
    few = gone.count() <= most_broadcast
    return docs.join(gone.hint("broadcast" if few else "shuffle_hash"), list(ROW), "left_anti").drop(*ROW)


def map_texts(
    frame: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a function of one Arrow batch to every batch of `frame`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return frame.mapInArrow(run, schema)
