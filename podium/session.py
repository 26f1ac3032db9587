"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs are designed for. The session belongs to the caller: nothing here is applied
# to a session that already exists.
SETTINGS = {
    # Runtime re-planning: coalesce small shuffle partitions, split hot join keys, and turn a
    # sort-merge join into a broadcast once the measured size allows it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Where a job cannot size its shuffles, as in a frame that is returned and run later, start from
    # many partitions: small ones are merged, large ones are never split.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    # Fewer, longer scan tasks: every task's output is one more block for each shuffle partition.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Event-time windows are aligned to the UTC epoch; keep the session there too.
    "spark.sql.session.timeZone": "UTC",
    # State on local disk with incremental uploads: size is not bounded by executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Connector for topics; has to match the Spark and Scala version in use.
KAFKA_CONNECTOR = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


def build_session(
    app_name: str, packages: Sequence[str] = (), jars: Sequence[str] = (), **conf: str
) -> SparkSession:
    """A session with :data:`SETTINGS`; keyword settings win (``__`` stands for a dot).

    `packages` are coordinates Spark fetches, such as :data:`KAFKA_CONNECTOR` or a database driver;
    `jars` are files that are there already. Both count for a new session only.
    """
    builder = SparkSession.builder.appName(app_name)
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    if jars:
        builder = builder.config("spark.jars", ",".join(jars))
    named = {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in {**SETTINGS, **named}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Batch shuffles: bytes of input per partition.
BYTES_PER_PARTITION = 256 * 1024 * 1024
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION
) -> Iterator[None]:
    """Give the batch jobs inside the block enough shuffle partitions for `input_bytes`.

    A fixed ``spark.sql.shuffle.partitions`` that suits a gigabyte leaves partitions of hundreds of
    gigabytes at 100 TB. Adaptive execution merges small partitions but never splits them for an
    aggregate, so the number it starts from has to follow the input. A number the caller has set
    is respected; nothing changes without adaptive execution, or where the session's usual number is
    enough. Partitions hold `bytes_per_partition` of input however large it is.
    """
    needed = -(-input_bytes // bytes_per_partition)
    current = spark.conf.get(_INITIAL_PARTITIONS, None)
    if current not in (None, SETTINGS[_INITIAL_PARTITIONS]) or needed <= int(
        current or spark.conf.get("spark.sql.shuffle.partitions")
    ):
        yield
        return
    spark.conf.set(_INITIAL_PARTITIONS, str(needed))
    try:
        yield
    finally:
        if current is None:
            spark.conf.unset(_INITIAL_PARTITIONS)
        else:
            spark.conf.set(_INITIAL_PARTITIONS, current)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. A cluster session without it is
    an error: a folder on one machine is invisible to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="podium-"))
    return shared_dir(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below :func:`shared_dir` that no other run uses. Spark creates it on first write."""
    return f"{shared_dir(spark)}/podium/{label}-{uuid.uuid4().hex}"
