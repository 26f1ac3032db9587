"""Exact duplicates: grouping by a 128-bit content hash, bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import ROW, numbered, staged, without_rows

# Most repeated hashes that are sent to all executors, 16 bytes each; above it they are joined by a
# shuffle. The results do not depend on it.
MOST_BROADCAST_HASHES = 1_000_000


def content_hash(text: Column) -> Column:
    """The 128-bit hash that groups texts."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(
    docs: DataFrame,
    *,
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    hash128: Callable[[Column], Column] = content_hash,
    most_broadcast: int = MOST_BROADCAST_HASHES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Rows belong together when their texts, after `normalise`, have the same bytes; `keep` says
    whether the smallest or the largest id of a group stays. Only hashes and ids are shuffled for
    all rows. The texts of repeated hashes are compared byte by byte: they are grouped by the text
    itself, combined before the shuffle, so a group of any size costs one row per task.

    A null text counts as empty. Rows that repeat an id with the same text count for the group's
    size and share its fate. A row without an id stays only if its group has no id at all. Other
    columns are ignored.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    content = normalise(content) if normalise else content
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("_text"))
    hashed = rows.select(
        "doc_id",
        hash128(F.col("_text")).alias("_hash"),
        F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha"),
    )
    repeated = staged(
        hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"),
        "repeated-hashes",
    )
    few = repeated.count() <= most_broadcast
    suspects = repeated.hint("broadcast" if few else "shuffle_hash")
    # Bytes decide: one row for every different text among those that share their hash.
    groups = (
        rows.withColumn("_hash", hash128(F.col("_text")))
        .join(suspects, "_hash", "left_semi")
        .groupBy("_hash", "_text")
        .agg(best("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .select(
            "_hash", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha"), "_keep", "_size"
        )
    )
    return hashed.join(groups, ["_hash", "_sha"], "left").select(
        "doc_id",
        F.coalesce("_keep", "doc_id").alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("_keep", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """`docs` with one document of each group of equal texts, all columns as they are.

    Rows are told apart by their place and not by their id: of every text exactly one row stays, that of
    the smallest id, whichever ids are null or repeated.
    """
    rows = numbered(docs)
    key = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), *ROW)
    decided = exact_duplicates(rows.withColumn("_podium_key", key), doc_id="_podium_key", **options)
    return without_rows(rows, decided.where("not kept").select(*(f"doc_id.{name}" for name in ROW)))
