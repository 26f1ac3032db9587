"""A training corpus from documents: quality, exact and near duplicates, benchmark leaks, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from podium.llm.common import held_out, staged, table
from podium.llm.decontaminate import drop_contaminated
from podium.llm.exact_dedup import drop_exact_duplicates
from podium.llm.packing import sequences
from podium.llm.quality import keep_quality
from podium.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learned from this input and the labels."""
    labels = table(spark, sf_dir, "labels")
    return keep_quality(docs, labels, learn_from=~held_out("doc_id", 3, 1))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHashes of four-word shingles, 4 bits apart."""
    return drop_near_duplicates(docs, size=4, threshold=4)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as sequences of permitted lengths."""
    return sequences(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", leaks),
    ("packing", packing),
]

# The quality and near-duplicate stages have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
