"""Small tables that hold the awkward cases: nulls, empty and long texts, ties, copies, clashes."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars int, kept boolean, fp string, run int"


def documents(spark, rows):
    """A frame of (doc_id, text) with extra columns, some named like the operators' own."""
    full = [(i, t, "en", "s", len(t or ""), True, "x", 7) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def words(first, count, step=1):
    """Distinct words, so that texts share exactly what they are meant to share."""
    return [f"w{k}" for k in range(first, first + count * step, step)]


def rows_of(frame, *names):
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=str)


def many_partitions(frame):
    return frame.repartition(5, F.xxhash64("doc_id"))
