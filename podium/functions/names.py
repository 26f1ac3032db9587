"""Column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """`name` as one identifier, also when it contains dots or backticks (CSV headers may)."""
    return "`" + name.replace("`", "``") + "`"


def folded(spark: SparkSession, names: Iterable[str]) -> set[str]:
    """`names` as Spark tells them apart: without case, unless the session minds it."""
    minds = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    return set(names) if minds else {name.lower() for name in names}


def column(value: str | Column) -> Column:
    """A column given by name, or the column itself."""
    return F.col(quoted(value)) if isinstance(value, str) else value
