"""Cleaning, de-duplication and number filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from podium.functions.names import column
from podium.functions.text import KEEP_CLASS, NULL_TOKEN, clean_text


def clean_strings(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keep: str = KEEP_CLASS,
    null_token: str | None = NULL_TOKEN,
) -> DataFrame:
    """:func:`clean_text` on all string columns, or on `columns`; the others stay as they are.

    One projection, whatever the number of columns. Note that in an all-text layer this includes
    ids and measures: ``176-180`` becomes ``176180``.
    """
    if columns is None:
        columns = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
    return df.withColumns({name: clean_text(name, keep, null_token) for name in columns})


def deduplicate(df: DataFrame) -> DataFrame:
    """Distinct whole rows.

    Planned as partial aggregate -> exchange on all columns -> final aggregate: copies are
    collapsed before the shuffle, so even a row that makes up a third of the table travels at most
    once per map task, and rows are spread by all their columns rather than by one skewed key.
    """
    return df.dropDuplicates()


def numeric_rows(
    df: DataFrame, columns: Sequence[str], to: str = "double", drop_nan: bool = False
) -> DataFrame:
    """Rows whose `columns` all hold numbers, with these columns converted to type `to`.

    Text that is no number drops the row instead of failing the job. Catalyst turns the test into
    a not-null filter on the scan plus the parse, and moves both below a join. NaN passes unless
    `drop_nan` is set; one NaN makes the average of its whole group NaN.
    """
    converted = df.withColumns({name: column(name).try_cast(to) for name in columns})
    for name in columns:
        present = column(name).isNotNull()
        converted = converted.filter(present & ~F.isnan(column(name)) if drop_nan else present)
    return converted
