"""Dates out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.names import column

# Fixed value: day, English month name and year without separators, such as 19July1985.
BORN_PATTERN = "dMMMMyyyy"


def parse_born(value: str | Column, pattern: str = BORN_PATTERN) -> Column:
    """A date of birth; text that does not follow `pattern` becomes null."""
    return F.try_to_date(column(value), pattern)
