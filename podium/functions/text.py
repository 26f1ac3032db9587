"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.names import column

# The characters a cleaned text may contain (inside a regex character class), and
# the text a missing value becomes.
KEEP_CLASS = r"""a-zA-Z0-9,.\\"'"""
NULL_TOKEN = "None"


def clean_text(
    value: str | Column, keep: str = KEEP_CLASS, null_token: str | None = NULL_TOKEN
) -> Column:
    """`value` without any character outside `keep`; null becomes `null_token`.

    With the default class, spaces, hyphens, ``#``, accented letters and line breaks disappear:
    ``Great Britain`` -> ``GreatBritain``, ``-5`` -> ``5``. ``null_token=None`` leaves nulls alone.

    Written as "join the runs of wanted characters" rather than "replace the unwanted ones": the
    """
    text = column(value)
    if null_token is not None:
        text = F.coalesce(text, F.lit(null_token))
    wanted = F.regexp_extract_all(text, F.lit(f"[{keep}]+"), F.lit(0))
    return F.array_join(wanted, "")
