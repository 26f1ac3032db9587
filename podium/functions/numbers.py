"""Numbers out of untrusted text.

A plain cast fails the whole job on the first bad value when ANSI mode is on (the default), so
every conversion here is a `try_cast`: text that is no number becomes null. Surrounding blanks and
exponents are accepted; ``NaN`` and ``Infinity`` are numbers, see :func:`is_number`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.names import column


def as_whole(value: str | Column, to: str = "int") -> Column:
    """`value` as a whole number; fraction digits are cut off, as a plain cast of text does it.

    ``12``, ``12.0`` and ``12.7`` give 12. Exponents, other text and numbers outside the type give
    null.
    """
    number = column(value)
    text = F.trim(number.cast("string"))
    digits = F.regexp_extract(text, r"^([+-]?[0-9]*)\.", 1)
    digits = F.when(digits.rlike("[0-9]"), digits).otherwise(F.lit("0"))
    cut = F.when(text.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+)$"), digits.try_cast(to))
    return F.coalesce(number.try_cast(to), cut)


def as_int(value: str | Column) -> Column:
    return as_whole(value, "int")


def as_double(value: str | Column) -> Column:
    return column(value).try_cast("double")


def as_float(value: str | Column) -> Column:
    return column(value).try_cast("float")


def is_number(value: str | Column, drop_nan: bool = False) -> Column:
    """True where `value` is present and parses as a number.

    NaN passes by default, as it does in a not-null test on the parsed value; one NaN makes the
    average of its whole group NaN. `drop_nan` rejects it.
    """
    number = as_double(value)
    present = number.isNotNull()
    return present & ~F.isnan(number) if drop_nan else present
