"""Column expressions. All of them are built-in Spark expressions, so they stay in code generation."""

from podium.functions.dates import parse_born
from podium.functions.names import quoted
from podium.functions.numbers import as_double, as_float, as_int, as_whole, is_number
from podium.functions.text import clean_text

__all__ = ["as_double", "as_float", "as_int", "as_whole", "clean_text", "is_number", "parse_born", "quoted"]
