"""Quantity parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.functions.text import strip_ws

# Plain decimal or scientific notation. A cast alone would also take '12d' and 'Infinity'.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# The first double above the largest bigint.
_BIGINT_EDGE = float(2**63)


def _parsed(col: Column) -> Column:
    """One pass over the text: what is not a number extracts as '' and casts to null."""
    text = strip_ws(col.cast("string"))
    return F.regexp_extract(text, NUMBER, 0).try_cast("double")


def to_number(col: Column) -> Column:
    """Text to double; null when the text is not a finite number."""
    number = _parsed(col)
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_quantity(col: Column) -> Column:
    """Text to whole units, rounded up; null when it is not a number. Always bigint."""
    number = _parsed(col)
    return F.when(F.abs(number) < F.lit(_BIGINT_EDGE), F.ceil(number))


def lost_in_parse(col: Column) -> Column:
    """True for a value that was there but is not a number."""
    return col.isNotNull() & to_quantity(col).isNull()
