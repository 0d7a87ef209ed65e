"""Parsing of raw text columns. Bad text gives NULL, also under ANSI mode.

Each cast is behind a pattern test: a ``try_cast`` that fails raises and catches an exception per
row, some twenty times the cost of the test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date layouts that occur in the raw data, by separator.
DATE_LAYOUTS = {"-": "yyyy-MM-dd", "/": "dd/MM/yyyy"}

# An integer, or a decimal number whose fraction is cut off; a decimal number.
INTEGER_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"
FRACTION_TEXT = r"^\s*[+-]?\.\d+\s*$"
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column, floating: bool) -> Column:
    """NULL, or NaN where the column is a floating-point one."""
    c = as_column(c)
    return F.isnan(c) | c.isNull() if floating else c.isNull()


def parse_mixed_date(c: str | Column, layouts: dict[str, str] = DATE_LAYOUTS) -> Column:
    """Date from text whose separator tells its layout; NULL for any other text."""
    c = as_column(c)
    out = F.lit(None).cast("date")
    for separator, layout in reversed(layouts.items()):
        out = F.when(c.contains(separator), F.try_to_date(c, layout)).otherwise(out)
    return out


def clean_int(c: str | Column) -> Column:
    """Text to int, cutting a fraction off: '26.898' is 26, '.5' is 0, '16:44.718' is NULL."""
    text = as_column(c).cast("string")
    whole = F.when(text.rlike(INTEGER_TEXT), F.substring_index(text, ".", 1).try_cast("int"))
    return whole.when(text.rlike(FRACTION_TEXT), 0)


def clean_float(c: str | Column) -> Column:
    """Text to double; NULL for anything but a decimal number."""
    text = as_column(c).cast("string")
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))


def lap_time_ms(c: str | Column) -> Column:
    """Milliseconds as double from 'm:ss.SSS'; NULL when a part is absent or bad."""
    parts = F.split(as_column(c), ":")
    return clean_int(F.get(parts, 0)) * F.lit(60_000) + clean_float(F.get(parts, 1)) * F.lit(1_000)


def full_name(first: str | Column, last: str | Column) -> Column:
    """'first last'; NULL when either part is NULL."""
    return F.concat(as_column(first), F.lit(" "), as_column(last))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, for a zero denominator."""
    return F.try_divide(numerator, denominator)
