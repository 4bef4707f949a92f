"""Casts, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarind.functions.text import as_col

MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    return as_col(c).try_cast(MONEY)


def to_number(c: str | Column) -> Column:
    """Text to double; text that is no number becomes null."""
    return as_col(c).try_cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` where ``den`` is positive, else 0.0 (also for a null ``den``)."""
    den = as_col(den).cast("double")
    return F.when(den > 0, as_col(num).cast("double") / den).otherwise(F.lit(0.0))


def share(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """Percentage, null where the denominator is zero or null."""
    return F.round(F.try_divide(as_col(num) * F.lit(100.0), as_col(den)), digits)


def rounded(c: str | Column, digits: int = 2) -> Column:
    return F.round(as_col(c), digits)


def volume(length: str, height: str, width: str) -> Column:
    """Product of three dimensions, brought back to money precision."""
    return (F.col(length) * F.col(height) * F.col(width)).try_cast(MONEY)
