"""Text normalisation, lookups and display helpers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions import fixed


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    """Identifier as a trimmed string."""
    return F.trim(as_col(c).cast("string"))


def label_text(c: str | Column) -> Column:
    """Category-like text: trimmed, lower case."""
    return F.lower(trimmed(c))


def clean_text(c: str | Column) -> Column:
    """Place name: lower case, accents removed, trimmed.

    Lower-casing comes first so that upper-case accented letters are mapped too.
    """
    return F.trim(F.translate(F.lower(as_col(c).cast("string")), fixed.ACCENTED, fixed.PLAIN))


def state_code(c: str | Column) -> Column:
    return F.upper(trimmed(c))


def lookup(key: str | Column, table: dict[str, str], default: str | Column | None = None) -> Column:
    """Value of ``key`` in a literal table, else ``default``."""
    literals = ", ".join("'" + x.replace("'", "\\'") + "'" for x in chain.from_iterable(table.items()))
    found = F.element_at(F.expr(f"map({literals})"), as_col(key))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def region_of(state: str | Column) -> Column:
    return lookup(state, fixed.STATE_REGION, "Unknown")


def state_name(state: str | Column) -> Column:
    """Full state name; codes that are not in the table are kept as they are."""
    return lookup(state, fixed.STATE_NAME, as_col(state))


def mask_id(c: str | Column, keep: int = 8) -> Column:
    return F.concat(F.substring(as_col(c), 1, keep), F.lit("..."))


def strip_prefix(c: str | Column, prefix: str) -> Column:
    c = as_col(c)
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def titled(df: DataFrame) -> DataFrame:
    """Columns renamed from snake_case to Title Case."""
    return df.toDF(*[c.replace("_", " ").title() for c in df.columns])
