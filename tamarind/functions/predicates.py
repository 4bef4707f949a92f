"""Row predicates."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarind.functions import fixed
from tamarind.functions.text import as_col


def any_null(*cols: str) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in cols])


def all_present(*cols: str) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def is_true(p: Column) -> Column:
    """Two-valued form of a predicate: null counts as false."""
    return F.coalesce(p, F.lit(False))


def in_box(lat: str, lng: str) -> Column:
    return is_true(
        F.col(lat).between(fixed.LAT_MIN, fixed.LAT_MAX) & F.col(lng).between(fixed.LNG_MIN, fixed.LNG_MAX)
    )


def outside(c: str, low: float, high: float) -> Column:
    """Value known and out of range; null is not outside."""
    return is_true(~F.col(c).between(low, high))


def is_hex_id(c: str | Column) -> Column:
    return as_col(c).rlike(fixed.HEX_ID)


def has_prefix(c: str | Column, prefix: str) -> Column:
    return as_col(c).like(prefix + "%")


def mentions(c: str | Column, *words: str) -> Column:
    """Any of the words occurs in the whole text."""
    return reduce(or_, [as_col(c).contains(w) for w in words])


def out_of_order(*stages: str) -> Column:
    """A later stage is dated before an earlier one, over all pairs of stages."""
    return is_true(reduce(or_, [F.coalesce(F.col(b) < F.col(a), F.lit(False)) for a, b in combinations(stages, 2)]))
