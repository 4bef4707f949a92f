"""Per-group comparisons between rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.operators.aggregates import median
from tamarind.operators.joins import ROWS_PER_TASK, attach, salted_attach


def previous_active(df: DataFrame, keys: Sequence[str], order: Sequence[str], lagged: Mapping[str, str]) -> DataFrame:
    """Value of the previous *row* of the key, which may lie several periods back.

    For frames already aggregated to one row per key and period, whose groups are
    as long as the calendar. Raw rows go through ``ranged.ordered_lag``.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lag(c).over(w) for new, c in lagged.items()})


def with_group_measures(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    *,
    salted: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every row with aggregates of its group.

    Aggregating and joining back replaces ``agg() over (partition by key)``: the
    aggregate is combined on the map side, and the join can split a hot key, while
    a window must hold the key in one task. Null keys form a group of their own.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    if salted:
        return salted_attach(df, totals, list(keys), null_safe=True, rows_per_task=rows_per_task)
    return attach(df, totals, list(keys), null_safe=True)


def group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return with_group_measures(df, keys, {name: F.count("*")})


def group_median(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str = "median_") -> DataFrame:
    return with_group_measures(df, keys, {prefix + c: median(c) for c in cols})
