"""Deduplication and one-row-per-key selection.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle:
each map task sends at most one row per key, so a hot key costs no more than a
cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row per key by ``order``; the remaining columns break ties, so the
    choice does not depend on the input's physical order."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return keep_first(df, keys, [F.col(ts).desc_nulls_last()])


def earliest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return keep_first(df, keys, [F.col(ts).asc_nulls_last()])


def majority(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Most frequent combination of ``values`` per key; ties go to the smallest."""
    votes = df.groupBy(*keys, *values).agg(F.count("*").alias("__votes"))
    return keep_first(votes, keys, [F.col("__votes").desc()]).drop("__votes")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows_in_group")).where("rows_in_group > 1")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """The surplus copies of rows that occur more than once."""
    return df.exceptAll(df.distinct())


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows, surplus rows and their percentage in one aggregate."""
    sizes = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_rows"),
    ).select(
        "total_rows",
        "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        F.round(F.try_divide((F.col("total_rows") - F.col("distinct_rows")) * F.lit(100.0), F.col("total_rows")), 2)
        .alias("duplicate_pct"),
    )
