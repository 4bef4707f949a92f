"""Grouped measures, shares, medians and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.numbers import share
from tamarind.functions.temporal import month_label


def count_by(df: DataFrame, *by: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def share_of_total(df: DataFrame, *by: str, count: str = "row_count", pct: str = "percentage") -> DataFrame:
    """Group counts and their percentage of all rows.

    The total is a scalar subquery over the counts, so no window gathers the
    groups in one task.
    """
    counts = count_by(df, *by, name=count)
    return counts.withColumn(pct, share(F.col(count), counts.agg(F.sum(count)).scalar()))


def conditional_counts(df: DataFrame, by: Sequence[str], tests: Mapping[str, Column]) -> DataFrame:
    """Per group, the number of rows for which each test holds."""
    return df.groupBy(*by).agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def rate(test: Column) -> Column:
    """Share of rows for which the test holds; unknown counts as no."""
    return F.avg(F.when(test, 1.0).otherwise(0.0))


def median(c: str | Column, accuracy: int = 10_000) -> Column:
    """Discrete median as a mergeable sketch; its relative rank error is 1/accuracy."""
    return F.percentile_approx(c, F.lit(0.5), F.lit(accuracy))


def medians(df: DataFrame, measures: Mapping[str, Column], accuracy: int = 10_000) -> DataFrame:
    """One row with the median of every measure, in one pass."""
    return df.select(*[c.alias(n) for n, c in measures.items()]).agg(
        *[median(n, accuracy).alias(n) for n in measures]
    )


def scalar_or(one_row: DataFrame, default: int | float) -> Column:
    """The single value of a one-row frame, for use in another frame's expression;
    Spark evaluates it once as a scalar subquery."""
    name = one_row.columns[0]
    return one_row.select(F.coalesce(F.col(name), F.lit(default))).scalar()


def pivot_counts(df: DataFrame, by: str, label: str, labels: Sequence[str]) -> DataFrame:
    """One count column per label, zero where absent; labels are given, so no extra
    job has to discover them (A11)."""
    return df.groupBy(by).pivot(label, list(labels)).agg(F.count(F.lit(1))).fillna(0, subset=list(labels))


def crosstab(df: DataFrame, a: str, b: str, name: str = "frequency") -> DataFrame:
    return count_by(df, a, b, name=name)


def mode_table(df: DataFrame, measure: str, k: int | None = None) -> DataFrame:
    """Values by falling frequency, ties by value; ``k`` keeps a top-k report."""
    table = count_by(df, measure, name="frequency").orderBy(F.desc("frequency"), F.asc(measure))
    return table if k is None else table.limit(k)


def month_counts(df: DataFrame, ts: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(month_label(ts).alias("month")).agg(F.count("*").alias(name))


def sorted_values(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted array of the distinct values per group (A10).

    Rows are reduced to distinct (group, value) pairs first, so an array can only
    grow with the value domain, not with the rows of a group. Use it for small
    domains (statuses, payment types); for open domains keep the pairs.
    """
    pairs = df.select(*by, value).distinct()
    return pairs.groupBy(*by).agg(F.array_sort(F.collect_set(value)).alias(name))


def multiset_label(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Values of a group with multiplicity as sorted text, e.g. ``boleto x1 + voucher x3``.

    Counting before collecting keeps one entry per distinct value, whatever the
    number of rows in the group.
    """
    counted = df.groupBy(*by, value).agg(F.count("*").alias("__n"))
    entry = F.concat(F.col(value), F.lit(" x"), F.col("__n").cast("string"))
    return counted.groupBy(*by).agg(F.concat_ws(" + ", F.array_sort(F.collect_list(entry))).alias(name))


def histogram(df: DataFrame, measure: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the smallest and the largest value."""
    bounds = df.agg(F.min(measure).cast("double").alias("lo"), F.max(measure).cast("double").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    value = F.col(measure).cast("double")
    scaled = F.floor((value - lo) * bins / F.nullif(hi - lo, F.lit(0.0)))
    index = F.when(scaled < bins, scaled).when(scaled >= bins, bins - 1).otherwise(0)
    return (
        df.where(F.col(measure).isNotNull())
        .groupBy(index.cast("int").alias("bin"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("bin_start", lo + F.col("bin") * (hi - lo) / bins)
    )


def top_k(df: DataFrame, k: int, measure: str, *ties: str, by_size: bool = False) -> DataFrame:
    """The k rows with the largest measure (or absolute value), ties by ``ties``."""
    c = F.abs(F.col(measure)) if by_size else F.col(measure)
    return df.orderBy(c.desc_nulls_last(), *ties).limit(k)


def bottom_1(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Record holder: the row with the smallest measure."""
    return df.orderBy(F.col(measure).asc_nulls_last(), *ties).limit(1)


def label_rank(label: str, order: Sequence[str]) -> Column:
    """0-based position of a label in a custom order; unknown labels go last, with the
    length of the order (O06)."""
    position = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(label)).cast("int")
    return F.when(position > 0, position - 1).otherwise(F.lit(len(order)))


def numeric_order(label: str) -> Column:
    """Sort key for labels that look like numbers."""
    return F.col(label).try_cast("double").asc_nulls_last()
