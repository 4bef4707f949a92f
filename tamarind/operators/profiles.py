"""Column and table profiles, each in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.numbers import share
from tamarind.operators.joins import Keys, flag_match


def _long(one_row: DataFrame, entries: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One wide aggregate row turned into one row per profiled column."""
    structs = [
        F.struct(F.lit(name).alias("column_name"), *[c.alias(n) for n, c in fields.items()])
        for name, fields in entries.items()
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("p")).select("p.*")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    return _long(
        wide,
        {c: {"null_count": F.col(f"c{i}"), "null_pct": share(F.col(f"c{i}"), F.col("n"))} for i, c in enumerate(cols)},
    )


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, max per numeric column."""
    stats = {"row_count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    wide = typed.agg(*[f(c).alias(f"{s}{i}") for i, c in enumerate(cols) for s, f in stats.items()])
    return _long(wide, {c: {s: F.col(f"{s}{i}") for s in stats} for i, c in enumerate(cols)})


def quartile_summary(df: DataFrame, measure: str, accuracy: int = 10_000) -> DataFrame:
    """mean, min, quartiles and max of one measure."""
    c = F.col(measure)
    return df.agg(
        F.avg(c).alias("mean"),
        F.min(c).alias("min"),
        F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(accuracy)).alias("q"),
        F.max(c).alias("max"),
    ).select("mean", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def distinct_counts(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Exact cardinalities side by side, e.g. before and after cleaning."""
    return df.agg(*[F.count_distinct(c).alias(n) for n, c in measures.items()])


def nulls_by(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Null counts of several columns per group value (Q32)."""
    return df.groupBy(by).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def missing_when(df: DataFrame, test: Column, cols: Sequence[str]) -> DataFrame:
    """Rows that pass the test but miss a value, as count and percentage of all rows (Q31)."""
    wide = df.agg(
        F.count("*").alias("n"), *[F.count_if(test & F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)]
    )
    return _long(
        wide,
        {
            c: {"error_count": F.col(f"c{i}"), "error_pct": share(F.col(f"c{i}"), F.col("n"), 4)}
            for i, c in enumerate(cols)
        },
    )


def integrity_gap(child: DataFrame, parent: DataFrame, on: Keys) -> DataFrame:
    """Total rows, rows without a parent, and their percentage (Q33)."""
    flagged = flag_match(child, parent, on, "__known")
    return flagged.agg(F.count("*").alias("total_rows"), F.count_if(~F.col("__known")).alias("unmapped_rows")).withColumn(
        "unmapped_pct", share("unmapped_rows", "total_rows", 4)
    )


def schema_of(df: DataFrame) -> DataFrame:
    """The schema as rows."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, is_nullable boolean")
