"""Relational sinks and sources."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Warehouse:
    """A JDBC database. Credentials come in with ``properties``, never from code."""

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", connections: int = 16) -> None:
        """Write over ``connections`` parallel connections. The rows are shuffled to
        them, so the work before the write keeps its own parallelism."""
        df.repartition(connections).write.jdbc(self.url, table, mode, dict(self.properties))

    def read(
        self,
        table: str,
        split_on: str | None = None,
        lower: int | None = None,
        upper: int | None = None,
        splits: int = 16,
    ) -> DataFrame:
        """Read over one connection, or over ``splits`` ranges of an integer column."""
        if split_on is None:
            return self.spark.read.jdbc(self.url, table, properties=dict(self.properties))
        return self.spark.read.jdbc(self.url, table, split_on, lower, upper, splits, properties=dict(self.properties))
