"""Query registry and result presentation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.catalog.roles import Roles
from tamarind.session import ADAPTIVE, STORING, adaptive

DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Roles], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(self.build(Roles(adaptive(spark, ADAPTIVE | STORING), sf_dir)))


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``build(roles) -> DataFrame`` under a name, with its SQL statement."""

    def register(build: Callable[[Roles], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, covers, build, sql)
        return build

    return register


def present(df: DataFrame) -> DataFrame:
    """Plain comparable types: long, rounded double, text, boolean.

    Audit columns that depend on the run are left out.
    """
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name in ("source_system", "transformation_version", "error_detected_at", "dq_checked_at"):
            continue
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), DIGITS)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def cols(spec: str) -> str:
    """Select list in the presentation's types, from ``"a, b:i, c:d, d:t"``
    (i = long, d = rounded double, t = text; none = as it is)."""
    kinds = {
        "i": "CAST({c} AS BIGINT) AS {c}",
        "d": "round(CAST({c} AS DOUBLE), %d) AS {c}" % DIGITS,
        "t": "CAST({c} AS VARCHAR) AS {c}",
        "": "{c}",
    }
    parts = [p.strip().partition(":") for p in spec.split(",")]
    return ", ".join(kinds[kind].format(c=name) for name, _, kind in parts)
