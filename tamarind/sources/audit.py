"""Audit log of rejected rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.sources.tables import LINEAGE, Lake


def log_rejects(lake: Lake, rejects: DataFrame, table: str, run_id: str, detected_at: datetime) -> None:
    """Store the rejects of one run.

    The log is partitioned by run, and writing a run replaces that run's folder only,
    also when it rejects nothing: repeating a run leaves the log as it was, and
    earlier runs are never read or rewritten. Every rejected row keeps its reason,
    one row per reason. The lake's format must be a file format.
    """
    rows = rejects.drop(*LINEAGE)
    if "error_reason" not in rows.columns:
        rows = rows.withColumn("error_reason", F.lit(None).cast("string"))
    rows = rows.withColumn("error_detected_at", F.lit(detected_at))
    rows.write.format(lake.fmt).mode("overwrite").save(f"{lake.path(table)}/run_id={run_id}")


def read_log(lake: Lake, table: str, run_id: str | None = None) -> DataFrame:
    """The log of all runs, or of one (the others are not scanned)."""
    log = lake.read_evolved(table).withColumn("run_id", F.col("run_id").cast("string"))
    return log if run_id is None else log.where(F.col("run_id") == run_id)
