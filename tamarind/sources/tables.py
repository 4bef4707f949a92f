"""Lakehouse tables: scan, ingest, write, export, catalog.

The format defaults to parquet; any installed table format can be passed.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tamarind.session import CODEC, stored
from tamarind.sources.versions import Files, Pointer

LINEAGE = ("_ingested_at", "_source_file")
# Namespace of the catalog entries that describe bucketed tables.
BUCKETED = "tamarind_bucketed"


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, *, multi_line: bool = False
) -> DataFrame:
    """Header CSV with quoted fields.

    Give a schema at scale: inference reads the whole input once more. Files whose
    fields hold line breaks need ``multi_line``; such a file cannot be split.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def with_lineage(df: DataFrame, ingested_at: Column | None = None, source: str | None = None) -> DataFrame:
    """Ingestion time and source file of each row."""
    return df.withColumns(
        {
            "_ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
            "_source_file": F.lit(source) if source else F.col("_metadata.file_name"),
        }
    )


def without_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE)


def bucketed_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[str]) -> DataFrame:
    """The frame stored at a path in hash buckets of the keys, each in order, with a catalog
    entry that tells Spark so. What is clustered by the keys then needs no shuffle."""
    spark = df.sparkSession
    name = f"{BUCKETED}.t_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    create_namespaces(spark, BUCKETED)
    drop_tables(spark, name)
    writer = df.write.format("parquet").mode("overwrite").option("path", path).option("compression", CODEC)
    writer.bucketBy(buckets, *keys).sortBy(*order).saveAsTable(name)
    return spark.table(name)


@dataclass(frozen=True)
class Lake:
    """A root folder with one sub-folder per table."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _pointer(self, table: str) -> Pointer:
        return Pointer(self.spark, f"{self.path(table)}__versions/_pointer")

    def _current(self, table: str) -> str:
        """The folder that holds the table now: its own, or that of a newer version."""
        return self._pointer(table).current()[1].get("folder", self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self._current(table))

    def replace(self, table: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rewrite a table from itself: the changed rows go to a folder of a new version,
        then the pointer is switched (G10, G11). A failure before the switch leaves the
        table as it was. The version before the last stays for readers that still use it.
        """
        pointer = self._pointer(table)
        seen, state = pointer.current()
        folder = f"{self.path(table)}__versions/{uuid.uuid4().hex}"
        change(self.read(table)).write.format(self.fmt).save(folder)
        before = state.get("folder", self.path(table))
        pointer.switch(seen, {"folder": folder, "before": before})
        if state.get("before", self.path(table)) != self.path(table):
            Files(self.spark).remove([state["before"]])
        return self.read(table)

    def write(self, df: DataFrame, table: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table, schema included, and return it as stored: readers of the
        result start from files, not from the plan that produced them (S04, S05)."""
        writer = df.write.format(self.fmt).mode("overwrite").option("overwriteSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(self.path(table))
        self.spark.catalog.refreshByPath(self.path(table))
        seen, state = self._pointer(table).current()
        if state:  # back from a version to the table's own folder
            self._pointer(table).switch(seen, {"folder": self.path(table)})
        return self.read(table)

    def write_bucketed(self, df: DataFrame, table: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
        """Replace a table, dealt into hash buckets of the keys and sorted in them.

        Tables of as many buckets join and aggregate on the keys without a shuffle. The
        number of buckets follows the session's shuffle partitions, so that tables of a
        session go together. Meant for tables whose keys are unique or already folded: a
        bucket is one task, and no key may hold a large share of the rows. The catalog
        entry that holds the layout belongs to this session and this folder.
        """
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        laid = df.repartition(n, *keys).sortWithinPartitions(*keys)
        return bucketed_table(laid, self.path(table), keys, n, keys)

    def write_counted(self, df: DataFrame, table: str) -> tuple[DataFrame, int]:
        """Write and report the row count; the count is observed by the write itself,
        so no cache and no second job is needed (S14)."""
        seen = Observation(f"rows_{table}")
        stored = self.write(df.observe(seen, F.count(F.lit(1)).alias("n")), table)
        return stored, seen.get.get("n", 0)

    def append(self, df: DataFrame, table: str, *, partition_by: Sequence[str] = ()) -> None:
        """Append; new columns are allowed and old rows read as null."""
        writer = df.write.format(self.fmt).mode("append").option("mergeSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(self.path(table))
        self.spark.catalog.refreshByPath(self.path(table))

    def read_evolved(self, table: str) -> DataFrame:
        """A table whose files were written with different schemas."""
        return self.spark.read.format(self.fmt).option("mergeSchema", "true").load(self.path(table))


def ingest(
    lake: Lake,
    folder: str,
    files: Mapping[str, str],
    schemas: Mapping[str, str] | None = None,
    ingested_at: Column | None = None,
    multi_line: Collection[str] = (),
) -> dict[str, int]:
    """Load every registered CSV into its bronze table (S02); returns rows per table.
    ``multi_line`` names the tables whose fields may hold line breaks."""
    counts = {}
    for table, file in files.items():
        raw = read_csv(lake.spark, os.path.join(folder, file), (schemas or {}).get(table), multi_line=table in multi_line)
        _, counts[table] = lake.write_counted(with_lineage(raw, ingested_at, file), table)
    return counts


CORRUPT = "_corrupt_record"
_BROKEN = "_broken"


@dataclass(frozen=True)
class Landed:
    """What a typed ingestion found: rows and unreadable lines per table, and drift."""

    counts: dict[str, int]
    rejected: dict[str, int]
    drift: DataFrame


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV; reads its first line only."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns


def schema_drift(declared: StructType, header: Sequence[str]) -> list[tuple[str, str]]:
    """(column, change) for columns that a file lacks or has beyond its declared ones."""
    names = declared.names
    return [(c, "missing") for c in names if c not in header] + [(c, "added") for c in header if c not in names]


def read_declared(spark: SparkSession, path: str, declared: StructType, *, multi_line: bool = False) -> DataFrame:
    """A CSV by its declared types, whatever the order of its columns (S01). A line that
    does not fit keeps its text in ``_corrupt_record``; columns that the file lacks are
    null, those beyond the declared ones are left out. The file is read once, not twice
    as for inference."""
    header = header_of(spark, path)
    types = {f.name: f.dataType for f in declared}
    found = StructType([StructField(c, types.get(c, StringType())) for c in header] + [StructField(CORRUPT, StringType())])
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(found).csv(path)
    known = [F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in declared]
    return raw.select(*known, CORRUPT)


def ingest_typed(
    lake: Lake,
    folder: str,
    files: Mapping[str, str],
    schemas: Mapping[str, str],
    log: Callable[[DataFrame, str], None],
    ingested_at: Column | None = None,
    multi_line: Collection[str] = (),
) -> Landed:
    """Load every registered CSV by its declared schema (S02). Unreadable lines go to
    ``log(rows, table)`` with their text and a reason; columns that differ from the
    declared ones are reported. Each file is parsed once, into one folder for the rows and
    one for the lines that are none.
    """
    counts, rejected, drift = {}, {}, []
    for table, file in files.items():
        path, declared = os.path.join(folder, file), StructType.fromDDL(schemas[table])
        drift += [(table, *change) for change in schema_drift(declared, header_of(lake.spark, path))]
        raw = read_declared(lake.spark, path, declared, multi_line=table in multi_line)
        marked = with_lineage(raw, ingested_at, file).withColumn(_BROKEN, F.col(CORRUPT).isNotNull())
        judged = stored(marked, f"landing_{table}", [_BROKEN])
        _, counts[table] = lake.write_counted(judged.where(~F.col(_BROKEN)).drop(_BROKEN, CORRUPT), table)
        seen = Observation(f"broken_{table}")
        broken = judged.where(_BROKEN).drop(_BROKEN).withColumn("error_reason", F.lit("Line does not fit the declared schema"))
        log(broken.observe(seen, F.count(F.lit(1)).alias("n")), table)
        rejected[table] = seen.get.get("n", 0)
    changes = lake.spark.createDataFrame(drift, "table_name string, column_name string, change string")
    return Landed(counts, rejected, changes)


def export_parquet(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Plain parquet export (S09). ``single_file`` writes with one task (the work before
    it stays parallel): use it for small reports only (S08)."""
    (df.repartition(1) if single_file else df).write.mode("overwrite").parquet(path)


def save_as_table(df: DataFrame, name: str) -> None:
    """Managed catalog table, replacing an older one."""
    df.write.mode("overwrite").saveAsTable(name)


def create_namespaces(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def reset_namespace(spark: SparkSession, name: str) -> None:
    """Drop a namespace with everything in it and create it anew."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")


def drop_tables(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, namespace: str, pattern: str = "*") -> DataFrame:
    """Tables of a namespace as rows."""
    return spark.sql(f"SHOW TABLES IN {namespace} LIKE '{pattern}'").select(
        F.col("namespace").alias("schema_name"), F.col("tableName").alias("table_name")
    )


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES").select(F.col("namespace").alias("schema_name"))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows as data."""
    return df.limit(n)


def enforce_types(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast the listed columns; values that do not fit become null.

    ``strict`` raises for a listed column that is missing; else it is skipped.
    """
    absent = [c for c in types if c not in df.columns]
    if strict and absent:
        raise ValueError(f"missing columns: {absent}")
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c not in absent})


def unique_columns(df: DataFrame) -> DataFrame:
    """Every column name once: the first of equally named columns is kept."""
    first = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{i}").alias(name) for name, i in sorted(first.items(), key=lambda e: e[1])])
