"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tamarind.session import adaptive, scratch_path

ARROW_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
    "array<double>": pa.list_(pa.float64()),
}

# Rows that Spark hands to Python at once; what Python works on at once is cut by bytes.
ROWS_PER_BATCH = "2000"
BYTES_PER_SLICE = 8 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, so that they need no install."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    place = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(place, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(place)
    _shipped.add(context.applicationId)


def prepared(spark: SparkSession) -> SparkSession:
    """The session with adaptive plans, Arrow batches of bounded length, and this
    package on its executors."""
    ship(spark)
    adaptive(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def named(df: DataFrame, name: str) -> Column:
    """A column by its exact name, also where the name holds dots or back quotes."""
    return df["`" + name.replace("`", "``") + "`"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and whole text only, under fixed names, so that no other column can clash."""
    return docs.select(named(docs, id_col).cast("bigint").alias("doc_id"), named(docs, text_col).alias("text"))


def text_hash(text: Column) -> Column:
    """Tells texts of one doc_id apart; null has a value of its own."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = BYTES_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of the column, one row at least."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def with_text_columns(
    df: DataFrame, fields: dict[str, str], maker: Callable[[], Callable[[list], list[list]]], text: str = "text"
) -> DataFrame:
    """``df`` without its text, with new columns computed from it in Arrow batches.

    ``maker()`` runs once per task and gives a function from a list of texts (None for
    null) to one list of values per field.
    """
    rest = [f for f in df.schema.fields if f.name != text]
    schema = StructType(rest + [StructField(n, _parse_datatype_string(t)) for n, t in fields.items()])
    names, types = list(fields), [ARROW_TYPES[t] for t in fields.values()]
    others = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = maker()
        for batch in batches:
            for part in byte_slices(batch, text):
                values = measure(part.column(text).to_pylist())
                arrays = [part.column(n) for n in others] + [pa.array(v, t) for v, t in zip(values, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=others + names)

    return df.mapInArrow(run, schema)


def rows_where(df: DataFrame, keep: Callable[[], Callable[[list], list[bool]]], text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns unchanged, whose text is kept. Columns go by
    place inside, so that any names do."""
    at = df.columns.index(text)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = keep()
        for batch in batches:
            for part in byte_slices(batch, f"c{at}"):
                yield part.filter(pa.array(decide(part.column(at).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)
