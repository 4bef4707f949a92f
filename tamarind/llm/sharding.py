"""Sharding by jump consistent hashing: a stable key and the number of shards decide, no
ring table is kept, and one more shard only takes rows into itself.

The key is the document id; a null id counts as 0. Null text has size 1 and the checksum
of no bytes. Repeated rows share a shard and have slots of their own. Slots are numbered
from stored rows, so a lost executor never renumbers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.common import stored, texts_of

SHARDS = 8
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key by jump consistent hashing (Lamping and Veach, 2014)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = np.asarray(keys, dtype=np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(moving):
            state[moving] = state[moving] * STEP + np.uint64(1)
            draw = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            target = np.floor((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            moving, target = moving[target < shards], target[target < shards]
            shard[moving] = target
    return shard


def _numbered(shards: int):
    """Shards of a partition's rows, each with its number among the rows of that shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            keys = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            shard, place = jump(keys, shards), np.zeros(len(keys), dtype=np.int64)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                place[at] = held[s] + np.arange(len(at))
                held[s] += len(at)
            added = [pa.array(x) for x in (shard.astype(np.int32), jump(keys, shards + 1).astype(np.int32), place)]
            names = [*batch.schema.names, "shard", "grown_shard", "place"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return run


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with shard, slot and the shard it would have with one more.

    Each task numbers its rows within each shard; only one count per task and shard is
    summed up, so no shard passes through a single task.
    """
    rows = texts_of(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    numbered = rows.mapInArrow(
        _numbered(shards), "doc_id bigint, size bigint, text_crc32 bigint, shard int, grown_shard int, place bigint"
    )
    numbered = stored(numbered.withColumn("task", F.spark_partition_id()), "sharding")
    counts = numbered.groupBy("shard", "task").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return numbered.join(starts, ["shard", "task"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("place")).alias("slot"),
        "grown_shard",
    )
