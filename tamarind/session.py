"""Session factory and scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that keep shuffles adaptive: partition counts are chosen from
# measured sizes, hot join partitions are split even when that costs a shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# For plans over stored tables. Rows that lie by some of a join's keys stay where they lie;
# shuffle files go when the statement that wrote them ends, as what it was for is stored by
# then (a frame that is run again writes them again).
STORING = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def adaptive(spark: SparkSession, settings: Mapping[str, str] = ADAPTIVE) -> SparkSession:
    """Apply the adaptive settings to a session that somebody else created."""
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def initial_partitions(data_bytes: int, target: int = 128 << 20) -> int:
    """Shuffle partitions to start from for the largest shuffled input, so that one
    partition fits in a task's memory. Adaptive execution can merge partitions that
    turn out small, but it cannot add any."""
    return max(200, -(-data_bytes // target))


def build_session(
    app: str = "tamarind", master: str | None = None, data_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with adaptive execution, sized for the data when ``data_bytes`` is
    given. Storage secrets and cluster sizes belong to the deployment
    (spark-defaults), not to this function."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.checkpoint.compress", "true")
    if master:
        builder = builder.master(master)
    if data_bytes is not None:
        partitions = str(initial_partitions(data_bytes))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    for key, value in {**ADAPTIVE, **STORING, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where all executors share the machine, may fall back to
    a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tamarind-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ready_for_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding the cluster's folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Stored tables are read a few times at most, so they are compressed well.
CODEC = "zstd"


def by_buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt as tables in buckets of the keys are, so that they meet such tables where
    these lie: only these rows are moved."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, lineage cut.
    What a table remembers of its rows' places (a running number, a task's number) stays
    as it was written, also when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)
