"""Importance resampling towards a target distribution over hashed n-gram features.

Features are runs of 1 to ``order`` consecutive words; a feature's bucket is the CRC-32 of
its bytes modulo the number of buckets. A bucket's gain is the scaled log ratio of its
smoothed shares in the target and in the corpus, a document's weight the floored mean of
its features' gains. Gumbel noise from a hash of the id is added, and the best documents
among those with enough words are drawn: sampling without replacement in proportion to
the weights' exponentials, the same at every run.

Buckets come from length-bucketed CRC matrices: the distinct features of a block are
grouped by length into two-dimensional byte arrays, the CRCs of a whole group advance
column by column, and buckets are scattered back to the features. A feature of over
``LONGEST`` bytes is alone in its group more often than not and goes through zlib, with
the same result.

Corpus counts cover all rows. What grows with the corpus stays distributed; the driver
holds one row per bucket (a parameter) and counts per range of scores, of which there
are at most a few hundred, as both parts of a score are bounded logarithms.

Null and empty texts have no features, weight 0 and cannot be drawn unless ``least`` is
0. A null id is hashed as no characters and comes after all others among ties. Repeated
rows are documents of their own; equal ones take neighbouring ranks. An empty table gives
no rows, an empty target the ratios of T = 0. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.common import byte_slices, named, stored, text_hash, texts_of

BUCKETS = 10_000
ORDER = 1
LEAST = 20
PERCENT = 10
SEED = 2024
SCALE = 1_000
BLOCK = 1 << 20
LONGEST = 1 << 10
# Scores of one range are counted together when the last drawn score is looked for.
RANGE = 256

LOWERED = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _crc_table() -> np.ndarray:
    """What one byte does to a CRC-32 (reflected polynomial of ISO 3309)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


CRC = _crc_table()


def crcs(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a two-dimensional uint8 array, column by column."""
    state = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        state = CRC[(state ^ column) & 0xFF] ^ (state >> np.uint32(8))
    return ~state


def crc_of(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each feature: one matrix per length, results scattered back."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, bounds) if len(order) else []:
        length = int(lengths[group[0]])
        rows = [features[i] for i in group.tolist()]
        if length > LONGEST:
            out[group] = [zlib.crc32(row) for row in rows]
        else:
            out[group] = crcs(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), length))
    return out


def word_blocks(text: str | None, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, in lists from about ``size`` bytes of it each."""
    raw = (text or "").encode().translate(LOWERED)
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + size)
        stop = len(raw) if stop < 0 else stop
        if words := raw[start:stop].split():
            yield words
        start = stop


def feature_blocks(text: str | None, order: int, size: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Number of words and features of a text, block by block; a run over a border counts
    in the block that it ends in."""
    carried: list[bytes] = []
    for words in word_blocks(text, size):
        features, joined = list(words), carried + words
        for n in range(2, order + 1):
            runs = joined[max(len(carried) - n + 1, 0) :]
            features += map(b" ".join, zip(*(runs[k:] for k in range(n))))
        yield len(words), features
        carried = joined[max(len(joined) - order + 1, 0) :] if order > 1 else []


def _bucketed(
    texts: list[str | None], buckets: int, order: int
) -> Iterator[tuple[list[int], list[int], list[int], np.ndarray]]:
    """Blocks of places of texts, their numbers of words and of features there, and the
    buckets of all these features."""
    held: list[tuple[int, int, list[bytes]]] = []
    size = 0

    def flush():
        places, words, features = zip(*held)
        distinct = list(set().union(*features))
        bucket = dict(zip(distinct, (crc_of(distinct) % np.uint32(buckets)).tolist()))
        counts = [len(f) for f in features]
        found = np.fromiter((b for f in features for b in map(bucket.__getitem__, f)), np.int64, sum(counts))
        return list(places), list(words), counts, found

    for at, text in enumerate(texts):
        for words, features in feature_blocks(text, order):
            held.append((at, words, features))
            size += sum(map(len, features))
            if size >= BLOCK:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): features per bucket over all texts. Each task sends one row per bucket
    that it met; Spark sums them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                for *_, found in _bucketed(part.column("text").to_pylist(), buckets, order):
                    total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    """The counts by bucket; at most one row per bucket reaches the driver."""
    vector = np.zeros(buckets, np.float64)
    for row in counts.collect():
        vector[row.bucket] = row.n
    return vector


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of add-one smoothed shares, floored."""
    n = len(corpus)
    ratio = ((target + 1) * (corpus.sum() + n)) / ((corpus + 1) * (target.sum() + n))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """doc_id, copy (tells texts of an id apart), n_words, n_features and weight."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                rows = part.num_rows
                words, features, total = (np.zeros(rows, np.int64) for _ in range(3))
                for at, n_words, counts, found in _bucketed(part.column("text").to_pylist(), buckets, order):
                    np.add.at(words, at, n_words)
                    np.add.at(features, at, counts)
                    # sums of whole numbers, far below 2 ** 53
                    sums = np.bincount(np.repeat(at, counts), weights=gain[found], minlength=rows)
                    total += sums.astype(np.int64)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                columns = [part.column("doc_id"), part.column("copy"), *map(pa.array, (words, features, weight))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "n_words", "n_features", "weight"])

    given = docs.withColumn("copy", text_hash(F.col("text")))
    return given.mapInArrow(run, "doc_id bigint, copy bigint, n_words bigint, n_features bigint, weight bigint")


def noisy(rows: DataFrame, seed: int) -> DataFrame:
    """Adds the score: weight plus scaled Gumbel noise from a hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-SCALE * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", (F.col("weight") + noise).cast("bigint"))


def last_drawn(eligible: DataFrame, wanted: int) -> int:
    """The least score among the ``wanted`` best: first its range, then the score."""
    at = F.floor(F.col("score") / RANGE).cast("bigint")

    def after(counts: DataFrame, left: int) -> tuple[int, int]:
        """The group in which the ``left``-th best row lies, and how many of its rows."""
        for key, n in sorted((tuple(row) for row in counts.collect()), reverse=True):
            if n >= left:
                break
            left -= n
        return key, left

    part, left = after(eligible.groupBy(at.alias("part")).agg(F.count("*")), wanted)
    return after(eligible.where(at == part).groupBy("score").agg(F.count("*")), left)[0]


def ranked(rows: DataFrame, wanted: int) -> DataFrame:
    """The ``wanted`` first rows by score, id and copy, numbered from 1.

    Rows are range-partitioned by the whole order with a running number, so that neither
    a hot score nor a large group of copies fills a task, and stored; counts per stored
    partition give each row's rank.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("copy"), F.asc("running")]
    running = rows.withColumn("running", F.monotonically_increasing_id())
    laid = running.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.spark_partition_id())
    laid = stored(laid.drop("running"), "ranked")
    place = F.col("at") - F.shiftleft(F.col("task").cast("bigint"), 33)
    counts = laid.groupBy("task").agg(F.count("*").alias("rows"))
    # one row per task, summed up in groups of 1 000 first
    grouped = counts.withColumn("part", F.floor(F.col("task") / 1_000))
    totals = grouped.groupBy("part").agg(F.sum("rows").alias("all"))
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("all").over(first), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = grouped.withColumn("start", F.coalesce(F.sum("rows").over(within), F.lit(0))).join(totals, "part")
    numbered = laid.join(starts.select("task", (F.col("base") + F.col("start")).alias("start")), "task")
    rank = (F.col("start") + place + 1).cast("bigint")
    return numbered.withColumn("rank", F.when(rank <= wanted, rank)).drop("at", "task", "start")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least: int = LEAST,
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Every document's n_features, weight, score and, where it is drawn, rank: the best
    ``percent`` of the documents with ``least`` words."""
    texts = texts_of(docs, id_col, text_col)
    corpus = _vector(bucket_counts(texts, buckets, order), buckets)
    wanted_counts = _vector(bucket_counts(target.select(named(target, target_col).alias("text")), buckets, order), buckets)
    scored = stored(noisy(weighted(texts, gains(corpus, wanted_counts), order), seed), "scored")
    long_enough = F.col("n_words") >= least
    eligible = scored.where(long_enough)
    draw = percent * eligible.count() // 100
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    none = F.lit(None).cast("bigint")
    if not draw:
        return scored.withColumn("rank", none).select(*columns)
    best = long_enough & (F.col("score") >= last_drawn(eligible, draw))
    rest = scored.where(~best).withColumn("rank", none)
    return ranked(scored.where(best), draw).select(*columns).unionAll(rest.select(*columns))
