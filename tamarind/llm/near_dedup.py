"""Near-duplicates by b-bit MinHash.

Every text gets minima over its distinct 5-word shingles (at 85 percent 125, at 80
percent 175). Bands of five minima bring candidates together; the low four bits of all
minima are packed (at 85 percent into 64 bytes), from which bit counts give a similarity
corrected for chance collisions. Pairs whose estimate is far below the threshold are left;
all others are confirmed on their full shingle sets. The number of bands and the least
estimate follow from the threshold.

How hot groups are met:

* equal word sequences become one node before anything else, in a combinable aggregate;
* nodes that share a band are joined into clusters by stars on the smallest node, so no
  pair within a bucket is written;
* a cluster is compared in blocks of bounded size. Each block also gets the cluster's
  pivots, a fixed number of nodes that ties the blocks' classes together;
* what a pivot did not tie to the cluster's largest class is compared with all blocks,
  which makes the links complete.

A pair at the threshold shares no band with a chance under 1e-6 and falls below the
estimate's margin with one of about 1e-5; nothing else can lose a link.

Null and empty texts have no shingles and are linked with nothing. Texts of fewer than
five words have one shingle, the whole sequence. Repeated rows share a class; rows without
an id take part but cannot name a class that has an id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import named, stored, text_hash, texts_of, with_text_columns
from tamarind.llm.graphs import components

SHINGLE = 5
PERCENT = 85
ROWS, BITS = 5, 4
MISS = 1e-6
SPREADS = 4.5
BLOCK, PIVOTS = 256, 32
REMEMBERED = 400_000


def bands_at(percent: int) -> int:
    """Bands, in fives, of which a pair at the threshold shares none with a chance below
    ``MISS``."""
    alike = (min(percent, 99) / 100) ** ROWS
    return 5 * math.ceil(math.log(MISS) / math.log(1 - alike) / 5)


def least_estimate(percent: int) -> float:
    """The threshold less ``SPREADS`` times the spread of estimates around it."""
    chance, hashes = 1 / (1 << BITS), bands_at(percent) * ROWS
    agree = percent / 100 * (1 - chance) + chance
    spread = math.sqrt(agree * (1 - agree) / hashes) / (1 - chance)
    return math.floor(100 * (percent / 100 - SPREADS * spread)) / 100


@lru_cache(maxsize=8)
def _numbers(bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_229)
    hashes = bands * ROWS
    a = draw.integers(0, 1 << 32, hashes, dtype=np.uint32) | np.uint32(1)
    b = draw.integers(0, 1 << 32, hashes, dtype=np.uint32)
    place = draw.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
    band = draw.integers(0, 1 << 63, (bands, ROWS), dtype=np.uint64) | np.uint64(1)
    return a, b, place, band


_PLACE = _numbers(bands_at(PERCENT))[2]
_NIBBLES = np.uint64(0x1111111111111111)


class WordHashes(dict):
    """64-bit hashes of words, the first ``limit`` different ones remembered."""

    def __init__(self, limit: int = REMEMBERED):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = found
        return found


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: ASCII letters and white space only


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def shingles_of(words: list[bytes]) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += each[k : k + n] * _PLACE[k]
    return np.unique(mixed(total))


def minima_of(shingles: np.ndarray, at_once: int = 20_000, percent: int = PERCENT) -> np.ndarray:
    a, b, _, _ = _numbers(bands_at(percent))
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), at_once):
        part = short[start : start + at_once, None]
        np.minimum(low, (part * a + b).min(axis=0), out=low)
    return low


def bands_of(minima: np.ndarray) -> np.ndarray:
    band = _numbers(len(minima) // ROWS)[3]
    keys = (minima.reshape(-1, ROWS).astype(np.uint64) * band).sum(axis=1, dtype=np.uint64)
    return mixed(keys).view(np.int64)


def signature_of(minima: np.ndarray) -> bytes:
    """The low four bits of each minimum, two in a byte, filled up to whole 64-bit words."""
    bits = np.zeros(16 * math.ceil(len(minima) / 16), np.uint8)
    bits[: len(minima)] = minima & np.uint32(15)
    return (bits[0::2] << np.uint8(4) | bits[1::2]).tobytes()


def estimates(one: np.ndarray, many: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Similarities of one signature to many (as words of 64 bits), from the count of
    different nibbles, corrected for nibbles that agree by chance."""
    x = many ^ one
    x = (x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & _NIBBLES
    agree = 1 - np.bitwise_count(x).sum(axis=1) / (bands_at(percent) * ROWS)
    chance = 1 / (1 << BITS)
    return (agree - chance) / (1 - chance)


SIGNED = {
    "key_a": "bigint",
    "key_b": "bigint",
    "n_shingles": "bigint",
    "signature": "binary",
    "bands": "array<bigint>",
}


def _key(words: list[bytes]) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(b" ".join(words))
    return tuple(np.frombuffer(digest, np.int64).tolist())


def signer(percent: int = PERCENT) -> Callable[[list], list[list]]:
    def one(text: str | None) -> tuple:
        words = words_of(text)
        if not words:
            return (None, None, 0, None, None)
        shingles = shingles_of(words)
        minima = minima_of(shingles, percent=percent)
        return (*_key(words), len(shingles), signature_of(minima), bands_of(minima))

    return lambda texts: list(map(list, zip(*map(one, texts)))) if texts else [[] for _ in SIGNED]


def is_linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


class Group:
    """Rows of one block: links between their classes, confirmed on full sets."""

    def __init__(self, rows: list[dict], percent: int = PERCENT):
        self.percent, self.least = percent, least_estimate(percent)
        rows.sort(key=lambda r: (r["node"], r["probe"]))
        self.rows = rows
        self.signatures = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint64).reshape(len(rows), -1)
        self.sizes = np.array([r["n_shingles"] for r in rows])
        self.sets: dict[int, np.ndarray] = {}
        self.parent: dict[int, int] = {}

    def root(self, label: int) -> int:
        while self.parent.setdefault(label, label) != label:
            self.parent[label] = label = self.parent[self.parent[label]]
        return label

    def shingles(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = shingles_of(words_of(self.rows[i]["text"]))
        return self.sets[i]

    def candidates(self) -> list[tuple[int, int]]:
        """Pairs by falling estimate. With probes, pairs of a probe and another row."""
        probes = [i for i, r in enumerate(self.rows) if r["probe"]]
        bases = np.array([i for i, r in enumerate(self.rows) if not r["probe"]], dtype=np.int64)
        found = []
        for i in probes or bases.tolist():
            others = bases if probes else bases[bases > i]
            small, large = np.minimum(self.sizes[others], self.sizes[i]), np.maximum(self.sizes[others], self.sizes[i])
            others = others[100 * small >= self.percent * large]
            if len(others):
                near = estimates(self.signatures[i], self.signatures[others], self.percent)
                found += [(-e, i, j) for e, j in zip(near.tolist(), others.tolist()) if e >= self.least]
        return [(i, j) for _, i, j in sorted(found)]

    def links(self) -> list[tuple[int, int]]:
        """Pairs of nodes that join two classes; classes joined before are not compared."""
        out = []
        for i, j in self.candidates():
            a, b = self.root(self.rows[i]["label"]), self.root(self.rows[j]["label"])
            if a != b and is_linked(self.shingles(i), self.shingles(j), self.percent):
                self.parent[max(a, b)] = min(a, b)
                out.append((self.rows[i]["node"], self.rows[j]["node"]))
        return out


def _links(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links within runs of rows that have the same group."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def found(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            pairs = Group(rows, percent).links() if len(rows) > 1 else []
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["a", "b"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[-1]["part"] != row["part"]:
                    yield from found(held)
                    held = []
                held.append(row)
        if held:
            yield from found(held)

    return links


PARTS = ["node", "label", "probe", "signature", "n_shingles", "text"]


def _linked(rows: DataFrame, percent: int, *key: str) -> DataFrame:
    """Links (a, b) within the groups of the key columns, each in one run of one task."""
    rows = rows.select(*PARTS, F.concat_ws("/", *key).alias("part"))
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_links(percent), "a bigint, b bigint")


def _cluster_rows(docs: DataFrame, nodes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Every clustered node with its cluster, its blocks and a text of it."""
    sizes = stored(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    rows = nodes.drop("bands").join(clusters, "node").join(sizes, "cluster")
    rows = stored(rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK)), "clustered")
    keys = {"key_a2": "bigint", "key_b2": "bigint"}

    def keyed():
        return lambda texts: list(map(list, zip(*(_key(words_of(t)) for t in texts)))) if texts else [[], []]

    # an id may belong to several texts: the key says which of them is the node's
    wanted = rows.select(F.col("low_id").alias("wanted_id")).distinct()
    # a merge join at every size: what is moved then grows with the input, not in a step
    texts = docs.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    copies = texts.withColumn("copy", F.col("text"))
    texts = with_text_columns(copies, keys, keyed).groupBy("key_a2", "key_b2").agg(F.first("copy").alias("text"))
    same = (F.col("key_a") == F.col("key_a2")) & (F.col("key_b") == F.col("key_b2"))
    return stored(rows.join(texts, same).drop("key_a", "key_b", "key_a2", "key_b2", "low_id"), "cluster_texts")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Classes of texts linked at ``percent`` similarity. One row per document: doc_id, text_hash, n_shingles, component (null without
    shingles), component_id (the smallest id in reach) and kept."""
    docs = texts_of(docs, id_col, text_col)
    signed = stored(
        with_text_columns(docs.withColumn("text_hash", text_hash(F.col("text"))), SIGNED, lambda: signer(percent)), "signed"
    )
    nodes = signed.where("n_shingles > 0").groupBy("key_a", "key_b")
    nodes = nodes.agg(
        F.min("doc_id").alias("low_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
        F.first("bands").alias("bands"),
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    banded = nodes.select("node", F.explode("bands").alias("band"))
    stars = banded.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = stored(stars, "stars")
    edges = banded.join(stars, "band").select("a", F.col("node").alias("b"))
    clusters = stored(components(edges).withColumnRenamed("component", "cluster"), "clusters")

    rows = _cluster_rows(docs, nodes, clusters)
    # pivots go to every block of their cluster, the other rows to their own
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    pivot = F.pmod(F.xxhash64("node", F.lit("pivot")), F.col("size")) < PIVOTS
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    blocks = F.when((F.col("blocks") > 1) & pivot, every).otherwise(F.array(own))
    within = rows.withColumn("block", F.explode(blocks)).withColumn("label", F.col("node"))
    links = stored(_linked(within.withColumn("probe", F.lit(False)), percent, "cluster", "block"), "links")

    links = links.union(_rest(rows, links, own, every, percent))
    found = components(links)
    named_nodes = nodes.join(found, "node", "left")
    named_nodes = stored(
        named_nodes.select("key_a", "key_b", "low_id", F.coalesce("component", "node").alias("component")), "components"
    )
    lowest = named_nodes.groupBy("component").agg(F.min("low_id").alias("component_id"))
    named_nodes = stored(named_nodes.drop("low_id").join(lowest, "component"), "classes")

    out = signed.select("doc_id", "text_hash", "key_a", "key_b", "n_shingles").join(named_nodes, ["key_a", "key_b"], "left")
    lone = F.col("n_shingles") == 0
    out = out.withColumn("component_id", F.when(lone, F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", "component", "component_id", kept.alias("kept"))


def _rest(rows: DataFrame, links: DataFrame, own, every, percent: int) -> DataFrame:
    """Links between classes of clusters of several blocks that the blocks did not show:
    the nodes outside a cluster's largest class are compared with all its nodes."""
    large = rows.where("blocks > 1")
    if large.isEmpty():
        return links.limit(0)
    found = components(links)
    labelled = large.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    labelled = stored(labelled, "labelled")
    counts = labelled.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    largest = counts.groupBy("cluster").agg(
        F.max_by("label", F.col("n")).alias("main"), (F.sum("n") - F.max("n")).alias("others")
    )
    largest = stored(largest.where("others > 0"), "largest")
    labelled = labelled.join(largest, "cluster").withColumn("probe_blocks", F.ceil(F.col("others") / BLOCK))
    probe_own = F.pmod(F.xxhash64("node", F.lit("probe")), F.col("probe_blocks"))
    probe_every = F.sequence(F.lit(0).cast("bigint"), F.col("probe_blocks") - 1)
    bases = labelled.withColumn("block", own).withColumn("probe_block", F.explode(probe_every))
    probes = labelled.where("label <> main").withColumn("block", F.explode(every)).withColumn("probe_block", probe_own)
    both = bases.withColumn("probe", F.lit(False)).union(probes.withColumn("probe", F.lit(True)))
    return stored(_linked(both, percent, "cluster", "block", "probe_block"), "links")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document with its class."""
    return classes(docs, id_col, text_col, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents with one of each class left, all columns unchanged. Documents
    without shingles all stay. Where rows share the class's id, one text of it stays
    (that with the smallest hash), and of equal rows one."""
    found = stored(classes(docs, id_col, text_col, percent), "classes")
    chosen = found.where("kept AND component IS NOT NULL").groupBy("component").agg(
        F.first("doc_id", ignorenulls=True).alias("found_id"), F.min("text_hash").alias("found_hash")
    )
    copies = found.where("kept AND component IS NOT NULL").groupBy("component", "text_hash").agg(F.count("*").alias("n"))
    chosen = chosen.join(copies.withColumnRenamed("text_hash", "found_hash"), ["component", "found_hash"])
    lone = found.where("component IS NULL").select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), F.lit(1).cast("bigint").alias("n")
    )
    chosen = stored(chosen.select("found_id", "found_hash", "n").union(lone.distinct()), "chosen")

    columns = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    doc, text = (plain[f"c{columns.index(c)}"] for c in (id_col, text_col))
    same = doc.cast("bigint").eqNullSafe(chosen.found_id) & (text_hash(text) == chosen.found_hash)
    kept = plain.join(chosen, same)
    single = kept.where("n = 1").select(*plain.columns)
    row = F.struct(*plain.columns)  # as text it has an order, whatever its columns are
    several = kept.where("n > 1").groupBy("found_id", "found_hash").agg(F.min_by(row, F.to_json(row)).alias("row"))
    return single.union(several.select("row.*")).toDF(*columns)
