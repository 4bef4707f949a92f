"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits. Documents and benchmark items are
joined on shared 5-word seeds. For every document and item with a seed in common the
longest non-overlapping matches are marked, longest first, found by Karp-Rabin hashes of
falling lengths; a document is contaminated by an item when the marked tiles cover at
least half of the item's words. Reordered passages are caught, because tiles may lie in
any order.

Only words inside a seed match can belong to a tile, so each document sends its runs of
seed matches, not its text. Which seeds can match is known from a Bloom filter, sized by
the number of benchmark seeds up to ``FILTER_BITS``; beyond that it lets more candidates
through, and the join on seeds stays exact.

Items of fewer than five words match as a whole. Null and empty texts and items match
nothing. Repeated rows give repeated results; repeated items count once each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import named, stored, text_hash, texts_of, with_text_columns

SEED = 5
COVERAGE = 0.5
FILTER_BITS = 1 << 26  # 8 MB
BITS_PER_SEED, PROBES = 64, 4
REMEMBERED = 400_000
WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class WordHashes(dict):
    def __init__(self, limit: int = REMEMBERED):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = found
        return found


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=32)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2 ** bits powers of the base and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full((1 << bits) - 1, base, np.uint64)]), dtype=np.uint64)
            for base in (_BASE, inverse)
        )


def rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` tokens, modulo 2**64, mixed.

    One running sum of the tokens, each divided by its power of the base, gives every window
    as a difference, whatever its length: the base is odd and has an inverse.
    """
    n = len(tokens) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(tokens).bit_length())
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(tokens * down[: len(tokens)], dtype=np.uint64)])
        total = (sums[length:] - sums[:n]) * up[length - 1 : length - 1 + n]
        return (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length) of the longest matches
    first, until none of ``least`` words is left. Ties go to the first place in the item,
    then in the document. 0 in ``doc`` parts runs and matches nothing."""
    found: list[tuple[int, int, int]] = []
    doc_free, item_free = doc != 0, np.ones(len(item), bool)
    length = min(len(doc), len(item))
    while length >= least:
        match = _first_match(doc, item, doc_free, item_free, length)
        if match is None:
            # no match of this length: go on with the longest that is left
            length = _longest(doc, item, doc_free, item_free, least, length - 1)
            continue
        d, i = match
        found.append((d, i, length))
        doc_free[d : d + length] = item_free[i : i + length] = False
    return found


def _open(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of windows that are wholly unmarked."""
    if len(free) < length:
        return np.empty(0, bool)
    total = np.concatenate([[0], np.cumsum(free)])
    return total[length:] - total[:-length] == length


def _first_match(doc, item, doc_free, item_free, length) -> tuple[int, int] | None:
    in_doc = np.flatnonzero(_open(doc_free, length))
    in_item = np.flatnonzero(_open(item_free, length))
    if not len(in_doc) or not len(in_item):
        return None
    left, right = rolling(doc, length)[in_doc], rolling(item, length)[in_item]
    for at in np.flatnonzero(np.isin(right, left)):
        for d in in_doc[left == right[at]]:
            if (doc[d : d + length] == item[in_item[at] : in_item[at] + length]).all():
                return int(d), int(in_item[at])
    return None


def _longest(doc, item, doc_free, item_free, least, most) -> int:
    """Largest length from least to most with a match, by bisection; least - 1 if none.
    A match of some length holds matches of every smaller one."""
    low, high = least - 1, most
    while low < high:
        middle = (low + high + 1) // 2
        if _first_match(doc, item, doc_free, item_free, middle) is None:
            high = middle - 1
        else:
            low = middle
    return low


def covered(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Words of the item under tiles, and the number of tiles."""
    marked = tiles(doc, item, min(SEED, len(item)))
    return sum(length for _, _, length in marked), len(marked)


def seeds_of(tokens: np.ndarray, length: int) -> np.ndarray:
    """Seed hashes by place, told apart by length."""
    return rolling(tokens, length) ^ np.uint64(length)


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    fields = {"tokens": "array<bigint>", "seeds": "array<bigint>", "seed_words": "bigint"}

    def make():
        def one(text):
            tokens = hashed(words_of(text))
            length = min(SEED, len(tokens))
            seeds = seeds_of(tokens, length) if length else np.empty(0, np.uint64)
            return tokens.view(np.int64), seeds.view(np.int64), length

        return lambda texts: list(map(list, zip(*map(one, texts)))) if texts else [[], [], []]

    items = benchmark.select(
        named(benchmark, id_col).cast("bigint").alias("item_id"), named(benchmark, text_col).alias("text")
    )
    items = with_text_columns(items, fields, make).where("seed_words > 0")
    return stored(items.withColumn("item", F.monotonically_increasing_id()), "items")


def _filter(seeds: DataFrame) -> tuple[int, bytes]:
    """A Bloom filter of the benchmark's seeds: 64 bits a seed, at most ``FILTER_BITS``
    whatever the size of the benchmark. Its words are put together where the seeds are,
    so that no more than the filter itself is collected."""
    bits = 1 << 10
    while bits < min(FILTER_BITS, BITS_PER_SEED * seeds.count()):
        bits <<= 1
    step = f"(shiftrightunsigned(seed, 32) & {bits - 1}L)"
    places = ", ".join(f"((seed & {bits - 1}L) + {i}L * {step}) & {bits - 1}L" for i in range(PROBES))
    words = seeds.select(F.explode(F.expr(f"array({places})")).alias("place"))
    words = words.groupBy(F.expr("shiftright(place, 5)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 31L AS int))")).alias("bits")
    )
    out = np.zeros(bits // 32, np.uint32)
    for row in words.toLocalIterator():
        out[row.word] = row.bits
    return bits, out.tobytes()


def _passed(seeds: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Places of the seeds that the filter may hold."""
    mask = np.uint64(bits - 1)
    at = np.arange(len(seeds))
    for i in range(PROBES):
        some = seeds[at]
        place = ((some & mask) + np.uint64(i) * (some >> np.uint64(32) & mask)) & mask
        at = at[(words[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32) & np.uint32(1)) == 1]
    return at


def _runs(bits: int, shared, lengths: list[int]) -> Callable[[], Callable[[list], list[list]]]:
    """Seeds of a text that the filter lets through, and its runs of words under them."""

    def make():
        words = np.frombuffer(shared.value, np.uint32)

        def one(text: str | None) -> tuple:
            tokens = hashed(words_of(text))
            seeds, under = [], np.zeros(len(tokens) + 1, np.int64)
            for length in lengths:
                each = seeds_of(tokens, length)
                hits = _passed(each, words, bits)
                seeds.append(each[hits])
                np.add.at(under, hits, 1)
                np.add.at(under, hits + length, -1)
            if not sum(map(len, seeds)):
                return None, None, len(tokens)
            inside = np.cumsum(under[:-1]) > 0
            # one 0 stands for each gap
            shown = inside | np.concatenate([[True], inside[:-1]])
            runs = np.where(inside, tokens, np.uint64(0))[shown]
            return np.unique(np.concatenate(seeds)).view(np.int64), runs.view(np.int64), len(tokens)

        return lambda texts: list(map(list, zip(*map(one, texts)))) if texts else [[], [], []]

    return make


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("runs").to_pylist(), batch.column("tokens").to_pylist())
        found = [covered(*(np.array(x, np.int64).view(np.uint64) for x in pair)) for pair in pairs]
        keep = [k for k, n in enumerate(batch.schema.names) if n not in ("runs", "tokens")]
        arrays = [batch.column(k) for k in keep]
        arrays += [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())]
        names = [batch.schema.names[k] for k in keep] + ["covered_words", "n_tiles"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item whose tiles cover enough of the item: doc_id,
    text_hash, item_id, item_words, covered_words, n_tiles, coverage, doc_words."""
    items = _items(benchmark, item_id_col, item_text_col)
    seeds = items.select("item", F.explode("seeds").alias("seed")).groupBy("item", "seed")
    seeds = stored(seeds.agg(F.count("*").alias("times")), "seeds")
    bits, held = _filter(seeds.select("seed").distinct())
    lengths = sorted(r[0] for r in items.select("seed_words").distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast(held)

    rows = texts_of(docs, id_col, text_col).withColumn("text_hash", text_hash(F.col("text")))
    fields = {"seeds": "array<bigint>", "runs": "array<bigint>", "doc_words": "bigint"}
    rows = with_text_columns(rows, fields, _runs(bits, shared, lengths)).where("seeds IS NOT NULL")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "runs")

    pairs = rows.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
    # tiles consist of shared seeds, and so many seeds cover so many words at most
    pairs = pairs.groupBy("row", "item").agg(F.sum("times").alias("shared"))
    pairs = pairs.join(items.select("item", "item_id", "tokens", "seed_words"), "item")
    pairs = pairs.where(F.col("shared") * F.col("seed_words") >= coverage * F.size("tokens"))
    pairs = stored(pairs.drop("seed_words", "shared", "item"), "pairs")
    pairs = pairs.withColumn("item_words", F.size("tokens").cast("bigint")).join(
        rows.select("row", "doc_id", "text_hash", "runs", "doc_words"), "row"
    )
    columns = "doc_id bigint, text_hash bigint, item_id bigint, item_words bigint, doc_words bigint"
    pairs = pairs.select(*(c.split()[0] for c in columns.split(", ")), "tokens", "runs")
    tiled = pairs.mapInArrow(_tiled, columns + ", covered_words bigint, n_tiles bigint")
    tiled = tiled.withColumn("coverage", F.col("covered_words") / F.col("item_words"))
    return tiled.where(F.col("coverage") >= coverage)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **columns: str) -> DataFrame:
    """One row per contaminated document and text: its best covered item and how many
    items it holds. Documents without a row are clean."""
    found = matches(docs, benchmark, coverage, **columns)
    best = F.max_by(
        F.struct("item_id", "coverage", "covered_words", "n_tiles"), F.struct("coverage", "covered_words", -F.col("item_id"))
    )
    found = found.groupBy("doc_id", "text_hash").agg(F.countDistinct("item_id").alias("n_items"), best.alias("best"))
    return found.select("doc_id", "text_hash", "n_items", "best.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **columns: str) -> DataFrame:
    """The documents that hold no benchmark item, all columns unchanged."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    found = contaminated(docs, benchmark, coverage, **columns)
    found = stored(found.selectExpr("doc_id AS found_id", "text_hash AS found_hash"), "contaminated")
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    doc, text = (plain[f"c{names.index(c)}"] for c in (id_col, text_col))
    same = doc.cast("bigint").eqNullSafe(found.found_id) & (text_hash(text) == found.found_hash)
    return plain.join(found, same, "left_anti").toDF(*names)
