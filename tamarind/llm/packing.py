"""Packing by best-fit decreasing: documents become tokens, overlong ones are first cut
into full windows, and each piece goes into the tightest open window that still holds
it. A segment tree over remaining capacities finds that window.

The stored pieces are dealt evenly into bins of bounded size by their running number, so
that neither one document nor one length can fill a task; each bin is packed by itself.
Texts of a tokenizer that keeps words apart are encoded word by word, those of any other
as wholes. Null and empty texts are the end token alone. Repeated rows are packed as often as they
occur. Every token lies in exactly one piece.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.common import byte_slices, stored, texts_of
from tamarind.llm.tokens import tokenizer

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2_048
END = 1
# A bin holds about this many windows of tokens: enough pieces for a close fit, few
# enough for one task.
WINDOWS_PER_BIN = 512
REMEMBERED = 600_000
CLOSING = b".,;:!?"
# Byte-level vocabularies write each byte as a letter: printable bytes as themselves, the
# others, in order, as the letters from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}



class WordIds(dict):
    """Ids of lower-cased words as bytes. New words are encoded when first asked for;
    the first ``limit`` of them are remembered, which are mostly the frequent ones."""

    def __init__(self, vocabulary: str, limit: int = REMEMBERED):
        super().__init__()
        self.encode, self.limit = tokenizer(vocabulary), limit

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(CLOSING)
        if core != word and core[-1:].isalnum():
            # an ASCII letter or digit and closing marks are never in one token
            ids = self[core] + self[word[len(core) :]]
        else:
            text = word.decode()
            if text.isalpha() and max(text) <= "\xff":  # nothing to compose or to split
                letters = text.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
                found = [t.id for t in self.encode.model.tokenize(letters)]
            else:
                found = self.encode.encode(text, add_special_tokens=False).ids
            ids = np.asarray(found, dtype="<u4").tobytes()
        if len(self) < self.limit:
            self[word] = ids
        return ids


@lru_cache(maxsize=4)
def word_ids(vocabulary: str) -> WordIds:
    """One memory of words per Python worker, kept from task to task."""
    return WordIds(vocabulary)


def encoder(known: WordIds) -> Callable[[str | None], bytes]:
    """Little-endian 32-bit ids of a text, the end token included.

    The pre-tokenizer drops white space and no token reaches over it, so the ids of a
    text are those of its words in order. ASCII capitals are lowered first, as the
    normalizer does, unless the text could hold a special token.
    """
    last = np.uint32(END).astype("<u4").tobytes()

    def ids_of(text: str | None) -> bytes:
        raw = (text or "").encode()
        words = (raw if b"<|" in raw else raw.lower()).split()
        return b"".join(map(known.__getitem__, words)) + last

    return ids_of


@lru_cache(maxsize=4)
def keeps_words_apart(vocabulary: str) -> bool:
    """Whether a tokenizer lowers its text and drops the white space between words, so that
    the ids of a text are those of its words."""
    parts = json.loads(tokenizer(vocabulary).to_str())
    steps = [step["type"] for step in (parts["normalizer"] or {}).get("normalizers", [])]
    first = ((parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    return steps == ["NFC", "Replace", "Lowercase"] and (first.get("behavior"), first.get("invert")) == ("Removed", True)


def whole_encoder(vocabulary: str) -> Callable[[str | None], bytes]:
    """As ``encoder``, for any tokenizer: each text in one call."""
    encode, last = tokenizer(vocabulary).encode, np.uint32(END).astype("<u4").tobytes()
    return lambda text: np.asarray(encode(text or "", add_special_tokens=False).ids, "<u4").tobytes() + last


PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, number bigint"


def _pieces(vocabulary: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_words = keeps_words_apart(vocabulary)
        ids_of, number = encoder(word_ids(vocabulary)) if by_words else whole_encoder(vocabulary), 0
        for batch in batches:
            for part in byte_slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = ids_of(text)
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, number))
                        number += 1
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECE.split(", ")])

    return run


class OpenWindows:
    """Segment tree over remaining capacities 0..size: how many open windows have each."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.held[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Capacity and number of the tightest window with ``least`` left or more."""
        node = self.leaves + least
        if not self.tree[node]:
            # up to the first subtree on the right that has a window, then down its left
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.held[capacity].pop()

    def _add(self, capacity: int, step: int) -> None:
        node = self.leaves + capacity
        while node:
            self.tree[node] += step
            node >>= 1


def best_fit(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """Window and offset of each piece; the pieces come longest first."""
    open_windows, placed, used = OpenWindows(window), [], 0
    for length in lengths:
        found = open_windows.take(length)
        if found is None:
            found, used = (window, used), used + 1
        left, number = found
        placed.append((number, window - left))
        if left > length:
            open_windows.put(left - length, number)
    return placed


def packed(
    docs: DataFrame,
    window: int = WINDOW,
    vocabulary: str = VOCABULARY,
    windows_per_bin: int = WINDOWS_PER_BIN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    pieces = texts_of(docs, id_col, text_col).mapInArrow(_pieces(vocabulary, window), PIECE)
    pieces = stored(pieces.withColumn("task", F.spark_partition_id()), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    bins = -(-total // (window * windows_per_bin)) or 1
    pieces = pieces.withColumn("bin", F.pmod(F.xxhash64("task", "number"), F.lit(bins)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "task", "number"], ascending=[False, True, True])
        placed = best_fit(rows["length"].tolist(), window)
        rows["local"], rows["offset"] = [p[0] for p in placed], [p[1] for p in placed]
        return rows

    placed = stored(
        pieces.groupBy("bin").applyInPandas(pack, schema=f"{PIECE}, task int, bin bigint, local bigint, offset bigint"),
        "packed",
    )
    sizes = placed.groupBy("bin").agg((F.max("local") + 1).alias("windows"))
    # one row per bin; bins grow with the input, so they are summed up in groups first
    grouped = sizes.withColumn("range", F.floor(F.col("bin") / 1_000))
    within = Window.partitionBy("range").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = grouped.groupBy("range").agg(F.sum("windows").alias("all"))
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("base"))
    starts = grouped.withColumn("first", F.coalesce(F.sum("windows").over(within), F.lit(0)))
    starts = starts.join(totals, "range").select("bin", (F.col("base") + F.col("first")).alias("first"))
    return placed.join(starts, "bin").select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.col("local")).alias("sequence_id"),
        "offset",
    )
