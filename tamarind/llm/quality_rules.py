"""Quality rules by compression bands.

Every whole text is compressed with zstandard, once as a whole and once in fixed chunks.
A ratio (bytes / compressed bytes) above the band of the text's length means repetition,
one below it means noise. Bands rise with length, because a longer text lets the
compressor find more that recurs.

The limits of ``Bands`` are outer ones, for prose in Latin letters: random base64 lies
below them at every length, random hex digits from 2 KB on. Unless bands are given, each
length class is narrowed to the ratios of the documents themselves, ``FENCE`` times the
distance of their quartiles beyond the quartiles, from one count over all documents that
pass the base rules. Classes with under ``LEAST_TEXTS`` of them keep the outer limits.

Null text: all counts 0, no ratio, not kept. Empty or short text (under ``MIN_WORDS``
words): fails the base rules. One row per input row; repeated rows give repeated results.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace
from itertools import accumulate

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import named, rows_where, texts_of, with_text_columns

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FENCE = 2.5
LEAST_TEXTS = 50
# Ratios are counted in steps of this size, up to a largest one.
STEP = 0.005
MAX_RATIO = 20
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Bands:
    """``limits``: (from this many bytes on, lowest ratio, highest ratio), ascending."""

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 1.25, 2.3),
        (500, 1.36, 2.4),
        (707, 1.5, 2.5),
        (1_000, 1.64, 2.6),
        (1_414, 1.77, 2.6),
        (2_000, 1.9, 2.7),
        (2_828, 1.92, 2.8),
        (4_000, 1.95, 2.9),
        (5_657, 1.95, 2.9),
        (8_000, 2.0, 3.0),
        (11_314, 2.0, 3.0),
        (16_000, 2.05, 3.2),
        (32_000, 2.05, 3.2),
        (64_000, 2.05, 3.4),
        (256_000, 2.05, 3.5),
        (4_000_000, 2.05, 3.6),
    )
    chunk_bytes: int = 4_096
    # share of a text's chunks that may lie outside the chunk band
    chunk_share: float = 0.3
    level: int = 3

    def at(self, size: int) -> int:
        return bisect_right([b for b, _, _ in self.limits], size) - 1

    def of(self, size: int) -> tuple[float, float]:
        return self.limits[self.at(size)][1:]


FIELDS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "base_failed": "boolean",
    "kept": "boolean",
    "ratio": "double",
    "chunk_low": "double",
    "chunk_high": "double",
    "bad_chunks": "bigint",
    "n_chunks": "bigint",
}


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def chunks_of(raw: bytes, size: int) -> list[bytes]:
    """Fixed chunks; a rest of under half a chunk stays with the chunk before it."""
    cuts = list(range(0, len(raw), size))
    if len(cuts) > 1 and len(raw) - cuts[-1] < size // 2:
        cuts.pop()
    return [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)])]


def base_failed(words: list[bytes], repeats: int) -> bool:
    return len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)


def measurer(bands: Bands) -> Callable[[], Callable[[list], list[list]]]:
    def make():
        squeeze = zstandard.ZstdCompressor(level=bands.level).compress

        def ratio(raw: bytes) -> float:
            return len(raw) / len(squeeze(raw))

        def outside(raw: bytes, value: float) -> bool:
            low, high = bands.of(len(raw))
            return not low <= value <= high

        def one(text: str | None) -> tuple:
            text = text or ""
            raw = text.encode()
            words = raw.split()  # bytes split at ASCII white space only
            repeats = repeated_words(words)
            failed = base_failed(words, repeats)
            whole = ratio(raw) if raw else None
            parts = [(ratio(c), c) for c in chunks_of(raw, bands.chunk_bytes)]
            bad = sum(outside(c, r) for r, c in parts)
            kept = not failed and not outside(raw, whole) and bad <= bands.chunk_share * len(parts)
            return (
                len(words),
                len(text) - sum(map(text.count, WHITE)),
                sum(map(text.count, SYMBOLS)),
                repeated_lines(raw),
                repeats,
                failed,
                kept,
                whole,
                min((r for r, _ in parts), default=None),
                max((r for r, _ in parts), default=None),
                bad,
                len(parts),
            )

        return lambda texts: list(map(list, zip(*map(one, texts)))) if texts else [[] for _ in FIELDS]

    return make


def narrowed(bands: Bands, counts: dict[tuple[int, int], int]) -> Bands:
    """The bands inside the fences of counted ratios; keys: length class, step of ratio."""
    limits = list(bands.limits)
    for at in {at for at, _ in counts}:
        steps = sorted((step, n) for (a, step), n in counts.items() if a == at)
        total = sum(n for _, n in steps)
        if total < LEAST_TEXTS:
            continue
        upto = list(accumulate(n for _, n in steps))
        first, third = (STEP * steps[bisect_left(upto, share * total)][0] for share in (0.25, 0.75))
        margin = FENCE * (third - first + STEP)
        start, low, high = limits[at]
        limits[at] = (start, max(low, first - margin), min(high, third + STEP + margin))
    return replace(bands, limits=tuple(limits))


def fitted(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> Bands:
    """The bands narrowed to the ratios of all documents that pass the base rules."""

    def make():
        squeeze = zstandard.ZstdCompressor(level=bands.level).compress

        def place(text: str | None) -> tuple:
            raw = (text or "").encode()
            words = raw.split()
            if base_failed(words, repeated_words(words)):
                return None, None
            return bands.at(len(raw)), int(min(len(raw) / len(squeeze(raw)), MAX_RATIO) / STEP)

        return lambda texts: list(map(list, zip(*map(place, texts)))) if texts else [[], []]

    texts = docs.select(named(docs, text_col).alias("text"))
    places = with_text_columns(texts, {"at": "int", "step": "int"}, make).where("at IS NOT NULL")
    # at most MAX_RATIO / STEP rows a class
    counts = places.groupBy("at", "step").agg(F.count("*").alias("n")).collect()
    return narrowed(bands, {(r["at"], r["step"]): r["n"] for r in counts})


def measured(docs: DataFrame, bands: Bands | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, ratios and the verdict."""
    docs = texts_of(docs, id_col, text_col)
    return with_text_columns(docs, FIELDS, measurer(bands or fitted(docs)))


def keep_good(docs: DataFrame, bands: Bands | None = None, text_col: str = "text") -> DataFrame:
    """The documents that pass, all columns unchanged."""
    at = list(FIELDS).index("kept")
    bands = bands or fitted(docs, text_col=text_col)

    def keep():
        measure = measurer(bands)()
        return lambda texts: measure(texts)[at]

    return rows_where(docs, keep, text_col)
