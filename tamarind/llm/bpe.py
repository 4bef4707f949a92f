"""Byte-level BPE with two tiers of lookup, and its inverse.

A text is cut into pre-tokens by a pattern. First tier: a minimal perfect hash over the
vocabulary (hash, displace; one slot per token and none empty) finds the pre-tokens that
are tokens already, all different ones of a block at once. Second tier: each other
pre-token becomes a linked list of bytes, and a heap gives the adjacent pair of lowest
rank, leftmost first, until no pair is a token; ranks of pairs come from the same hash.

Texts are worked on in blocks that end where a white space follows another character:
no match of the pattern reaches over such a place, so blocks bound the memory of very
long texts and change no id. The ids of resolved pre-tokens are remembered from block to
block, up to a bounded number; those beyond it are resolved again.

Null counts as empty, and an empty text has no ids. One row per input row, also for
repeated rows and null ids; other columns are ignored. An empty table gives no rows.
Decoding gives back the very bytes; a null list of ids is decoded as no bytes.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections import ChainMap
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import texts_of, with_text_columns
from tamarind.llm.tokens import place_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK = 1 << 20
REMEMBERED = 700_000

# Letters and numbers that Unicode got after version 16.0, the version of
# the library whose results are matched. There they are neither letters nor numbers.
NEWER_LETTERS = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    "\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5"
    "\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    "\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
NEWER_NUMBERS = "\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"

BORDER = regex.compile(r"(?<=\S)(?=\s)")


def public_pattern() -> str:
    """The pre-token pattern that belongs to the public rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


class PerfectHash:
    """Minimal perfect hash of the keys 0..n-1: place of a key in its list, or -1.

    Keys fall into buckets by one part of their hash. The largest bucket goes first and
    tries displacements until all its keys have free slots; buckets of one key take the
    free slots that are left directly. A slot keeps its key's number and the key itself
    is compared, so that no foreign key is ever found.
    """

    PER_BUCKET = 3
    TRIES = 256  # at once
    FILTER_BITS = 20
    STEP, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

    def __init__(self, keys: list[bytes]):
        self.keys, self.size = keys, max(len(keys), 1)
        self.buckets = -(-self.size // self.PER_BUCKET)
        for self.seed in range(100):
            hashes = self._hashes(keys)
            if len(np.unique(hashes)) == len(keys) and self._place(hashes):
                return
        raise ValueError("the keys are not distinct")

    def _hashes(self, keys: list[bytes]) -> np.ndarray:
        seed = self.seed
        return np.fromiter((xxhash.xxh3_64_intdigest(k, seed) for k in keys), np.uint64, len(keys))

    def _slots(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Slots of hashes under displacements, each of which mixes the hash anew."""
        with np.errstate(over="ignore"):
            mixed = (hashes ^ (shift.astype(np.uint64) * np.uint64(self.STEP))) * np.uint64(self.MIX)
        return ((mixed >> np.uint64(32)) % np.uint64(self.size)).astype(np.int64)

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) % np.uint64(self.buckets)).astype(np.int64)

    def _place(self, hashes: np.ndarray) -> bool:
        bucket = self._bucket(hashes)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        starts = np.concatenate([[0], np.cumsum(counts)])
        self.shift = np.zeros(self.buckets, np.int64)
        self.key_at = np.full(self.size, -1, np.int64)
        free = np.ones(self.size, bool)
        for b in np.argsort(-counts, kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if len(members) < 2:
                break
            for first in range(0, 256 * self.TRIES, self.TRIES):
                tries = np.arange(first, first + self.TRIES)
                slots = self._slots(hashes[members][None, :], tries[:, None])
                good = free[slots].all(axis=1)
                ranked = np.sort(slots, axis=1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if good.any():
                    at = int(np.argmax(good))
                    self.shift[b], free[slots[at]], self.key_at[slots[at]] = tries[at], False, members
                    break
            else:
                return False
        single = np.flatnonzero(counts == 1)
        left = np.flatnonzero(free)[: len(single)]
        self.shift[single], self.key_at[left] = -1 - left, order[starts[single]]
        return True

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Numbers of the keys, -1 for those that are none."""
        hashes = self._hashes(keys)
        shift = self.shift[self._bucket(hashes)]
        number = self.key_at[np.where(shift < 0, -1 - shift, self._slots(hashes, np.maximum(shift, 0)))]
        own = self.keys
        same = np.fromiter((n >= 0 and own[n] == k for n, k in zip(number.tolist(), keys)), bool, len(keys))
        return np.where(same, number, -1)

    def plain(self, values: list[int]) -> Callable[[bytes], int]:
        """Value of one key at a time, -1 for what is no key. A bit table answers for
        most of those before a slot is computed."""
        shifts, seed, buckets, size, longest = self.shift.tolist(), self.seed, self.buckets, self.size, 0
        slot_key: list[bytes | None] = [None] * size
        slot_value = [-1] * size
        maybe = bytearray(1 << self.FILTER_BITS)
        step, mix, low, part = self.STEP, self.MIX, (1 << 64) - 1, (1 << self.FILTER_BITS) - 1
        hashed = xxhash.xxh3_64_intdigest
        for slot, number in enumerate(self.key_at.tolist()):
            if number >= 0:
                key = self.keys[number]
                slot_key[slot], slot_value[slot], longest = key, values[number], max(longest, len(key))
                maybe[hashed(key, seed) & part] = 1

        def one(key: bytes) -> int:
            h = hashed(key, seed)
            if not maybe[h & part] or len(key) > longest:
                return -1
            shift = shifts[(h ^ (h >> 29)) % buckets]
            slot = -1 - shift if shift < 0 else (((h ^ (shift * step & low)) * mix & low) >> 32) % size
            return slot_value[slot] if slot_key[slot] == key else -1

        return one


def merged(piece: bytes, rank_of: Callable[[bytes], int], byte_rank: list[int], pair_rank: list[int]) -> list[int]:
    """Ranks of a piece after all merges: lowest rank first, leftmost among equal ones.

    The bytes form a linked list by start (``end``, ``before``). The heap holds rank and
    start of a pair in one number; an entry counts only while ``offered`` still has that
    rank at that start. The two tables answer for single bytes and pairs of them.
    """
    size = len(piece)
    end, before = list(range(1, size + 1)), list(range(-1, size - 1))
    rank = [byte_rank[b] for b in piece]
    offered = [pair_rank[a << 8 | b] for a, b in zip(piece, piece[1:])]
    heap = [r * size + i for i, r in enumerate(offered) if r >= 0]
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    while heap:
        best, left = divmod(pop(heap), size)
        if offered[left] != best:
            continue
        middle = end[left]
        stop = end[middle]
        rank[left], end[left], rank[middle], offered[left] = best, stop, -1, -1
        if middle < size - 1:
            offered[middle] = -1
        if stop < size:
            before[stop] = left
            offered[left] = r = rank_of(piece[left : end[stop]])
            if r >= 0:
                push(heap, r * size + left)
        if left:
            at = before[left]
            offered[at] = r = rank_of(piece[at:stop])
            if r >= 0:
                push(heap, r * size + at)
    return [r for r in rank if r >= 0]


class Ranks:
    """A rank file with its pattern: encoder and decoder."""

    def __init__(self, vocabulary: str, pattern: str | None = None, limit: int = REMEMBERED):
        place = vocabulary if os.path.sep in vocabulary else place_of(vocabulary)
        with open(place, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.tokens = [base64.b64decode(token) for token, _ in pairs]
        ranks = [int(rank) for _, rank in pairs]
        self.by_rank = dict(zip(ranks, self.tokens))
        self.hash = PerfectHash(self.tokens)
        self.rank_at = np.asarray([*ranks, -1], np.int64)  # the last entry answers for -1
        self.rank_of = self.hash.plain(ranks)
        self.byte_rank = [self.rank_of(bytes((b,))) for b in range(256)]
        if -1 in self.byte_rank:
            raise ValueError(f"{vocabulary} lacks a single byte")
        self.pair_rank = [self.rank_of(bytes((a, b))) for a in range(256) for b in range(256)]
        self.packed = {r: int(r).to_bytes(4, "little") for r in ranks}
        pattern = pattern or public_pattern()
        self.cut = regex.compile(pattern).findall
        known = pattern.replace(r"\p{L}", rf"[\p{{L}}--[{NEWER_LETTERS}]]")
        self.cut_newer = regex.compile(known.replace(r"\p{N}", rf"[\p{{N}}--[{NEWER_NUMBERS}]]"), regex.V1).findall
        self.is_newer = np.zeros(0x110000, bool)
        for char in regex.findall(f"[{NEWER_LETTERS}{NEWER_NUMBERS}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))):
            self.is_newer[ord(char)] = True
        self.limit, self.known = limit, {}

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or not self.is_newer[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.cut(text)
        return self.cut_newer(text)

    def _resolve(self, pieces: list[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of different pre-tokens: the hash for all at once, the
        heap for each of the others."""
        packed, raw = self.packed, [p.encode() for p in pieces]
        found = self.rank_at[self.hash.find(raw)]
        ids = {p: packed[r] for p, r in zip(pieces, found.tolist()) if r >= 0}
        for i in np.flatnonzero(found < 0).tolist():
            ranks_of = merged(raw[i], self.rank_of, self.byte_rank, self.pair_rank)
            ids[pieces[i]] = b"".join([packed[r] for r in ranks_of])
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. Short texts share a block, long ones are cut into blocks."""
        out: list[list[bytes]] = [[] for _ in texts]
        block: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            known = self.known
            ids = self._resolve([*set().union(*(pieces for _, pieces in block)).difference(known)])
            known.update(islice(ids.items(), max(self.limit - len(known), 0)))
            look_up = (known if len(known) < self.limit else ChainMap(ids, known)).__getitem__
            for at, pieces in block:
                out[at].append(b"".join(map(look_up, pieces)))
            block.clear()

        for at, text in enumerate(texts):
            for part in blocks(text or ""):
                block.append((at, self.pre_tokens(part)))
                held += len(part)
                if held >= BLOCK:
                    flush()
                    held = 0
        flush()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes | None) -> bytes:
        """The bytes of little-endian 32-bit ids; an id outside the vocabulary is an error."""
        return b"".join(map(self.by_rank.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text in parts of at least ``size`` characters, cut before a white space that
    follows another character."""
    start = 0
    while len(text) - start > size and (border := BORDER.search(text, start + size)):
        yield text[start : border.start()]
        start = border.start()
    yield text[start:] if start else text


@lru_cache(maxsize=4)
def ranks(vocabulary: str, pattern: str | None) -> Ranks:
    """One rank table with its hash per Python worker, kept from task to task."""
    return Ranks(vocabulary, pattern)


def _encoder(vocabulary: str, pattern: str | None):
    def maker():
        encode = ranks(vocabulary, pattern).encode

        def columns(texts: list) -> list[list]:
            ids = encode(texts)
            return [[len(i) // 4 for i in ids], ids]

        return columns

    return maker


def encoded(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens and the ids as little-endian 32-bit integers, one row per row."""
    fields = {"n_tokens": "bigint", "ids": "binary"}
    return with_text_columns(texts_of(docs, id_col, text_col), fields, _encoder(vocabulary, pattern))


def decoded(rows: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids in place of the ids."""

    def maker():
        decode = ranks(vocabulary, None).decode
        return lambda ids: [[decode(i) for i in ids]]

    return with_text_columns(rows, {name: "binary"}, maker, text=ids_col)


def digest(data: str) -> Column:
    return F.sha2(F.col(data), 256)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of every text's ids and of what they decode to."""
    ids = encoded(docs, vocabulary, None, id_col, text_col)
    back = decoded(ids.select("doc_id", "n_tokens", digest("ids").alias("ids_sha256"), "ids"), vocabulary)
    return back.select("doc_id", "n_tokens", "ids_sha256", digest("decoded").alias("decoded_sha256"))
