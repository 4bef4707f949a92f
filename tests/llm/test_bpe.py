"""Byte-level BPE against the library, the perfect hash against a dictionary."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest_llm import by_id

from tamarind.llm import bpe

PLACE = public_tokenizers.path(bpe.VOCABULARY)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PLACE, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return bpe.Ranks(bpe.VOCABULARY)


def plain(text):
    return LIBRARY.encode_ordinary(text or "")


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_hash_is_minimal_perfect():
    for n in (0, 1, 2, 3, 50, 4_000):
        keys = [b"%d:%d" % (i, i * i) for i in range(n)]
        found = bpe.PerfectHash(keys)
        assert len(found.key_at) == max(n, 1) and sorted(k for k in found.key_at if k >= 0) == list(range(n))
        assert found.find([*keys, b"none", b""]).tolist() == [*range(n), -1, -1]
        one = found.plain(list(range(n)))
        assert [one(k) for k in (*keys, b"none", b"")] == [*range(n), -1, -1]
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"])


def test_every_token_is_found_at_once(table):
    tokens = list(RANKS)
    assert table.rank_at[table.hash.find(tokens)].tolist() == [RANKS[t] for t in tokens]
    assert [table.rank_of(t) for t in tokens[::97]] == [RANKS[t] for t in tokens[::97]]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab 1\n\t\x1c\x85\xa0　.!'séß中\U0001f469‍￿", max_size=60))
def test_like_the_library(text):
    table = bpe.ranks(bpe.VOCABULARY, None)
    found = table.encode([text])[0]
    assert ids(found) == plain(text)
    assert table.decode(found) == text.encode()


def test_every_character(table):
    """In front of, between and behind letters, digits and marks."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    chars = chars[:0x3000] + [c for c in chars[0x3000:] if ord(c) % 61 == 0 or table.is_newer[ord(c)]]
    for start in range(0, len(chars), 500):
        text = "".join(f"a{c}a 1{c}1 !{c}! {c} \n{c}" for c in chars[start : start + 500])
        assert ids(table.encode([text])[0]) == plain(text), hex(ord(chars[start]))


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=24))
def test_heap_takes_lowest_rank_leftmost(piece):
    rank = {bytes([b]): b for b in range(256)}
    draw = random.Random(len(piece) * 256 + piece[0])
    pairs = {piece[i:j] for i in range(len(piece)) for j in range(i + 2, len(piece) + 1) if draw.random() < 0.4}
    rank |= {p: 256 + draw.randrange(10_000) * 1_000 + k for k, p in enumerate(sorted(pairs))}
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        best = min(((rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    single = [rank[bytes([b])] for b in range(256)]
    double = [rank.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
    assert bpe.merged(piece, lambda p: rank.get(p, -1), single, double) == [rank[p] for p in parts]


def test_blocks_change_no_id(table):
    draw = random.Random(3)
    text = "".join(draw.choice(["ab", " ", "  ", "\n", "\t ", "don't", "é", "12", "...", " x"]) for _ in range(4_000))
    parts = list(bpe.blocks(text, 50))
    assert len(parts) > 50 and "".join(parts) == text
    assert [i for p in parts for i in ids(table.encode([p])[0])] == plain(text)
    assert list(bpe.blocks("")) == [""] and list(bpe.blocks("x" * 300, 100)) == ["x" * 300]


def test_small_memory_changes_nothing():
    texts = ["unfamiliarword otherwordie unfamiliarword", "otherwordie zzyzzx", None, ""]
    small = bpe.Ranks(bpe.VOCABULARY, limit=1)
    assert [ids(x) for x in small.encode(texts * 2)] == [plain(t) for t in texts * 2]
    assert len(small.known) == 1


def test_round_trip_on_odd_rows(odd, empty):
    rows = bpe.round_trip(odd).collect()
    assert len(rows) == odd.count()
    for row, text in by_id(rows, odd):
        want = plain(text)
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(np.asarray(want, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(empty).collect() == []


def test_real_ids_and_other_names(spark, odd):
    renamed = odd.select("doc_id", "text").toDF("key", "body")
    found = bpe.encoded(renamed, id_col="key", text_col="body")
    for row, text in by_id(found.collect(), odd):
        assert ids(row.ids) == plain(text)
    back = bpe.decoded(found.selectExpr("doc_id", "n_tokens", "if(doc_id = 2, null, ids) as ids"))
    for row, text in by_id(back.collect(), odd):
        assert bytes(row.decoded) == (text or "").encode()
