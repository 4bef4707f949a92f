"""Shards, packing and token counts against plain versions."""

import zlib
from collections import defaultdict

import numpy as np
from llm.conftest_llm import by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarind.llm import packing, sharding, token_counts
from tamarind.llm.tokens import tokenizer


def plain_jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1), st.integers(1, 50))
def test_jump(keys, shards):
    found = sharding.jump(np.array(keys), shards).tolist()
    assert found == [plain_jump(k, shards) for k in keys]
    grown = sharding.jump(np.array(keys), shards + 1).tolist()
    assert all(b in (a, shards) for a, b in zip(found, grown))


def test_jump_moves_only_its_share():
    keys = np.arange(90_000)
    assert abs((sharding.jump(keys, 8) != sharding.jump(keys, 9)).mean() - 1 / 9) < 0.01
    assert np.bincount(sharding.jump(keys, 9)).min() > 9_500


def test_shards_on_odd_rows(odd, empty, spark):
    rows = sharding.sharded(odd).collect()
    slots = defaultdict(list)
    for row, text in by_id(rows, odd):
        raw = (text or "").encode()
        assert (row["size"], row.text_crc32, row.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (row.shard, row.grown_shard) == (plain_jump(row.doc_id or 0, 8), plain_jump(row.doc_id or 0, 9))
        slots[row.shard].append(row.slot)
    assert len(rows) == odd.count()
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(empty).collect() == []


def test_slots_have_no_gaps_over_many_partitions(frame):
    rows = sharding.sharded(frame([(i % 700, "x") for i in range(3_000)]).repartition(13)).collect()
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert len(slots) == 8 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def whole(vocabulary, text):
    return tokenizer(vocabulary).encode(text or "", add_special_tokens=False).ids


HARD = st.text(alphabet="aB .,!é́ \n\t\r\x0b\x1c\x85\xa0  　's3,.#<|endoftext>Σς👩‍​", max_size=60)


@settings(max_examples=400, deadline=None)
@given(HARD)
def test_cuts_do_not_change_counts(text):
    assert "".join(token_counts.cuts_of(text)) == text
    counts = token_counts.counter(token_counts.lengths(token_counts.VOCABULARY))([text, None, "", text])
    assert counts[1] == [len(whole(token_counts.VOCABULARY, t)) for t in (text, "", "", text)]


@settings(max_examples=400, deadline=None)
@given(HARD)
def test_words_do_not_change_ids(text):
    ids = packing.encoder(packing.word_ids(packing.VOCABULARY))(text)
    assert np.frombuffer(ids, "<u4").tolist() == [*whole(packing.VOCABULARY, text), packing.END]


def test_forgetting_changes_nothing():
    texts = [f"word{i} other{i % 7}, Xyz{i % 9}.  x{i * i}" for i in range(200)]
    few, many = (token_counts.counter(token_counts.Lengths(token_counts.VOCABULARY, n)) for n in (5, 9_999))
    for at in range(0, 200, 20):
        assert few(texts[at : at + 20]) == many(texts[at : at + 20])
    few, many = (packing.encoder(packing.WordIds(packing.VOCABULARY, n)) for n in (5, 9_999))
    assert list(map(few, texts)) == list(map(many, texts))


def test_batches_are_balanced():
    pieces = ["x" * 10] * 50 + ["y" * 500] + ["é"] * 9
    batches = list(token_counts.balanced(pieces, 100))
    assert [p for b in batches for p in b] == pieces
    assert all(len(b) == 1 or sum(len(p.encode()) for p in b) <= 100 for b in batches)


def test_counts_on_odd_rows(odd, empty):
    rows = token_counts.counted(odd).collect()
    assert len(rows) == odd.count()
    for row, text in by_id(rows, odd):
        n = len(whole(token_counts.VOCABULARY, text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), n, n > 1_024)
    assert token_counts.counted(empty).collect() == []


def plain_best_fit(lengths, window):
    left, placed = [], []
    for length in lengths:
        fits = [(c, i) for i, c in enumerate(left) if c >= length]
        if fits:
            at = min(fits)[1]
        else:
            at = len(left)
            left.append(window)
        placed.append((length, left[at] - length))
        left[at] -= length
    return sorted(left), sorted(placed)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 37), max_size=80))
def test_best_fit(lengths):
    lengths = sorted(lengths, reverse=True)
    placed = packing.best_fit(lengths, 37)
    left = defaultdict(lambda: 37)
    trail = []
    for length, (window, offset) in zip(lengths, placed):
        assert offset == 37 - left[window] and left[window] >= length
        trail.append((length, left[window] - length))
        left[window] -= length
    assert (sorted(left.values()), sorted(trail)) == plain_best_fit(lengths, 37)


def check_packing(rows, texts, window=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    assert set(pieces) == set(texts)
    for doc, parts in pieces.items():
        text, copies = texts[doc]
        ids = np.array([*whole(packing.VOCABULARY, text), packing.END], dtype="<u4")
        starts = sorted(p.start for p in parts)
        assert starts == sorted(list(range(0, len(ids), window)) * copies)
        for p in parts:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())


def test_packing_on_odd_rows(odd, empty):
    texts = {}
    for r in odd.select("doc_id", "text").collect():
        texts[r.doc_id] = (r.text, texts.get(r.doc_id, (None, 0))[1] + 1)
    check_packing(packing.packed(odd).collect(), texts)
    check_packing(packing.packed(odd, windows_per_bin=2).collect(), texts)
    assert packing.packed(empty).collect() == []


def test_packing_is_close(frame):
    rows = packing.packed(frame([(i, "some words here " * (i % 90)) for i in range(2_000)])).collect()
    check_packing(rows, {i: ("some words here " * (i % 90), 1) for i in range(2_000)})
    windows, tokens = max(r.sequence_id for r in rows) + 1, sum(r.length for r in rows)
    assert tokens / (windows * 2048) > 0.98


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1.'\t\r\n \x0b\x0c\x1c\x85\xa0\u200b\u3000é", max_size=60))
def test_cuts_beside_any_white_space(text):
    cuts = token_counts.cuts_of(text)
    assert "".join(cuts) == text
    encode = tokenizer(token_counts.VOCABULARY).encode
    assert sum(len(encode(c, add_special_tokens=False).ids) for c in cuts) == len(encode(text, add_special_tokens=False).ids)


def test_one_tab_does_not_keep_a_text_whole():
    text = "word " * 1_000 + "\t" + "word\r\n" * 1_000 + "\xa0" + "word\t" * 1_000
    assert len(token_counts.cuts_of(text)) >= 3_000


def test_packing_with_another_vocabulary(frame):
    text = "Don't Shout  here\n\nOr THERE."
    row = packing.packed(frame([(1, text)]), vocabulary="byte_bpe_50k.json").first()
    ids = [*tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False).ids, packing.END]
    assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
