"""Greedy string tiling against a plain version."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarind.llm import decontaminate


def plain_tiles(doc, item, least):
    """Marks the longest common unmarked stretch again and again."""
    used_doc, used_item, found = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while (
                    i + k < len(item) and d + k < len(doc) and doc[d + k] == item[i + k] != 0
                    and not used_doc[d + k] and not used_item[i + k]
                ):
                    k += 1
                if k > best[2]:
                    best = (d, i, k)
        d, i, k = best
        if k < max(least, 1):
            return found
        found.append(best)
        used_doc[d : d + k] = used_item[i : i + k] = [True] * k


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(1, 3), min_size=1, max_size=18), st.integers(1, 5))
def test_tiles(doc, item, least):
    found = decontaminate.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), least)
    assert found == plain_tiles(doc, item, least)


def plain_matches(docs, items, coverage=decontaminate.COVERAGE):
    out = set()
    for doc, text in docs:
        words = decontaminate.words_of(text)
        for item, passage in items:
            wanted = decontaminate.words_of(passage)
            if wanted:
                marked = sum(k for _, _, k in plain_tiles(words, wanted, min(5, len(wanted))))
                if marked >= coverage * len(wanted):
                    out.add((doc, item, marked, len(wanted)))
    return out


def corpus():
    draw = random.Random(11)
    vocabulary = ["".join(draw.choices("abcdefgh", k=3)) for _ in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(8, 30)))) for i in range(20)]
    items += [(20, "two words"), (21, "la la la la la la la la la la la la"), (22, ""), (23, None), (24, items[0][1])]
    docs = []
    for n in range(60):
        words = draw.choices(vocabulary, k=draw.randint(0, 80))
        kind = n % 6
        passage = decontaminate.words_of(items[n % 20][1])
        if kind == 1:
            words[10:10] = passage
        elif kind == 2:  # halves in the other order, apart
            half = len(passage) // 2
            words = passage[half:] + words + passage[:half]
        elif kind == 3:  # half of it only, or less
            words += passage[: draw.randint(3, len(passage))]
        elif kind == 4:
            words += ["Two", "WORDS!"] + ["la"] * (n // 4)
        docs.append((n, " ".join(words)))
    return docs + [(60, None), (61, ""), (5, docs[5][1])], items


def test_matches_equal_plain_version(frame, spark):
    docs, items = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(frame(docs), benchmark).collect()
    got = {(r.doc_id, r.item_id, r.covered_words, r.item_words) for r in found}
    assert got == plain_matches(docs, items)
    assert any(r.n_tiles > 1 for r in found)
    bad = {d for d, *_ in got}
    assert sorted({r.doc_id for r in decontaminate.contaminated(frame(docs), benchmark).collect()}) == sorted(bad)
    kept = decontaminate.keep_clean(frame(docs), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in bad)


def test_a_small_filter_changes_nothing(frame, spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 10)
    found = decontaminate.matches(frame(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.covered_words, r.item_words) for r in found} == plain_matches(docs, items)


@pytest.mark.parametrize("items", [[], [(1, None)], [(None, "no id at all, but five words")]])
def test_odd_rows(odd, empty, spark, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminated(odd, benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == ([(None, None)] if items and items[0][1] else [])
    assert decontaminate.contaminated(empty, benchmark).collect() == []
    kept = decontaminate.keep_clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - len(rows)


def test_window_hashes_are_those_of_the_polynomial():
    draw = random.Random(6)
    mask = (1 << 64) - 1
    for size in (0, 1, 7, 300):
        tokens = [draw.getrandbits(64) for _ in range(size)]
        for length in (1, 2, 5, size or 1, size + 1):
            want = []
            for i in range(size - length + 1):
                total = 0
                for token in tokens[i : i + length]:
                    total = (total * int(decontaminate._BASE) + token) & mask
                want.append((total ^ (total >> 31)) * 0xBF58476D1CE4E5B9 & mask)
            assert decontaminate.rolling(np.array(tokens, np.uint64), length).tolist() == want
