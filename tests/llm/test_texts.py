"""Quality rules and license scan against brute force."""

import base64
import random
import re
from collections import Counter

import pytest
import zstandard
from llm.conftest_llm import by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarind.llm import licenses, quality_rules


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    earlier, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in earlier
            earlier.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), failed)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x85 é#<", max_size=120))
def test_base_counts(text):
    found = quality_rules.measurer(quality_rules.Bands())()([text])
    assert tuple(column[0] for column in found)[:6] == brute_base(text)


def test_rules_on_odd_rows(odd, empty):
    rows = quality_rules.measured(odd).collect()
    assert len(rows) == odd.count()
    for row in by_id(rows, odd):
        assert tuple(row[0][c] for c in BASE) == brute_base(row[1])
    assert quality_rules.measured(empty).collect() == []
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_bands_split_repetition_noise_and_prose(frame):
    import random

    draw = random.Random(5)
    syllables = ["the", "an", "er", "tion", "ing", "or", "st", "re", "ou", "nd", "ly", "en"]
    prose = " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(900))
    noise = " ".join("".join(chr(draw.randint(0x4E00, 0x9FA0)) for _ in range(30)) for _ in range(200))
    phrases = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(12)]
    loop = " ".join(draw.choice(phrases) for _ in range(900))
    verdict = {r.doc_id: r.kept for r in quality_rules.measured(frame([(1, prose), (2, loop), (3, noise)])).collect()}
    assert verdict[1] and not verdict[2]
    raw = loop.encode()
    ratio = len(raw) / len(zstandard.ZstdCompressor(level=3).compress(raw))
    assert ratio > quality_rules.Bands().of(len(raw))[1]
    tight = quality_rules.Bands(limits=((0, 2.0, 50.0),))
    assert not quality_rules.measured(frame([(3, noise)]), tight).first().kept


def in_words(letters):
    return " ".join(letters[i : i + 8] for i in range(0, len(letters), 8))


def echoing(draw, n):
    """Long lines that recur once with every third word changed: most 3-word windows are
    unique, the bytes repeat."""
    words = ["".join(draw.choices("abcdefghijklmnop", k=9)) for _ in range(n)]
    return " ".join(w if i % 3 else "".join(draw.choices("qrst", k=3)) for _ in range(4) for i, w in enumerate(words))


def test_default_bands_reject_noise_and_repetition(frame):
    draw = random.Random(6)
    rows = []
    for size in (1_000, 3_000, 20_000, 100_000):
        rows.append((len(rows), in_words(base64.b64encode(draw.randbytes(size)).decode())))
    for size in (2_000, 3_000, 20_000, 100_000):
        rows.append((len(rows), in_words(draw.randbytes(size).hex())))
    for size in (60, 200, 2_000):
        rows.append((len(rows), echoing(draw, size)))
    for found in (quality_rules.measured(frame(rows)), quality_rules.measured(frame(rows), quality_rules.Bands())):
        found = found.collect()
        assert len(found) == len(rows) and not any(r.base_failed or r.kept for r in found)
    assert quality_rules.keep_good(frame(rows)).collect() == []


def test_bands_follow_the_documents(frame):
    """Symbols behind every word, inside the outer limits: far from the other documents."""
    draw = random.Random(7)
    syllables = "an er the tion ou re st nd ing ly or ha es il um ak po vi du ge".split()

    def prose(n, mark=str):
        return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) + mark() for _ in range(n))

    rows = [(i, prose(420)) for i in range(300)]
    rows += [(300 + i, prose(280, lambda: draw.choice(["%%%", "$$$"]))) for i in range(20)]
    alone = quality_rules.measured(frame(rows), quality_rules.Bands()).collect()
    assert all(r.kept for r in alone)
    kept = {r.doc_id for r in quality_rules.measured(frame(rows)).collect() if r.kept}
    assert kept == set(range(300)) == {r.doc_id for r in quality_rules.keep_good(frame(rows)).collect()}


def test_chunks_cover_the_text():
    for size in (0, 1, 4095, 4096, 4097, 6143, 6144, 20_000):
        raw = bytes(size)
        parts = quality_rules.chunks_of(raw, 4096)
        assert b"".join(parts) == raw and all(2048 <= len(p) < 6144 for p in parts[:-1])


def brute_places(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(labels))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["MIT", "license", "License.", "apache", "general", "public", "x", "é", "\n", "mit-", "-license"])))
def test_places(parts):
    text = " ".join(parts)
    found = [column[0] for column in licenses.scanner()([text])]
    assert tuple(found[:5]) == brute_places(text)
    assert set(filter(None, found[4].split(","))) <= set(found[5].split(","))
    assert 0 <= found[6] <= 1


def test_scan_on_odd_rows(odd, empty):
    rows = licenses.scanned(odd).collect()
    assert len(rows) == odd.count()
    for row, text in by_id(rows, odd):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute_places(text)
    assert licenses.scanned(empty).collect() == []


@pytest.mark.parametrize(
    ("expression", "labels", "freedom"),
    [
        ("MIT", {"mit"}, 1.0),
        ("MIT OR GPL-2.0-only", {"mit", "gpl"}, 1.0),
        ("MIT AND GPL-2.0-only", {"mit", "gpl"}, 0.3),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, 0.5),
        ("MIT AND (GPL-3.0+ OR Apache-2.0)", {"mit", "gpl", "apache"}, 1.0),
        ("MIT AND GPL-3.0+ OR Proprietary", {"mit", "gpl", "all rights reserved"}, 0.3),
        ("CC-BY-NC-4.0", {"cc by-nc"}, 0.4),
    ],
)
def test_expressions(expression, labels, freedom):
    found, free = licenses.evaluated(licenses.postfix(expression))
    assert found == labels and free == pytest.approx(freedom)


@pytest.mark.parametrize("expression", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT (Apache-2.0)", "()"])
def test_malformed_expressions(expression):
    assert licenses.postfix(expression) is None


def test_tags_add_labels(frame):
    text = "# SPDX-License-Identifier: (MIT OR Apache-2.0)\nSpdx-License-Identifier: oops OR\nThe MIT License."
    row = licenses.scanned(frame([(1, text)])).first()
    assert (row.base_labels, row.labels, row.n_base, row.n_tags) == ("mit", "apache,mit", 1, 1)
    assert row.score > 0.9


def test_a_phrase_inside_a_longer_one_gives_no_label(frame):
    texts = ["Licensed under CC BY-NC 4.0", "licensed under cc by, all", "lesser general public license", "cc by nc"]
    rows = {r.doc_id: r for r in licenses.scanned(frame(list(enumerate(texts)))).collect()}
    assert [rows[i].labels for i in range(4)] == ["cc by-nc", "cc by", "gpl,lgpl", ""]
    assert rows[2].base_labels == "gpl" and rows[2].n_base == 1
    assert rows[0].score == rows[1].score
