"""Near-duplicate classes against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tamarind.llm import graphs, near_dedup


def brute_sets(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if words and len(words) < 5:
            sets.append({tuple(words)})
        else:
            sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    return sets


def brute_classes(rows, percent=85):
    """(n_shingles, component_id) of every row."""
    sets = brute_sets(rows)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and root(i) != root(j):
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    label[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(doc, low.get(root(i), doc))
    return [(len(s), low.get(root(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def corpus(seed, families, size, words=120):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(900)]
    rows = []
    for family in range(families):
        base = draw.choices(vocabulary, k=words)
        for copy in range(size if family else 3 * size):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(words)] = draw.choice(vocabulary)
            if copy % 5 == 4:
                text = [w.upper() for w in text]
            rows.append(" ".join(text))
    rows += rows[::7]
    draw.shuffle(rows)
    return list(enumerate(rows))


def check(frame, rows):
    found = near_dedup.linked(frame(rows)).collect()
    assert len(found) == len(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found)
    want = Counter((d, n, c, d == c) for (d, _), (n, c) in zip(rows, brute_classes(rows)))
    assert got == want


def test_classes_equal_all_pairs(frame):
    check(frame, corpus(3, families=40, size=6))


def test_hot_cluster_in_small_blocks(frame, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    check(frame, corpus(4, families=4, size=60))


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.linked(odd).collect())
    assert got == Counter((d, n, c) for (d, _), (n, c) in zip(rows, brute_classes(rows)))
    assert near_dedup.linked(empty).collect() == []
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    # of the two equal rows with id 4 one stays; all rows without words stay
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, None, 4, 5, 6, 7, 8, 9])
    assert near_dedup.keep_one(empty).collect() == []


def test_one_of_each_class_stays(frame):
    rows = corpus(5, families=10, size=5)
    rows += [(None, rows[0][1]), (rows[1][0], rows[0][1] + " one more"), (None, "no id but words"), (None, "no id but words")]
    classes = brute_classes(rows)
    kept = [(r.doc_id, r.text) for r in near_dedup.keep_one(frame(rows)).collect()]
    ids = {c for (_, c) in classes if c is not None}
    assert Counter(d for d, _ in kept) == Counter([*ids, None])


def test_estimates_follow_similarity():
    draw = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.85, 1.0):
        near = []
        for _ in range(60):
            both = draw.integers(0, 1 << 64, int(1000 * share), dtype=np.uint64)
            rest = draw.integers(0, 1 << 64, (2, (1000 - len(both)) // 2), dtype=np.uint64)
            a, b = (near_dedup.minima_of(np.unique(np.r_[both, r])) for r in rest)
            a, b = (np.frombuffer(near_dedup.signature_of(m), np.uint64) for m in (a, b))
            near.append(near_dedup.estimates(a, b[None, :])[0])
        assert abs(np.mean(near) - share) < 0.02


def test_minima_do_not_depend_on_parts():
    shingles = np.random.default_rng(2).integers(0, 1 << 64, 1000, dtype=np.uint64)
    assert (near_dedup.minima_of(shingles) == near_dedup.minima_of(shingles, 7)).all()


def test_thresholds(frame):
    """At 80 percent the pairs between 0.80 and 0.85 are linked too."""
    draw = random.Random(12)
    rows = []
    for i in range(150):
        base = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(draw.randint(48, 62))]
        copy = [*base]
        copy[draw.randrange(10, 40)] = "changed"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    sets = brute_sets(rows)
    similar = {2 * i: len(a & b) / len(a | b) for i, (a, b) in enumerate(zip(sets[::2], sets[1::2]))}
    for percent in (80, 85):
        kept = {r.doc_id for r in near_dedup.keep_one(frame(rows), percent=percent).collect()}
        assert kept == {i for i, _ in rows if i % 2 == 0 or 100 * similar[i - 1] < percent}
    assert sum(0.80 <= x < 0.85 for x in similar.values()) > 50 and min(similar.values()) < 0.80


def test_bands_and_estimates_follow_the_threshold():
    assert near_dedup.bands_at(85) == 25 and near_dedup.least_estimate(85) == 0.70
    for percent in (70, 80, 90, 99):
        assert (1 - (percent / 100) ** near_dedup.ROWS) ** near_dedup.bands_at(percent) < near_dedup.MISS
        assert near_dedup.least_estimate(percent) < percent / 100


@pytest.mark.parametrize("at_once", [0, 40, 100_000])
@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape, at_once, monkeypatch):
    monkeypatch.setattr(graphs, "FINISHED_AT_ONCE", at_once)
    draw = random.Random(8)
    if shape == "path":
        edges = [(i, i + 1) for i in range(300)]
    elif shape == "star":
        edges = [(500, i) for i in range(400)]
    elif shape == "random":
        edges = [(draw.randrange(500), draw.randrange(500)) for _ in range(260)]
    else:
        edges = []
    found = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {}

    def root(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in edges:
        if a != b:
            label[root(a)] = root(b)
    assert set(found) == set(label)
    want = {}
    for node in found:
        want.setdefault(root(node), set()).add(found[node])
    assert all(len(v) == 1 for v in want.values())
    assert len({next(iter(v)) for v in want.values()}) == len(want)


def test_keep_one_with_columns_that_have_no_order(spark, frame):
    text = "one two three four five six seven"
    docs = frame([(1, text), (1, text), (2, text), (3, "other words that stand alone here")])
    docs = docs.selectExpr("*", "map('k', doc_id) AS m", "array(map('a', 1)) AS n", "CAST(text AS BINARY) AS b")
    kept = near_dedup.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.m["k"]) for r in kept.collect()) == [(1, 1), (3, 3)]
