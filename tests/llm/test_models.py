"""Toxicity and site quality: held-out accuracy on planted rows, and the parts alone."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tamarind.llm import site_quality, toxicity

SYLLABLES = "an er the tion ou re st nd ing ly or ha".split()


def prose(draw, n):
    return ["".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(n)]


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def toxic_rows():
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        words, toxic = prose(draw, draw.randint(10, 120)), int(i % 6 == 0)
        if toxic:
            for _ in range(draw.randint(2, 6)):
                bad = draw.choice(["idiot", "loser", "zugrim" + draw.choice(["an", "ot", "els"]), "wexpol", "scum"])
                words.insert(draw.randrange(len(words)), bad)
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, toxic))
    return rows, labels


def test_toxic_rows_are_found(frame, spark, toxic_rows):
    rows, labels = toxic_rows
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.scored(frame(rows), labels_df).collect()
    assert len(found) == len(rows)
    wrong = Counter((r.predicted, int(r.doc_id % 6 == 0)) for r in found if is_held_out(r.doc_id))
    right = wrong[(0, 0)] + wrong[(1, 1)]
    assert right / sum(wrong.values()) > 0.97 and wrong[(1, 0)] == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == is_held_out(r.doc_id) for r in found)
    kept = {r.doc_id for r in toxicity.keep_clean(frame(rows), labels_df).collect()}
    assert kept == {r.doc_id for r in found if not r.predicted}


def test_held_out_labels_teach_nothing(frame, spark, toxic_rows):
    rows, labels = toxic_rows
    flipped = [(i, q, 1 - t) if is_held_out(i) else (i, q, t) for i, q, t in labels]
    docs = frame(rows)
    a, b = (
        toxicity.learned(toxicity.texts_of(docs), spark.createDataFrame(x, "doc_id long, quality int, toxic int"))
        for x in (labels, flipped)
    )
    assert a == b and "zugri*" in a.terms


def test_terms_come_from_all_labels(frame, spark, toxic_rows, monkeypatch):
    """However few rows the classifier is fitted on, and however many terms there are."""
    rows, labels = toxic_rows
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = toxicity.texts_of(frame(rows))
    whole = toxicity.learned(docs, labels_df)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 40)
    assert toxicity.learned(docs, labels_df) == whole

    draw = random.Random(8)
    rare = ["q" + "".join(draw.choices("bcdfgjkmvwxz", k=7)) for _ in range(2_400)]
    marked, given = [], []
    for i in range(3_000):
        words, toxic = prose(draw, 12), i < 600
        if toxic:
            words += [rare[(60 * i + k) % len(rare)] for k in range(60)]
        marked.append((i, " ".join(words)))
        given.append((i, 1, int(toxic)))
    given_df = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    lexicon = toxicity.learned(toxicity.texts_of(frame(marked)), given_df)
    assert len(set(rare) & set(lexicon.terms)) > 2_000
    # texts with one rare term only, which hardly any of 40 rows holds
    alone = [(10_000 + i, " ".join([*prose(draw, 12), word])) for i, word in enumerate(rare[:300])]
    found = toxicity.scored(frame(marked + alone), given_df).collect()
    clean = [r.predicted for r in found if 600 <= r.doc_id < 3_000]
    scores = [r.score for r in found if r.doc_id >= 10_000 and rare[r.doc_id - 10_000] in lexicon.terms]
    assert sum(clean) == 0 and min(scores) > max(r.score for r in found if 600 <= r.doc_id < 3_000)


def test_unseen_terms_get_their_voters_weight():
    terms = (*toxicity.INSULTS, "aaaa", "bbbb", "cccc", "dddd", "eee*")
    n, size = len(toxicity.INSULTS), len(toxicity.INSULTS) + 5
    weights = np.zeros(size)
    weights[[n, n + 4]] = 2.0, 3.0
    found = toxicity.with_unseen(weights, [np.array([n]), np.array([n, n + 4])], terms)
    assert found[n] == 2.0 and found[n + 4] == 3.0 and all(found[n + 1 : n + 4] > 0) and not found[:n].any()


def test_toxicity_on_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.scored(odd, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.select("doc_id").collect())
    assert toxicity.keep_clean(odd, labels.limit(0)).columns == odd.columns
    assert toxicity.scored(empty, labels).collect() == []


def test_label_model_finds_accuracies():
    draw = np.random.default_rng(3)
    truth = draw.random(20_000) < 0.2
    hit, miss = np.array([0.9, 0.7, 0.6, 0.8, 0.5]), np.array([0.05, 0.1, 0.02, 0.2, 0.5])
    fires = draw.random((20_000, 5)) < np.where(truth[:, None], hit, miss)
    fires = np.c_[fires, fires[:, 1]]  # a voter that only repeats another
    sets, at, counts = np.unique(fires, axis=0, return_inverse=True, return_counts=True)
    posterior = toxicity.label_model(sets.astype(float), counts.astype(float), 0.2)
    assert ((posterior[at.ravel()] > 0.5) == truth).mean() > 0.93


def test_quality_of_documents_and_sites(frame, spark):
    draw = random.Random(6)
    rows, labels, good_of, site = [], [], {}, {}
    for i in range(1200):
        host = i % 12
        good = draw.random() < (0.1 if host == 3 else 0.9)
        words = prose(draw, draw.randint(40, 90))
        if not good:
            words = [w + draw.choice(["%%%", "$$$"]) for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        good_of[i], site[i] = good, host
        if i % 3:
            labels.append((i, int(good), 0))
    docs = frame(rows, source=lambda i: f"host{site[i]}")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = site_quality.judged(docs, labels_df).collect()
    assert len(found) == len(rows)
    held = [r for r in found if is_held_out(r.doc_id)]
    assert sum(r.kept == good_of[r.doc_id] for r in held) / len(held) > 0.98
    shares = defaultdict(list)
    for r in found:
        shares[site[r.doc_id]].append(r.host_share)
    assert max(shares[3]) < 0.4 < 0.7 < min(min(v) for h, v in shares.items() if h != 3)


def test_sparse_sites_are_shrunk(frame, spark):
    draw = random.Random(9)
    rows = [(i, " ".join(prose(draw, 60))) for i in range(300)]
    rows += [(300 + i, " ".join(w + "%%%" for w in prose(draw, 60))) for i in range(300)]
    rows.append((600, " ".join(prose(draw, 60))))
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    docs = frame(rows, source=lambda i: "lone" if i == 600 else f"s{i % 4}")
    found = {r.doc_id: r for r in site_quality.judged(docs, labels).collect()}
    # one document, left out of its own site: the global share is all there is
    assert abs(found[600].host_share - 0.5) < 0.02 and found[600].kept


def test_site_quality_on_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        rows = site_quality.judged(odd, some).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.select("doc_id").collect())
        assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.kept for r in site_quality.judged(odd, labels.limit(0)).collect())
    assert site_quality.judged(empty, labels).collect() == []
