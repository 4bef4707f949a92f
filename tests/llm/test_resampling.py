"""Importance resampling against a plain version and SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarind.llm import catalog, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, order=1):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, order=1, buckets=10_000, least=20, percent=10):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text, order)[1]))
    for text in target:
        t.update(map(bucket, features(text, order)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    rows, eligible = [], []
    for doc, text in docs:
        words, found = features(text, order)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None])
        if words >= least:
            eligible.append(rows[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=30))
def test_crc_matrices(rows):
    rows += [b"x" * 1_024, b"y" * 1_025, b"z" * 5_000]
    assert resampling.crc_of(rows).tolist() == [zlib.crc32(r) for r in rows]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB9é{ \n/", max_size=60), st.integers(1, 4), st.integers(1, 20))
def test_features_over_blocks(text, order, size):
    blocks = list(resampling.feature_blocks(text, order, size))
    words, want = features(text, order)
    assert sum(n for n, _ in blocks) == words
    assert Counter(f.decode() for _, part in blocks for f in part) == Counter(want)


@pytest.mark.parametrize("order, buckets", [(1, 10_000), (2, 97), (3, 1_000)])
def test_on_documents(spark, frame, order, buckets):
    words = ["alpha", "Beta", "gamma's", "δέλτα", "eps1", "zeta", "eta_theta"]
    docs = [(i, " ".join(words[(i * k + k // 3) % 7] for k in range(1, 6 + i % 40))) for i in range(300)]
    docs += [(7, docs[7][1])] * 40 + [(None, docs[30][1])] * 3
    target = ["alpha beta beta gamma", "zeta " * 30, "unseen word", None]
    found_rows = resampling.resampled(
        frame(docs), spark.createDataFrame([(t,) for t in target], "text string"), percent=30, buckets=buckets, order=order
    )
    assert found(found_rows) == plain(docs, target, order, buckets, percent=30)


def test_on_odd_rows(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    target = spark.createDataFrame([("A plain line that repeats a word word",)], "text string")
    for percent, least in ((10, 20), (100, 0), (50, 1)):
        got = resampling.resampled(odd, target, percent=percent, least=least)
        assert found(got) == plain(docs, ["A plain line that repeats a word word"], least=least, percent=percent)
    assert resampling.resampled(empty, target).collect() == []
    assert found(resampling.resampled(odd, target.limit(0))) == plain(docs, [])
    renamed = odd.select("doc_id", "text").toDF("key", "body")
    bodies = target.toDF("words")
    got = resampling.resampled(renamed, bodies, id_col="key", text_col="body", target_col="words")
    assert found(got) == plain(docs, ["A plain line that repeats a word word"])


def test_ranks_over_many_tasks(spark):
    rows = spark.range(0, 5_000, numPartitions=7).selectExpr("id % 900 AS doc_id", "0L AS copy", "id % 3 * 100 AS score")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(resampling.ranked(rows, 4_000).collect(), key=lambda r: (r.rank is None, r.rank))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert [r.rank for r in got] == [*range(1, 4_001), *[None] * 1_000]
    assert [(-r.score, r.doc_id) for r in got[:4_000]] == sorted((-r.score, r.doc_id) for r in got)[:4_000]


def test_like_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    want = con.execute(catalog.SQL["op12_importance_resampling"]).fetchall()
    got = catalog.QUERIES["op12_importance_resampling"](spark, folder)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert found(got) == sorted(want, key=str)
