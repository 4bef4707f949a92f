"""Conversation repair against a search over all scripts, and against SQL."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarind.llm import catalog, conversations
from tamarind.llm.conversations import AT_END, CLEAN, IDENTITY, OTHER, REMOVED, START, TRUNCATED

AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
WHOLE = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role = "user" if draw == 4 else role
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def cheapest(rows):
    """Shortest path over (rows done, state), smaller scripts first among equal costs."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, script, i, state, made = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, script, made
        (onward,) = [n for n in AFTER[state] if n != "s"]
        heapq.heappush(heap, (cost + 2, script + "I", i, onward, (*made, f"{WHOLE[onward]}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, script + "D", i + 1, state, made))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + extra, script + "R", i + 1, onward, (*made, f"{WHOLE[onward]}:{text}")))
                if role[:1] in AFTER[state]:
                    heapq.heappush(heap, (cost + extra, script + "K", i + 1, role[:1], (*made, f"{role}:{text}")))


def plain(rows):
    found = []
    kept = damage(rows)
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in kept if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "" if bare[-1:] in (".", "!", "?") else "truncated"
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else fault
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        counts = [sum(m[2] == fault for m in marked) for fault in ("blank", "duplicate", "truncated")]
        cost, script, made = cheapest(marked)
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        found.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, script, digest))
    return sorted(found, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SYMBOLS = list(itertools.product("suax", (CLEAN, TRUNCATED, REMOVED)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(SYMBOLS), st.integers(1, 9)), max_size=6), st.data())
def test_runs_like_all_scripts(runs, data):
    rows = [(role, "", {REMOVED: "blank", TRUNCATED: "truncated"}.get(fault, "")) for (role, fault), n in runs for _ in range(n)]
    coded = [["suax".index(role) * 3 + fault, n] for (role, fault), n in runs]
    cost, script, _ = cheapest(rows)
    assert conversations.script(coded, START, AT_END, True)[0] == script
    whole = IDENTITY
    for symbol, n in coded:
        whole = conversations.times(whole, conversations.run_matrix(symbol, n))
    assert conversations.advance(whole, AT_END)[START] == cost
    # by parts, as over the borders of tasks
    at = data.draw(st.integers(0, len(coded)))
    after = AT_END
    for symbol, n in reversed(coded[at:]):
        after = conversations.before_run(symbol, n, after)
    first, state = conversations.script(coded[:at], START, after, False)
    assert first + conversations.script(coded[at:], state, AT_END, True)[0] == script


def test_long_runs():
    for role, fault in SYMBOLS:
        rows = [(role, "", {REMOVED: "blank", TRUNCATED: "truncated"}.get(fault, ""))] * 700
        cost, script, _ = cheapest(rows)
        runs = [["suax".index(role) * 3 + fault, 700]]
        assert conversations.script(runs, START, AT_END, True)[0] == script
        assert conversations.advance(conversations.run_matrix(*runs[0]), AT_END)[START] == cost
    million = conversations.script([[3, 1_000_000]], START, AT_END, True)[0]
    assert len(million) >= 1_000_000


def odd_rows():
    draw = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Hello there.", "No end", "", " \t\n", None, "Well!", "Why?\n", "é", "Same.", "Same.", "\x1c", "a.\x85", "x" * 5_000]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None]), draw.choice(roles), draw.choice(texts)))
    rows += [(1_000, t, "user" if t % 2 else "assistant", f"Turn {t % 50}.") for t in range(3_000)]
    rows += [(1_001, 5, "user", "The same row.")] * 500
    rows += [(1_002, None, None, None), (None, None, None, None)]
    # all rows of these conversations are dropped
    rows += [(c, 0, "user", "Gone.") for c in range(2_000, 2_200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    draw.shuffle(rows)
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_like_all_scripts(spark, coalesce):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("copies", "hash", "class", "part", "audit", "seen", "a.b"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = found(conversations.report(conversations.damaged(conversations.conversation_rows(df))))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == plain(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "tool", "cut"), (1, 2, "user", "Bye."), (2, 0, "system", "Be nice.")]
    df = conversations.conversation_rows(spark.createDataFrame(rows, SCHEMA))
    got = [tuple(r) for r in conversations.repaired(df).orderBy("conv_id", "place").collect()]
    # KDR costs as much as KRKI and comes first; a lone system row costs least to delete
    assert got == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Bye.")]


def test_empty(spark):
    df = conversations.conversation_rows(spark.createDataFrame([], SCHEMA))
    assert conversations.report(conversations.damaged(df)).collect() == []
    assert conversations.repaired(df).collect() == []


def test_like_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = con.execute(catalog.SQL["op13_conversation_repair"]).fetchall()
    got = catalog.QUERIES["op13_conversation_repair"](spark, folder)
    assert got.columns == ["conv_id", *conversations.OUTCOME, "audit", "repaired_sha256"]
    assert found(got) == sorted(want, key=str)
