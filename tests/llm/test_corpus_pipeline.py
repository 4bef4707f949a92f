"""The corpus pipeline, stage by stage, against the plain versions of its operators."""

import random

import __spark_entry__
import corpus_pipeline
import pytest
from llm.test_decontaminate import plain_matches
from llm.test_near_dedup import brute_classes
from llm.test_sequences import check_packing
from llm.test_texts import brute_base

NAMES = ["toxicity", "quality_rules", "near_dedup", "decontamination", "packing"]


def corpus():
    draw = random.Random(21)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(3, 7))) for _ in range(2_000)]

    def prose(n):
        return draw.choices(vocabulary, k=n)

    items = [(i, " ".join(prose(30))) for i in range(12)]
    rows, labels, toxic = [], [], set()
    for i in range(500):
        words = prose(draw.randint(60, 160))
        if i % 9 == 0:
            toxic.add(i)
            for _ in range(5):
                words.insert(draw.randrange(len(words)), draw.choice(["moron", "scum", "loser", "pathetic"]))
        elif i % 9 == 1:
            words = words[:12] * 12
        elif i % 9 == 2:
            words = words[:20]
        elif i % 9 == 3 and i > 8:
            words = rows[i - 4][1].split()
            words[draw.randrange(len(words))] = "changed"
        elif i % 9 == 4:
            words[30:30] = items[i % 12][1].split()
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, 1, int(i in toxic)))
    rows += [rows[5], rows[14], (None, "null id " + " ".join(prose(70))), (9_999, None), (9_998, "")]
    return rows, items, labels, toxic


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items, labels, _ = corpus()
    place = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{place}/documents.parquet"
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def test_stages(spark, folder):
    rows, items, _, _ = corpus()
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before, after = docs.columns, rows, None
    seen = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        if name == "packing":
            break
        assert docs.columns == columns
        after = seen(docs)
        if name == "toxicity":
            want = [r for r in before if not set((r[1] or "").split()) & {"moron", "scum", "loser", "pathetic"}]
            assert after == sorted(want, key=str) and len(after) < len(rows)
        elif name == "quality_rules":
            assert after == sorted((r for r in before if not brute_base(r[1])[-1]), key=str) and len(after) < len(before)
        elif name == "near_dedup":
            classes = brute_classes(before, percent=corpus_pipeline.NEAR_PERCENT)
            ids = sorted({c for _, c in classes if c is not None})
            assert sorted(d for d, _ in after if d is not None) == ids and len(after) < len(before)
            assert sum(d is None for d, _ in after) == 1
        else:
            bad = {d for d, *_ in plain_matches(before, items)}
            assert bad and after == sorted((r for r in before if r[0] not in bad), key=str)
        before = after
    texts = {}
    for doc, text in before:
        texts[doc] = (text, texts.get(doc, (None, 0))[1] + 1)
    check_packing(docs.collect(), texts)


def test_run_is_registered(spark, folder):
    queries = __spark_entry__.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in queries) == 1 for n in range(1, 14))
    pieces = queries["pipeline"](spark, folder).collect()
    assert pieces and "pipeline" not in __spark_entry__.oracle_sql()


def test_empty_tables(spark, tmp_path):
    for name, schema in (
        ("documents", "doc_id long, text string, lang string, source string, n_chars long"),
        ("benchmark", "item_id long, text string"),
        ("labels", "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
