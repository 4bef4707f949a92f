import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG = "word " * 30_000 + "End of a very long text.\n" * 3_000
ODD = [
    (1, "A plain line.\nA plain line.\n\nTrailing  blanks \t and\ttabs\r\n"),
    (2, ""),
    (3, None),
    (None, "no id at all, but five words"),
    (4, "same text twice"),
    (4, "same text twice"),
    (5, "  \n \t "),
    (6, "Ünïcode ΑΣ ΌΣΟΣ  non breaking   line　ideographic ﷺ 👩‍👩‍👧 é ́x <|endoftext|> <|startoftext|>y"),
    (7, "a\x1cb\x85c\x0bd\x0ce don't  'LL 've #$% &|<> *** 123 4,5.6"),
    (8, LONG),
    (9, "x" * 70_000),
]
DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@pytest.fixture
def frame(spark):
    """Documents from (id, text) pairs, in two partitions."""

    def make(rows, source=lambda i: f"src{(i or 0) % 3}"):
        full = [(i, t, "en", source(i), None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(2)

    return make


@pytest.fixture
def odd(frame):
    """Nulls, empty, white and very long texts, repeated rows, unusual characters, and
    columns whose names the operators use themselves."""
    df = frame(ODD)
    for name in ("n_words", "kept", "shard", "size", "score", "bin", "task", "node", "text_hash", "a.b"):
        df = df.selectExpr("*", f"'clash' as `{name}`")
    return df


@pytest.fixture
def empty(frame):
    return frame([])
