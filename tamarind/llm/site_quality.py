"""Quality by hierarchical empirical Bayes.

A document classifier (logistic regression on measures of the whole text) gives each
document's evidence. Expected shares of good documents are summed up per path and host;
the strength of the priors comes from how much hosts differ from each other, and paths
within hosts, beyond chance (moments of the grouped sums). A path's share is shrunk
towards its host's, a host's towards the global one, each without the document itself,
and the result replaces the global prior in the document's odds.

The classifier is fitted on about ``FIT_ROWS`` labelled rows at most, chosen by a hash and
never of the held-out fifth; all counts cover all documents. Null host or path is a group
of its own. Null and empty texts have measures 0. Without labels of both classes the
evidence is 0 and everything is kept. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import named, stored, with_text_columns

FIT_ROWS = 20_000
LEAST, MOST = 1e-4, 1 - 1e-4
# Prior strengths in documents: between a weak prior and one that only a large group moves.
WEAKEST, STRONGEST = 2.0, 10_000.0
SYMBOLS = "#*$%&<>@^~=+{}[]\\"
MEASURES = (
    "log_words",
    "word_length",
    "symbols",
    "bars",
    "capitals",
    "digits",
    "shouts",
    "stops",
    "distinct_words",
    "repeated_lines",
    "same_as_before",
)


def measures_of(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(MEASURES)
    chars, n = len(text), len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    letters = sum(map(len, words))
    return [
        float(np.log1p(n)),
        min(letters / n, 50.0) / 10,
        min(1.0, 10 * sum(map(text.count, SYMBOLS)) / chars),
        min(1.0, 10 * text.count("|") / chars),
        sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
        min(1.0, 5 * sum(map(text.count, "0123456789")) / chars),
        min(1.0, 10 * (text.count("!") + text.count("?")) / chars),
        min(1.0, 10 * sum(map(text.count, ".,;:")) / chars),
        # different words fall with length even in good text; compare with a usual curve
        min(2.0, len(set(words)) / n**0.85),
        1 - len(set(lines)) / len(lines),
        sum(a == b for a, b in zip(words, words[1:])) / n,
    ]


@dataclass(frozen=True)
class Logistic:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.spread
        return np.clip(np.c_[z, z * z, np.ones(len(z))] @ self.weights, -9.2, 9.2)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> Logistic:
    """Ridge logistic regression on the measures and their squares, by damped Newton."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / spread
    z = np.c_[z, z * z, np.ones(len(z))]
    weights = np.zeros(z.shape[1])
    penalty = ridge * np.r_[np.ones(z.shape[1] - 1), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (p - y) + penalty * weights
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, spread, weights)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(measured: DataFrame, labels: DataFrame) -> Logistic | None:
    known = labels.select(
        named(labels, "doc_id").cast("bigint").alias("doc_id"), named(labels, "quality").cast("int").alias("good")
    )
    known = known.where(F.col("good").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("good").alias("good"))
    there = known.count()
    if there > FIT_ROWS:
        part = F.pmod(F.xxhash64("doc_id", F.lit("share")), F.lit(1_000_000))
        known = known.where(part < int(1e6 * FIT_ROWS / there))
    # FIT_ROWS rows of two numbers: a bounded broadcast and a bounded collect
    rows = measured.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id")
    rows = rows.select("measures", "good").collect()
    y = np.array([r.good for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    return logistic(np.array([r.measures for r in rows]), y)


def _strength(groups: DataFrame, total: str, count: str, parent: Column, within: float, lost: Column) -> float:
    """Prior strength in documents, from the variance of group shares around their
    parents' beyond that of their documents (one-way analysis of variance)."""
    n, share = F.col(count), F.col(total) / F.col(count)
    row = groups.agg(
        F.sum(n * (share - parent) * (share - parent)).alias("between"),
        F.count("*").alias("groups"),
        lost.alias("parents"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("squares"),
    ).first()
    if not row.n or row.groups <= row.parents:
        return STRONGEST
    spread = (row.between - (row.groups - row.parents) * within) / max(row.n - row.squares / row.n, 1e-9)
    return float(np.clip(within / spread if spread > 0 else STRONGEST, WEAKEST, STRONGEST))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(MOST)), F.lit(LEAST))
    return F.log(p / (1 - p))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str = "source",
    path_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, evidence (log odds), host and path shares, score
    (posterior chance of good quality) and kept."""
    narrow = docs.select(
        named(docs, id_col).cast("bigint").alias("doc_id"),
        named(docs, text_col).alias("text"),
        named(docs, host_col).cast("string").alias("host"),
        named(docs, path_col).cast("string").alias("path"),
    )

    def make() -> Callable[[list], list[list]]:
        return lambda texts: [[measures_of(t) for t in texts]]

    measured = stored(with_text_columns(narrow, {"measures": "array<double>"}, make), "measures")
    model = fitted(measured, labels)

    def odds(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column("measures").to_pylist(), float).reshape(-1, len(MEASURES))
            found = model.odds(x) if model and len(x) else np.zeros(len(x))
            columns = [batch.column(c) for c in ("doc_id", "host", "path")] + [pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", "path", "evidence"])

    rows = measured.mapInArrow(odds, "doc_id bigint, host string, path string, evidence double")
    rows = stored(rows.withColumn("p", 1 / (1 + F.exp(-F.col("evidence")))), "evidence")

    paths = rows.groupBy("host", "path").agg(
        F.sum("p").alias("path_sum"), F.count("*").alias("path_n"), F.sum(F.col("p") * (1 - F.col("p"))).alias("noise"),
        F.sum(F.col("p") * F.col("p")).alias("squares"),
    )
    paths = stored(paths, "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("path_sum").alias("host_sum"), F.sum("path_n").alias("host_n")), "hosts")
    total = paths.agg(
        F.sum("path_sum").alias("s"), F.sum("path_n").alias("n"),
        F.sum(F.col("squares") - F.col("path_sum") * F.col("path_sum") / F.col("path_n")).alias("inside"),
        F.count("*").alias("groups"),
    ).first()
    share = float(np.clip((total.s or 0.0) / total.n, LEAST, MOST)) if total.n else 0.5
    # variance of documents within a path
    within = max(total.inside / max(total.n - total.groups, 1), 1e-6) if total.n else 1e-6
    host_strength = _strength(hosts, "host_sum", "host_n", F.lit(share), within, F.lit(1))
    # host and path shares of one table: it has a row per path, not per document
    same_host = paths["host"].eqNullSafe(hosts["host"])
    groups = stored(paths.join(hosts, same_host).drop(hosts["host"]), "groups")
    path_strength = _strength(
        groups, "path_sum", "path_n", F.col("host_sum") / F.col("host_n"), within, F.lit(hosts.count())
    )

    same = rows["host"].eqNullSafe(groups["host"]) & rows["path"].eqNullSafe(groups["path"])
    out = rows.join(groups.drop("noise", "squares"), same).drop(groups["host"]).drop(groups["path"])
    host_share = (F.col("host_sum") - F.col("p") + host_strength * share) / (F.col("host_n") - 1 + host_strength)
    out = out.withColumn("host_share", host_share)
    path_share = (F.col("path_sum") - F.col("p") + path_strength * F.col("host_share")) / (
        F.col("path_n") - 1 + path_strength
    )
    out = out.withColumn("path_share", path_share)
    score = F.col("evidence") + _logit(F.col("path_share")) - float(np.log(share / (1 - share)))
    score = 1 / (1 + F.exp(-score)) if model else F.lit(0.5)
    return out.select("doc_id", "evidence", "host_share", "path_share", score.alias("score")).withColumn(
        "kept", F.col("score") >= 0.5
    )
