"""Toxicity by weak supervision.

Voters are lexicons and patterns: a fixed list of insults, lexicons of words and word
beginnings learned from labelled rows, and patterns such as an insult behind a pronoun. A
generative label model (two classes, one firing rate per voter and class) is fitted by
expectation maximisation to how often each set of voters fires together in all documents;
voters that fire together beyond what the class explains share their evidence. A linear
classifier over the lexicon terms is then trained on the posterior labels.

Held-out rows (crc32 of the id modulo 5 is 0) give no labels and no training rows.
Labels, language, source and id are no inputs of a score. Term counts cover all labelled
rows that are not held out, counts of voter sets cover all documents, and every whole text
is scored. Only the linear classifier is fitted on a share: about ``FIT_ROWS`` documents at
most, chosen by a hash. Terms that none of them holds get the mean weight of their voter.

Null and empty texts fire no voter and get the classifier's bias as score. Without usable
labels the fixed list and the patterns are all there is. Repeated rows give repeated
results; of equal ids with different labels the toxic one counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import named, rows_where, stored, texts_of, with_text_columns

FIT_ROWS = 20_000
# A learned term needs this much evidence: toxic texts with it times its log odds.
LEAST_EVIDENCE = 20.0
LEAST_ODDS = 4.0
PREFIXES = (3, 4, 5, 6)
DEFAULT_RATE = 0.05
FLUSH = 200_000
REMEMBERED = 400_000

# Insults that any corpus may hold.
INSULTS = (
    "arsehole asshole bastard bitch bullshit clown crap creep cretin degenerate disgusting dumb dumbass filth "
    "freak fucker fucking garbage hateful idiot idiotic imbecile jerk loser lowlife maggot moron moronic pathetic "
    "pig retard scum scumbag shit slut stupid trash vermin vile whore worthless"
).split()
ADDRESS = re.compile(r"\b(?:you|your|this|that|these|those|he|she|they|such)\b[^.!?\n]{0,24}\b(?:" + "|".join(INSULTS) + r")\b")
SHOUT = re.compile(r"[!?]{3,}")
WORD = re.compile(r"[^\W\d_]+")
LEARNED_KINDS = ("word", *PREFIXES)
# Insult list, address, several terms, shouting, and two halves of each learned lexicon.
VOTERS = 4 + 2 * len(LEARNED_KINDS)


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, which end with a star."""
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _share(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of the key."""
    there = df.count()
    if there <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("share")), F.lit(1_000_000)) < int(1e6 * rows / there))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with labels of all rows that may be learned from."""
    known = labels.select(named(labels, "doc_id").cast("bigint").alias("doc_id"), named(labels, "toxic").alias("toxic"))
    known = known.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # a merge join at every size: what is moved then grows with the input, not in a step
    return docs.join(known.hint("merge"), "doc_id").select("text", "toxic")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have each term, summed up within the task. The empty
    term counts all documents."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        terms = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(terms, pa.string())] + [pa.array([c[t] for t in terms], pa.int64()) for c in counts]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["term", "clean", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = {t for w in words_of(text) for t in terms_of(w)}
            counts[bool(toxic)].update(found | {""})
            if sum(map(len, counts)) > FLUSH:
                yield flush()
    yield flush()


@dataclass(frozen=True)
class Lexicon:
    """Terms in the order of their feature numbers; the fixed insults come first."""

    terms: tuple[str, ...]
    rate: float


def learned(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Terms that toxic labelled texts have far more often than clean ones."""
    counts = _labelled(docs, labels).mapInArrow(_term_counts, "term string, clean bigint, toxic bigint")
    counts = stored(counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")
    total = counts.where("term = ''").first()
    if total is None or not total.toxic or not total.clean:
        return Lexicon(tuple(INSULTS), DEFAULT_RATE)
    odds = F.log((F.col("toxic") + 0.5) / (total.toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (total.clean + 1.0))
    found = counts.where("term <> ''").withColumn("odds", odds)
    found = found.where((F.col("odds") >= LEAST_ODDS) & (F.col("odds") * F.col("toxic") >= LEAST_EVIDENCE))
    found = found.orderBy((F.col("odds") * F.col("toxic")).desc(), "term").select("term").collect()
    fixed = set(INSULTS)
    return Lexicon(
        (*INSULTS, *(r.term for r in found if r.term not in fixed)), total.toxic / (total.toxic + total.clean)
    )


class Features(dict):
    """Feature numbers of a word's terms, the first ``limit`` words remembered."""

    def __init__(self, terms: tuple[str, ...], limit: int = REMEMBERED):
        super().__init__()
        self.numbers, self.limit = {t: i for i, t in enumerate(terms)}, limit

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.numbers[t] for t in terms_of(word) if t in self.numbers)
        if len(self) < self.limit:
            self[word] = found
        return found


def _voter_of(terms: tuple[str, ...]) -> list[int]:
    """Voter of each term: by kind, and within a kind by a hash into two halves."""
    voters = []
    for i, term in enumerate(terms):
        kind = LEARNED_KINDS.index(len(term) - 1 if term.endswith("*") else "word")
        half = xxhash.xxh32_intdigest(term) % 2
        voters.append(0 if i < len(INSULTS) else 4 + 2 * kind + half)
    return voters


def reader(terms: tuple[str, ...]) -> Callable[[str | None], tuple[list[int], int]]:
    """Features of a text, and the set of voters that fire as bits of a number."""
    features, voter_of = Features(terms), _voter_of(terms)

    def read(text: str | None) -> tuple[list[int], int]:
        words = words_of(text)
        hits = sorted({i for w in words for i in features[w]})
        votes = 0
        for i in hits:
            votes |= 1 << voter_of[i]
        if hits:
            stems = {terms[i].rstrip("*")[:3] for i in hits}
            votes |= (len(stems) >= 2) << 2
            if votes & 1:
                votes |= bool(ADDRESS.search(text.lower())) << 1
        if text and SHOUT.search(text):
            votes |= 1 << 3
        return hits, votes

    return read


def fired(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row per document: doc_id, its features and its voters."""

    def make():
        read = reader(lexicon.terms)
        return lambda texts: list(map(list, zip(*map(read, texts)))) if texts else [[], []]

    return with_text_columns(docs, {"hits": "array<int>", "votes": "int"}, make)


def label_model(votes: np.ndarray, counts: np.ndarray, rate: float, rounds: int = 25, steps: int = 4) -> np.ndarray:
    """Posterior of the toxic class for each set of voters.

    votes: one row of 0 and 1 per set; counts: documents with that set. Firing rates per
    class are the voters' accuracies; ``rate`` is the share of toxic documents. Before each
    round, the correlations that a class does not explain say by how many voters' weight
    each voter's evidence is divided.
    """
    # to begin with, the more voters the likelier
    posterior = np.clip(votes.sum(axis=1) / 3, 0.01, 0.99)
    log = np.log
    for _ in range(rounds):
        share = 1 + sum(_dependence(votes, w) for w in (counts * posterior, counts * (1 - posterior))) / 2
        for _ in range(steps):
            toxic, clean = counts * posterior, counts * (1 - posterior)
            fire = [(w @ votes + 0.1) / (w.sum() + 1.0) for w in (toxic, clean)]
            fire = [np.clip(f, 1e-6, 1 - 1e-6) for f in fire]
            weight = votes * (log(fire[0]) - log(fire[1])) + (1 - votes) * (log(1 - fire[0]) - log(1 - fire[1]))
            odds = log(rate / (1 - rate)) + (weight / share).sum(axis=1)
            posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def _dependence(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of each voter's positive correlations with the others within one class."""
    if weight.sum() < 2:
        return np.zeros(votes.shape[1])
    centred = votes - weight @ votes / weight.sum()
    cov = (centred * weight[:, None]).T @ centred / weight.sum()
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    related = np.clip(cov / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(related, 0)
    return related.sum(axis=1)


@dataclass(frozen=True)
class Classifier:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def scores(self, hits: list) -> list[float]:
        return [float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[h].sum(), -30, 30)))) for h in hits]


def linear(hits: list[np.ndarray], target: np.ndarray, size: int, steps: int = 400, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression over present terms on soft labels, by Adam over all rows."""
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    columns = np.concatenate([np.empty(0, np.int64), *hits]).astype(np.int64)
    theta, first, second = (np.zeros(size + 1) for _ in range(3))
    theta[size] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)) if len(target) else -3.0
    for step in range(1, steps + 1 if len(target) else 1):
        odds = theta[size] + np.bincount(rows, theta[columns], len(hits))
        gap = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.append(np.bincount(columns, gap[rows], size), gap.sum()) / len(hits) + l2 * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta[:size], float(theta[size])


def with_unseen(weights: np.ndarray, hits: list[np.ndarray], terms: tuple[str, ...]) -> np.ndarray:
    """Terms in none of the rows get the mean weight of their voter's terms that are, or of
    all terms that are."""
    seen = np.bincount(np.concatenate([np.empty(0, np.int64), *hits]).astype(np.int64), minlength=len(terms)) > 0
    if not seen.any() or seen.all():
        return weights
    voters = np.array(_voter_of(terms))
    weights = weights.copy()
    learned_terms = np.arange(len(terms)) >= len(INSULTS)
    for voter in np.unique(voters[~seen & learned_terms]):
        alike = seen & (voters == voter)
        weights[~seen & (voters == voter)] = weights[alike if alike.any() else seen].mean()
    return weights


def fitted(found: DataFrame, lexicon: Lexicon) -> Classifier:
    """The classifier, from the stored features and voters of all documents."""
    # at most one row per set of voters
    sets = sorted((r.votes, r["count"]) for r in found.groupBy("votes").count().collect())
    votes = np.array([[v >> j & 1 for j in range(VOTERS)] for v, _ in sets], float).reshape(len(sets), VOTERS)
    counts = np.array([c for _, c in sets], float)
    posterior = dict(zip((v for v, _ in sets), label_model(votes, counts, lexicon.rate) if sets else ()))
    rows = _share(found.where(~held_out(F.col("doc_id"))), F.struct("doc_id", "hits"), FIT_ROWS)
    rows = rows.select("hits", "votes").orderBy("votes", "hits").collect()
    hits = [np.array(r.hits, np.int64) for r in rows]
    weights, bias = linear(hits, np.array([posterior[r.votes] for r in rows]), len(lexicon.terms))
    return Classifier(lexicon, with_unseen(weights, hits, lexicon.terms), bias)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted."""
    docs = texts_of(docs, id_col, text_col)
    lexicon = learned(docs, labels)
    found = stored(fired(docs, lexicon), "voters")
    model = fitted(found, lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("hits").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    out = found.select("doc_id", "hits").mapInArrow(score, "doc_id bigint, score double")
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, all columns unchanged."""
    narrow = texts_of(docs, id_col, text_col)
    lexicon = learned(narrow, labels)
    model = fitted(stored(fired(narrow, lexicon), "voters"), lexicon)

    def keep():
        read = reader(lexicon.terms)
        return lambda texts: [s < 0.5 for s in model.scores([read(t)[0] for t in texts])]

    return rows_where(docs, keep, text_col)
