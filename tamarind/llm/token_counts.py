"""Token counts: texts are cut at safe boundaries, the cuts are encoded in batches
balanced by bytes, and only lengths leave the Arrow function.

A boundary is safe where no token can reach over it: between a character that is no
white space and a following space, tab or line break. The byte-level pre-tokenizer never
joins the two, so the lengths of the cuts add up to the length of the text, and a very long
text never is one call unless it has no white space. Cuts that recur within a task (words,
mostly) are encoded once and their lengths remembered, up to a bounded number.

Null and empty texts have 0 tokens. One row per input row.
"""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import texts_of, with_text_columns
from tamarind.llm.tokens import tokenizer

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 1_024
BATCH_BYTES = 1 << 20
REMEMBERED = 700_000
CLOSING = ".,;:!?"

# Characters of which Python and the tokenizer might disagree whether they are white space:
# no boundary is placed behind one.
DOUBTFUL = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
CUT = re.compile(r"[ \n\t\r\x0b\x0c]*[^ \n\t\r\x0b\x0c]+|[ \n\t\r\x0b\x0c]+\Z")


def cuts_of(text: str) -> list[str]:
    """Pieces that end at safe boundaries; together they are the text."""
    pieces = CUT.findall(text)
    if not DOUBTFUL.search(text):
        return pieces
    joined: list[list[str]] = []
    for piece in pieces:
        if joined and DOUBTFUL.match(joined[-1][-1][-1]):
            joined[-1].append(piece)
        else:
            joined.append([piece])
    return ["".join(parts) for parts in joined]


def balanced(pieces: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of about ``limit`` bytes each, one piece at least."""
    batch: list[str] = []
    held = 0
    for piece in pieces:
        size = len(piece) * 4 if not piece.isascii() else len(piece)
        if batch and held + size > limit:
            yield batch
            batch, held = [], 0
        batch.append(piece)
        held += size
    if batch:
        yield batch


def parted(cut: str) -> tuple[str, ...]:
    """A cut without its closing marks, and the marks: an ASCII letter or digit and a
    mark are never in one token."""
    core = cut.rstrip(CLOSING)
    if core != cut and core[-1:].isascii() and core[-1:].isalnum():
        return core, cut[len(core) :]
    return (cut,)


class Lengths:
    """Token counts of cuts. The first ``limit`` different cuts are remembered, which
    are mostly the frequent ones."""

    def __init__(self, vocabulary: str, limit: int = REMEMBERED):
        self.encode, self.limit, self.known = tokenizer(vocabulary), limit, {}

    def of(self, cuts: set[str]) -> dict[str, int]:
        """Lengths of at least these cuts."""
        parts = {cut: parted(cut) for cut in cuts if cut not in self.known}
        found = {}
        for batch in balanced([*{p for some in parts.values() for p in some if p not in self.known}]):
            for piece, tokens in zip(batch, self.encode.encode_batch_fast(batch, add_special_tokens=False)):
                found[piece] = len(tokens)
        for cut, some in parts.items():
            if cut not in found:
                found[cut] = sum(found[p] if p in found else self.known[p] for p in some)
        if len(self.known) + len(found) <= self.limit:
            self.known.update(found)
            return self.known
        self.known.update(list(found.items())[: self.limit - len(self.known)])
        return ChainMap(found, self.known)


@lru_cache(maxsize=4)
def lengths(vocabulary: str) -> Lengths:
    """One memory of lengths per Python worker, kept from task to task."""
    return Lengths(vocabulary)


def counter(memory: Lengths) -> Callable[[list], list[list]]:
    """Byte and token counts of a list of texts."""

    def one_list(texts: list) -> list[list]:
        cuts = [cuts_of(t) if t else [] for t in texts]
        length_of = memory.of({c for cut in cuts for c in cut}).__getitem__
        return [[len(t.encode()) if t else 0 for t in texts], [sum(map(length_of, cut)) for cut in cuts]]

    return one_list


def counted(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    limit: int = TOKEN_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: bytes, tokens, and whether it is over the limit."""
    fields = {"n_bytes": "bigint", "n_tokens": "bigint"}
    counts = with_text_columns(texts_of(docs, id_col, text_col), fields, lambda: counter(lengths(vocabulary)))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
