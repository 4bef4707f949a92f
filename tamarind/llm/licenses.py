"""License scan: an Aho-Corasick automaton finds notice phrases and identifier tags, a
shunting-yard parser turns and/or/with expressions behind a tag into postfix order, and
the postfix form is evaluated to labels and to how freely the text may be used.

Null and empty texts have no places, null positions, empty labels and score 0. One row
per input row. Base phrases all count, also inside others; of the added ones those that
lie inside no longer added phrase ("cc by nc" is no "cc by").
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame

from tamarind.llm.common import texts_of, with_text_columns

# The base phrases with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notice phrases that the scan adds, with their labels.
MORE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc by",
    "creative commons zero": "cc0",
    "licensed under cc by": "cc by",
    "licensed under cc by sa": "cc by-sa",
    "licensed under cc by nc": "cc by-nc",
    "licensed under cc by nd": "cc by-nd",
    "released into the public domain": "public domain",
    "all rights reserved": "all rights reserved",
}

# Identifiers in expressions by their first part, with label and freedom of use from 0 to 1.
IDENTIFIERS = {
    "mit": ("mit", 1.0),
    "isc": ("isc", 1.0),
    "0bsd": ("bsd", 1.0),
    "bsd": ("bsd", 1.0),
    "apache": ("apache", 1.0),
    "unlicense": ("public domain", 1.0),
    "cc0": ("cc0", 1.0),
    "zlib": ("zlib", 1.0),
    "bsl": ("bsl", 1.0),
    "mpl": ("mpl", 0.6),
    "epl": ("epl", 0.6),
    "lgpl": ("lgpl", 0.5),
    "gpl": ("gpl", 0.3),
    "agpl": ("agpl", 0.2),
    "cc": ("cc by", 0.8),
    "proprietary": ("all rights reserved", 0.0),
}
EXCEPTION_BONUS = 0.2
UNKNOWN_FREEDOM = 0.0
TAG = "spdx license identifier"
PHRASE_EVIDENCE, TAG_EVIDENCE = 0.6, 0.9
BINDING = {"or": 1, "and": 2, "with": 3}

# Lower-cases A-Z; every other ASCII byte that is not a letter or digit parts words.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")


def postfix(expression: str) -> list[str] | None:
    """Operands and operators in postfix order; None if the expression is malformed.

    ``with`` binds tightest, then ``and``, then ``or``; equal ones from left to right.
    """
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in TOKEN.findall(expression):
        word = token.lower()
        if word == "(":
            if not operand_next:
                return None
            held.append(word)
        elif word == ")":
            if operand_next:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif word in BINDING:
            if operand_next:
                return None
            while held and held[-1] != "(" and BINDING[held[-1]] >= BINDING[word]:
                out.append(held.pop())
            held.append(word)
            operand_next = True
        else:
            if not operand_next:
                break  # prose behind the expression
            out.append(word)
            operand_next = False
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def identified(name: str) -> tuple[frozenset[str], float]:
    """Label and freedom of one identifier; unknown ones keep their own name."""
    name = name.rstrip("+")
    if name.startswith("cc-by"):
        kind = "-".join(p for p in name.split("-")[1:] if not p[0].isdigit())
        return frozenset([f"cc {kind}"]), 0.8 if kind == "by" else 0.4
    label, freedom = IDENTIFIERS.get(re.split(r"[-.]", name)[0], (name, UNKNOWN_FREEDOM))
    return frozenset([label]), freedom


def evaluated(steps: list[str]) -> tuple[frozenset[str], float]:
    """All labels of an expression and its freedom: ``or`` leaves the user the freest
    choice, ``and`` the strictest, ``with`` adds what an exception allows."""
    stack: list[tuple[frozenset[str], float, str]] = []
    for step in steps:
        if step not in BINDING:
            stack.append((*identified(step), step))
            continue
        right, left = stack.pop(), stack.pop()
        if step == "with":
            stack.append((left[0], min(1.0, left[1] + EXCEPTION_BONUS), left[2]))
        else:
            pick = max if step == "or" else min
            stack.append((left[0] | right[0], pick(left[1], right[1]), ""))
    return stack[0][:2]


FIELDS = {
    "n_words": "bigint",
    "n_base": "bigint",
    "first_word": "bigint",
    "last_word": "bigint",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "freedom": "double",
    "n_tags": "bigint",
}


def outermost(places: list[tuple[int, int, str]]) -> list[str]:
    """Phrases of (start, end, phrase) that do not lie inside a longer one."""
    kept, reach = [], -1
    for _, end, phrase in sorted(places, key=lambda p: (p[0], -p[1])):
        if end > reach:
            kept.append(phrase)
            reach = end
    return kept


def scanner() -> Callable[[list], list[list]]:
    """Per task: the automaton over padded phrases, and a function over texts."""
    automaton = ahocorasick.Automaton()
    for phrase in {**MORE_PHRASES, **BASE_PHRASES, TAG: ""}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()

    def one(text: str | None) -> tuple:
        words = (text or "").encode().translate(FOLD).split()
        line = " " + b" ".join(words).decode() + " "
        n_base, places, base, labels, tagged = 0, [], set(), set(), False
        missed, spaces, counted = 1.0, 0, 0
        added: list[tuple[int, int, str]] = []
        for end, phrase in automaton.iter(line):
            spaces += line.count(" ", counted, end)
            counted = end
            if phrase == TAG:
                tagged = True
                continue
            if phrase in BASE_PHRASES:
                missed *= 1 - PHRASE_EVIDENCE
                n_base += 1
                places.append(spaces - 1 - phrase.count(" "))
                base.add(BASE_PHRASES[phrase])
            else:
                added.append((end - len(phrase), end, phrase))
        for phrase in outermost(added):
            missed *= 1 - PHRASE_EVIDENCE
            labels.add(MORE_PHRASES[phrase])
        freedom, n_tags = None, 0
        if tagged:
            for expression in TAG_LINE.findall(text):
                steps = postfix(expression)
                if steps is None:
                    continue
                found, free = evaluated(steps)
                labels |= found
                freedom = free if freedom is None else min(freedom, free)
                missed *= 1 - TAG_EVIDENCE
                n_tags += 1
        return (
            len(words),
            n_base,
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | labels)),
            1 - missed,
            freedom,
            n_tags,
        )

    return lambda texts: list(map(list, zip(*map(one, texts)))) if texts else [[] for _ in FIELDS]


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: places, labels and score of its whole text."""
    return with_text_columns(texts_of(docs, id_col, text_col), FIELDS, lambda: scanner())
