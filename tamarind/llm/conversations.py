"""Conversation structure repair by run-length dynamic programming.

A conversation is well formed if its roles read ``(system? (user assistant)+)?``. The
edits of a row are Keep, Rerole and Delete (blank rows and duplicates must go), and
empty rows may be inserted anywhere; the cheapest script is wanted, and the one whose
initials come first in ASCII among equally cheap ones.

Rows become symbols of role class and fault; equal consecutive ones are a run. A symbol
is a min-plus matrix over the four states of the grammar, a run advances the costs by
binary powers of it, which are cached. Going back through the runs gives what the rest
costs from each state; unrolling takes the smallest initial that keeps to these costs,
halving a run block by block (short blocks are remembered as well).

Rows are range-partitioned by conversation and order, so that a conversation of any
length is spread over tasks. One that lies inside a partition is solved there. Those at
the borders are solved by parts: each part's matrix, then the costs after each part, each
part's script from all four states, and last the scripts that fit together.

Damage makes faulty conversations for tests of a repair, by a hash of conversation and
turn. Order within a conversation: turn with nulls first, role, hash of the text; copies
stand together. Null roles and texts count as one space, null ids and turns too where
they are hashed; the rows of a null conversation id are one conversation. Rows may be
repeated. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import named, prepared, stored

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# States: at the start, after system, after user, after assistant.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
# Role classes: s, u, a, and all others; faults: none, truncated, must be deleted.
CLASSES, FAULTS = 4, 3
CLEAN, TRUNCATED, REMOVED = range(FAULTS)
OTHER = 3
NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted or reroled row
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL_PAIRS = {(0, 1), (1, 2), (2, 1)}
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
NEVER = 1 << 60
# What is left to pay after the last row: inserts up to the end of a pair.
AT_END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def times(left: Matrix, right: Matrix) -> Matrix:
    """Min-plus product."""
    columns = list(zip(*right))
    return tuple(tuple(min(min(a + b for a, b in zip(row, col)), NEVER) for col in columns) for row in left)


def advance(matrix: Matrix, after: Vector) -> Vector:
    """Costs before, from the costs after."""
    w, x, y, z = after
    return tuple(min(r[0] + w, r[1] + x, r[2] + y, r[3] + z) for r in matrix)


IDENTITY: Matrix = tuple(tuple(0 if p == q else NEVER for q in STATES) for p in STATES)
_ONE_INSERT: Matrix = tuple(tuple(0 if p == q else INSERT if NEXT[p] == q else NEVER for q in STATES) for p in STATES)
INSERTS: Matrix = times(times(_ONE_INSERT, _ONE_INSERT), _ONE_INSERT)


def _edits(symbol: int) -> list[tuple[str, dict[int, tuple[int, int]]]]:
    """For each edit of a row, in ASCII order: cost and next state by state."""
    role, fault = divmod(symbol, FAULTS)
    extra = UNFINISHED if fault == TRUNCATED else 0
    found = [("D", {q: (DELETE, q) for q in STATES})]
    if fault != REMOVED:
        found.append(("K", {q: (extra, KEPT[q, role]) for q in STATES if (q, role) in KEPT}))
        found.append(("R", {q: (REROLE + extra, NEXT[q]) for q in STATES}))
    return found


EDITS = [_edits(symbol) for symbol in range(CLASSES * FAULTS)]


@lru_cache(maxsize=None)
def power(symbol: int, exponent: int) -> Matrix:
    """The symbol's transition to the power 2 ** exponent."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    best = [[NEVER] * len(STATES) for _ in STATES]
    for _, moves in EDITS[symbol]:
        for state, (cost, onward) in moves.items():
            best[state][onward] = min(best[state][onward], cost)
    return times(INSERTS, tuple(map(tuple, best)))


def _bits(length: int) -> list[int]:
    return [e for e in range(length.bit_length()) if length >> e & 1]


def before_run(symbol: int, length: int, after: Vector) -> Vector:
    for exponent in _bits(length):
        after = advance(power(symbol, exponent), after)
    return after


def run_matrix(symbol: int, length: int) -> Matrix:
    found = IDENTITY
    for exponent in _bits(length):
        found = times(found, power(symbol, exponent))
    return found


def _one(symbol: int, state: int, after: Vector) -> tuple[str, int]:
    """Edits of one row, with the inserts in front of it, and the state after it."""
    left = advance(power(symbol, 0), after)
    script = ""
    while True:
        for name, moves in EDITS[symbol]:
            if name > "I" and INSERT + left[NEXT[state]] == left[state]:
                break
            if state in moves and moves[state][0] + after[moves[state][1]] == left[state]:
                return script + name, moves[state][1]
        script, state = script + "I", NEXT[state]


def _block(symbol: int, exponent: int, state: int, after: Vector) -> tuple[str, int]:
    if not exponent:
        return _one(symbol, state, after)
    middle = advance(power(symbol, exponent - 1), after)
    first, state = unrolled(symbol, exponent - 1, state, middle)
    second, state = unrolled(symbol, exponent - 1, state, after)
    return first + second, state


_remembered = lru_cache(maxsize=1 << 16)(_block)
# Longer blocks are put together from remembered ones, so the memory stays small.
LONGEST_REMEMBERED = 8


def unrolled(symbol: int, exponent: int, state: int, after: Vector) -> tuple[str, int]:
    """Script and next state of 2 ** exponent equal rows; only differences of costs count."""
    least = min(after)
    costs = tuple(c - least for c in after)
    return (_remembered if exponent <= LONGEST_REMEMBERED else _block)(symbol, exponent, state, costs)


Runs = list[list[int]]


def script(runs: Runs, state: int, after: Vector, last: bool) -> tuple[str, int]:
    """Cheapest script of the runs from a state, given the costs after them."""
    steps: list[tuple[int, int, Vector]] = []
    for symbol, length in reversed(runs):
        for exponent in _bits(length):
            steps.append((symbol, exponent, after))
            after = advance(power(symbol, exponent), after)
    parts = []
    for symbol, exponent, rest in reversed(steps):
        part, state = unrolled(symbol, exponent, state, rest)
        parts.append(part)
    if last:
        parts.append("I" * (AT_END[state] // INSERT))
    return "".join(parts), state


class Part:
    """Rows of one conversation in order, summed up: runs, counts, first and last turn."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self):
        self.runs: Runs = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: int, copies: int, blank: bool, seen: bool, truncated: bool) -> None:
        """Copies of a row; all but the first are duplicates, the first too if seen before."""
        if not copies:
            return
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if blank:
            self.blank += copies
            self._append(role, REMOVED, copies)
        elif seen:
            self.duplicate += copies
            self._append(role, REMOVED, copies)
        else:
            self.truncated += truncated
            self.duplicate += copies - 1
            self._append(role, TRUNCATED if truncated else CLEAN, 1)
            if copies > 1:
                self._append(role, REMOVED, copies - 1)

    def _append(self, role: int, fault: int, length: int) -> None:
        symbol, runs = role * FAULTS + fault, self.runs
        self.illegal += length - 1
        if runs:
            self.illegal += (runs[-1][0] // FAULTS, role) not in LEGAL_PAIRS
            if runs[-1][0] == symbol:
                runs[-1][1] += length
                return
        runs.append([symbol, length])

    def numbers(self) -> list[int | None]:
        ends = [self.runs[0][0] // FAULTS, self.runs[-1][0] // FAULTS] if self.runs else [None, None]
        counts = [self.blank, self.duplicate, self.truncated, self.illegal, self.turns]
        return [*counts, self.first_turn, self.last_turn, *ends]


def joined(one: list, two: list) -> list:
    """Numbers of two neighbouring parts as those of one."""
    blank, duplicate, truncated, illegal, turns, first, last, role, end = (a + b if i < 5 else a for i, (a, b) in enumerate(zip(one, two)))
    if one[8] is not None and two[7] is not None:
        illegal += (one[8], two[7]) not in LEGAL_PAIRS
    if one[6] is not None and one[6] == two[5]:
        turns -= 1
    first = two[5] if first is None else first
    last = last if two[6] is None else two[6]
    role = two[7] if role is None else role
    end = end if two[8] is None else two[8]
    return [blank, duplicate, truncated, illegal, turns, first, last, role, end]


def outcome(numbers: list, cost: int) -> list[int]:
    """gaps, blank, duplicate, truncated, illegal, cost."""
    *counts, turns, first, last, _, _ = numbers
    return [0 if first is None else last - first + 1 - turns, *counts, cost]


OUTCOME = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SOLVED = "conv_id bigint, outcome array<bigint>, audit string"
PARTS = f"{SOLVED}, part int, numbers array<bigint>, symbols array<bigint>, lengths array<bigint>, matrix array<bigint>"
LISTS = pa.list_(pa.int64())
PART_TYPES = [pa.int64(), LISTS, pa.string(), pa.int32(), LISTS, LISTS, LISTS, LISTS]


def in_batches(schema: pa.Schema, rows: Iterator[tuple], size: int = 2_000, weight: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded length and bounded text."""
    held, heavy = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        heavy += sum(len(v) for v in row if isinstance(v, (str, list)))
        if len(held) >= size or heavy >= weight:
            yield batch()
            held, heavy = [], 0
    if held:
        yield batch()


def _schema(ddl: str, types: list[pa.DataType]) -> pa.Schema:
    return pa.schema(list(zip([c.split()[0] for c in ddl.split(", ")], types)))


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _solve_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range: conversations inside it solved, those at its ends as parts."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId()

    def finish(conv, part: Part, border: bool) -> tuple:
        if not border:
            costs = AT_END
            for symbol, length in reversed(part.runs):
                costs = before_run(symbol, length, costs)
            audit, _ = script(part.runs, START, AT_END, True)
            return conv, outcome(part.numbers(), costs[START]), audit, None, None, None, None, None
        matrix = IDENTITY
        for symbol, length in part.runs:
            matrix = times(matrix, run_matrix(symbol, length))
        symbols, lengths = [s for s, _ in part.runs], [n for _, n in part.runs]
        return conv, None, None, number, part.numbers(), symbols, lengths, [c for row in matrix for c in row]

    def rows() -> Iterator[tuple]:
        conv, part, first = None, None, True
        for key, turn, copies, role, blank, seen, truncated in streamed(batches):
            if part is None or key != conv:
                if part is not None:
                    yield finish(conv, part, first)
                    first = False
                conv, part = key, Part()
            part.add(turn, role, copies, blank, seen, truncated)
        if part is not None:
            yield finish(conv, part, True)

    yield from in_batches(_schema(PARTS, PART_TYPES), rows())


def _as_matrix(flat: list[int]) -> Matrix:
    n = len(STATES)
    return tuple(tuple(flat[n * i : n * i + n]) for i in STATES)


AFTER = "conv_id bigint, part int, after array<bigint>, last boolean"


def _costs_after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of each conversation from the last to the first: what the rest costs."""

    def rows() -> Iterator[tuple]:
        conv, after = None, None
        for key, part, matrix in streamed(batches):
            last = after is None or key != conv
            if last:
                conv, after = key, AT_END
            yield key, part, list(after), last
            after = advance(_as_matrix(matrix), after)

    yield from in_batches(_schema(AFTER, [pa.int64(), pa.int32(), LISTS, pa.bool_()]), rows())


SCRIPTS = "conv_id bigint, part int, numbers array<bigint>, scripts array<string>, ends array<bigint>, before array<bigint>"


def _scripts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each part's script from each state."""

    def rows() -> Iterator[tuple]:
        for key, part, numbers, symbols, lengths, matrix, after, last in streamed(batches):
            runs, after = list(zip(symbols, lengths)), tuple(after)
            found = [script(runs, state, after, last) for state in STATES]
            before = advance(_as_matrix(matrix), after)
            yield key, part, numbers, [s for s, _ in found], [q for _, q in found], list(before)

    types = [pa.int64(), pa.int32(), LISTS, pa.list_(pa.string()), LISTS, LISTS]
    yield from in_batches(_schema(SCRIPTS, types), rows())


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of each conversation in order: the scripts that follow one another."""

    def rows() -> Iterator[tuple]:
        conv, numbers, cost, state, audit = None, None, 0, START, []
        for key, _, part_numbers, scripts, ends, before in streamed(batches):
            if numbers is None or key != conv:
                if numbers is not None:
                    yield conv, outcome(numbers, cost), "".join(audit)
                conv, numbers, cost, state, audit = key, part_numbers, before[START], START, []
            else:
                numbers = joined(numbers, part_numbers)
            audit.append(scripts[state])
            state = ends[state]
        if numbers is not None:
            yield conv, outcome(numbers, cost), "".join(audit)

    yield from in_batches(_schema(SOLVED, PART_TYPES[:3]), rows())


def conversation_rows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, text and copies = 1, nulls of role and text as one space."""
    return rows.select(
        named(rows, conv_col).cast("bigint").alias("conv_id"),
        named(rows, turn_col).cast("bigint").alias("turn"),
        F.coalesce(named(rows, role_col), F.lit(" ")).alias("role"),
        F.coalesce(named(rows, text_col), F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as of ``conversation_rows`` with planted faults, by hash of conversation and
    turn: dropped (no copies), emptied, unfinished, repeated, or of another role."""
    named_or_space = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(named_or_space[0], F.lit(":"), named_or_space[1]).cast("binary")) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(F.col("copies")).alias("copies"),
    )


def _order(*last: str) -> list[Column]:
    return [F.asc("conv_id"), F.asc_nulls_first("turn"), *map(F.asc, last)]


def _with_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hash", F.md5(F.col("text").cast("binary")))


def _symbols(rows: DataFrame) -> DataFrame:
    """One row per different row, without its text: role class, faults, copies, and
    whether role and text were seen in an earlier turn of the conversation."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    marked = _with_hash(rows).select(
        "conv_id",
        "turn",
        "role",
        "hash",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER).alias("class"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(*ENDS)).alias("truncated"),
        "copies",
    )
    same = ("conv_id", "turn", "role", "hash", "class", "blank", "truncated")
    distinct = stored(marked.groupBy(*same).agg(F.sum("copies").alias("copies")), "turns")
    turn_order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (
        distinct.where("copies > 0")
        .groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"))
        .agg(F.min(turn_order).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1")
    )
    same_row = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    return distinct.join(again, same_row, "left").withColumn(
        "seen", F.coalesce(F.col("first") < turn_order, F.lit(False))
    )


def solved(rows: DataFrame) -> DataFrame:
    """conv_id, outcome (see ``OUTCOME``) and audit of every conversation."""
    prepared(rows.sparkSession)
    order = _order("role", "hash")
    laid = _symbols(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.select("conv_id", "turn", "copies", "class", "blank", "seen", "truncated")
    parts = stored(laid.mapInArrow(_solve_inside, PARTS), "parts")
    inside, borders = parts.where("part IS NULL"), parts.where("part IS NOT NULL")
    backward = borders.select("conv_id", "part", "matrix").repartition("conv_id")
    backward = backward.sortWithinPartitions(F.asc("conv_id"), F.desc("part"))
    after = backward.mapInArrow(_costs_after, AFTER).toDF("c", "p", "after", "last")
    joint = borders.join(after, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    joint = joint.select("conv_id", "part", "numbers", "symbols", "lengths", "matrix", "after", "last")
    forward = joint.mapInArrow(_scripts, SCRIPTS).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return inside.select("conv_id", "outcome", "audit").unionAll(forward.mapInArrow(_fitted, SOLVED))


def replayed(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows, from a script and the rows in order."""
    state, at = START, 0
    for role, text in rows:
        while audit[at] == "I":
            state = NEXT[state]
            yield "I", ROLE[state], ""
            at += 1
        edit = audit[at]
        at += 1
        if edit == "K":
            state = KEPT[state, "sua".find(role[:1])]
            yield edit, role, text
        elif edit == "R":
            state = NEXT[state]
            yield edit, ROLE[state], text
    for edit in audit[at:]:
        state = NEXT[state]
        yield edit, ROLE[state], ""


def _beside_scripts(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Each conversation's script, then its rows in order, in one partition."""
    given = _with_hash(rows).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "hash", "copies", "text", F.lit(None).cast("array<bigint>").alias("outcome")
    )
    none = F.lit(None)
    heads = answers.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("bigint").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("hash"), F.lit(0).alias("copies"), F.col("audit").alias("text"), "outcome",
    )
    both = given.unionAll(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "hash").select(
        "conv_id", "kind", "role", "copies", "text", "outcome"
    )


def _replay(use: Callable[[int | None, list, str, Iterator[tuple[str, str, str]]], Iterator[tuple]], schema: pa.Schema):
    """Streams each conversation's repaired rows through ``use``; none is held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = streamed(batches)
        head = next(items, None)

        def rows_of() -> Iterator[tuple[str, str]]:
            nonlocal head
            for item in items:
                if item[1] == 0:
                    head = item
                    return
                for _ in range(item[3]):
                    yield item[2], item[4]
            head = None

        def rows() -> Iterator[tuple]:
            while head is not None:
                conv, _, _, _, audit, numbers = head
                left = rows_of()
                yield from use(conv, numbers, audit, replayed(audit, left))

        yield from in_batches(schema, rows())

    return run


REPAIRED = "conv_id bigint, place bigint, edit string, role string, text string"


def repaired(rows: DataFrame) -> DataFrame:
    """The rows of the repaired conversations, in order of ``place`` from 0."""

    def use(conv, _, __, edits):
        for place, (edit, role, text) in enumerate(edits):
            yield conv, place, edit, role, text

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _beside_scripts(rows, stored(solved(rows), "solved")).mapInArrow(_replay(use, _schema(REPAIRED, types)), REPAIRED)


REPORT = f"conv_id bigint, {', '.join(f'{n} bigint' for n in OUTCOME)}, audit string, repaired_sha256 string"


def report(rows: DataFrame) -> DataFrame:
    """Faults, cost, script and digest of the repaired text of every conversation."""

    def use(conv, numbers, audit, edits):
        digest, between = hashlib.sha256(), b""
        for _, role, text in edits:
            digest.update(between + role.encode() + b":" + text.encode())
            between = b"\n"
        yield conv, *numbers, audit, digest.hexdigest()

    types = [*[pa.int64()] * (1 + len(OUTCOME)), pa.string(), pa.string()]
    return _beside_scripts(rows, stored(solved(rows), "solved")).mapInArrow(_replay(use, _schema(REPORT, types)), REPORT)
