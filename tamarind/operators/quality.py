"""Data-quality rules, constraints and issue tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.functions.predicates import any_null, is_true
from tamarind.operators.joins import orphans

Tables = Mapping[str, DataFrame]


def tag(df: DataFrame, reason: str | Column, at: Column | None = None) -> DataFrame:
    """Rejected rows with a reason and a detection time (Q02, Q03)."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return df.withColumns({"error_reason": reason, "error_detected_at": at if at is not None else F.current_timestamp()})


def split(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows); every row is in exactly one of them (Q05)."""
    ok = is_true(valid)
    return df.where(ok), df.where(~ok)


@dataclass(frozen=True)
class NotNull:
    """Business keys must be present."""

    name: str
    table: str
    cols: tuple[str, ...]

    def issues(self, tables: Tables) -> DataFrame:
        return tables[self.table].where(any_null(*self.cols))


@dataclass(frozen=True)
class ForeignKey:
    """Key must exist in the parent. With ``ignore_null`` an empty key is allowed,
    as in an SQL constraint."""

    name: str
    table: str
    col: str
    parent: str
    parent_col: str
    where: str | None = None
    ignore_null: bool = False

    def issues(self, tables: Tables) -> DataFrame:
        child = tables[self.table]
        if self.where:
            child = child.where(self.where)
        if self.ignore_null:
            child = child.where(F.col(self.col).isNotNull())
        return orphans(child, tables[self.parent], {self.col: self.parent_col})


@dataclass(frozen=True)
class Unique:
    """Key must be present and occur once."""

    name: str
    table: str
    cols: tuple[str, ...]

    def issues(self, tables: Tables) -> DataFrame:
        sizes = tables[self.table].groupBy(*self.cols).agg(F.count("*").alias("rows_in_group"))
        return sizes.where((F.col("rows_in_group") > 1) | any_null(*self.cols))


@dataclass(frozen=True)
class Holds:
    """A row condition must hold; unknown is a violation."""

    name: str
    table: str
    condition: str

    def issues(self, tables: Tables) -> DataFrame:
        return split(tables[self.table], F.expr(self.condition))[1]


Rule = NotNull | ForeignKey | Unique | Holds


def issue_table(rule: Rule, tables: Tables, at: Column | None = None) -> DataFrame:
    """Violating rows with the rule's name and the check time (Q04)."""
    return rule.issues(tables).withColumns(
        {"dq_rule": F.lit(rule.name), "dq_checked_at": at if at is not None else F.current_timestamp()}
    )


# What a row tells the count of a rule: that it violates it; a key that must occur once;
# a key that must have a parent; a parent's key.
_VIOLATES, _KEY, _CHILD, _PARENT = "violates", "key", "child", "parent"


def _key(*cols: str) -> Column:
    """A key as text, so that keys of all tables go through one aggregate. Each part of
    several is led by its length, so that different keys stay different."""
    parts = [F.col(c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws(",", *[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("null")) for p in parts])


def _tells(key: Column | None, flag: Column, n: int, when: Column | None = None) -> Column:
    """One statement of a row about a key: a fact that holds for the key, and whether the row
    is counted; none where ``when`` does not hold."""
    told = F.struct(
        (F.lit(None) if key is None else key).cast("string").alias("key"), flag.alias("flag"), F.lit(n).alias("n")
    )
    return told if when is None else F.when(is_true(when), told)


def _statements(rule: Rule) -> list[tuple[str, str, Column]]:
    """What the rows of each table tell about a rule, as (table, kind, statement)."""
    no = F.lit(False)
    if isinstance(rule, NotNull):
        return [(rule.table, _VIOLATES, _tells(None, no, 1, any_null(*rule.cols)))]
    if isinstance(rule, Holds):
        return [(rule.table, _VIOLATES, _tells(None, no, 1, ~is_true(F.expr(rule.condition))))]
    if isinstance(rule, Unique):
        return [(rule.table, _KEY, _tells(_key(*rule.cols), any_null(*rule.cols), 1))]
    child, parent = F.col(rule.col).isNotNull(), F.col(rule.parent_col).isNotNull()
    asked = is_true(F.expr(rule.where)) if rule.where else F.lit(True)
    told = [
        (rule.table, _CHILD, _tells(_key(rule.col), no, 1, asked & child)),
        (rule.parent, _PARENT, _tells(_key(rule.parent_col), F.lit(True), 0, parent)),
    ]
    if not rule.ignore_null:
        told.append((rule.table, _VIOLATES, _tells(None, no, 1, asked & ~child)))
    return told


def summarise(rules: Sequence[Rule], tables: Tables) -> DataFrame:
    """One row per rule with its number of violations, in one pass over each table.

    Every row tells what it knows: rules that it violates, keys that must be unique, keys
    that need a parent, keys that are one. Statements of all tables meet in one aggregate
    by rule and key, which takes the place of a grouping per constraint and a join per
    foreign key. They are combined before the shuffle, so a hot key sends one row per task;
    the rule is a number and the aggregate holds a flag and a count only, so that a row of
    it is little more than its key.
    """
    numbers = {name: i for i, name in enumerate(dict.fromkeys(rule.name for rule in rules))}
    told: dict[str, dict[tuple[str, str], Column]] = {}
    for rule in rules:
        for table, kind, statement in _statements(rule):
            told.setdefault(table, {})[rule.name, kind] = statement.withField("rule", F.lit(_number(numbers, rule.name, kind)))
    parts = [
        tables[table].select(F.explode(F.array(*said.values())).alias("s")).where("s IS NOT NULL").select("s.*")
        for table, said in told.items()
    ]
    by_key = reduce(DataFrame.unionAll, parts).groupBy("rule", "key").agg(F.max("flag").alias("flag"), F.sum("n").alias("n"))
    repeated = (F.col("flag") | (F.col("n") > 1)).cast("long")
    issues = F.when(F.col("rule") % 2 == 1, repeated).when(~F.col("flag"), F.col("n")).otherwise(0)
    counts = by_key.groupBy(F.floor(F.col("rule") / 2).alias("number")).agg(F.sum(issues).alias("issues"))
    spark = by_key.sparkSession
    names = spark.createDataFrame([(r.name, numbers[r.name]) for r in rules], "dq_rule string, number long")
    return names.join(counts, "number", "left").select("dq_rule", F.coalesce("issues", F.lit(0)).alias("issue_count"))


def _number(numbers: Mapping[str, int], name: str, kind: str) -> int:
    """A rule's number, odd where its keys must occur once."""
    return 2 * numbers[name] + (kind == _KEY)


_OUTCOME = "dq_rule string, issue_count bigint, validation_error string"


def check_rules(spark: SparkSession, rules: Sequence[Rule], tables: Tables) -> list[tuple[str, int, str | None]]:
    """(rule, issues, error) of every rule, a row of each reaching the driver.

    All rules that can be planned run as one job. A rule that cannot (its table or column is
    absent) is one issue with the reason. If the job fails, it is repeated apart for the rules
    with conditions of their own, which a row can make fail, and for the others, then with
    halves of those that still fail; so a rule that fails on some row is one issue too and the
    others still count (Q15), mostly by one more job.
    """
    failed: dict[str, str] = {}
    sound: list[Rule] = []
    for rule in rules:
        try:
            for table, _, statement in _statements(rule):
                tables[table].select(statement).schema  # analysis errors surface here
            sound.append(rule)
        except Exception as error:  # noqa: BLE001 - any failure is itself an issue
            failed[rule.name] = _reason(error)

    def counted(some: list[Rule]) -> dict[str, int]:
        try:
            return {r.dq_rule: r.issue_count for r in summarise(some, tables).collect()} if some else {}
        except Exception as error:  # noqa: BLE001 - find out which one it was
            if len(some) == 1:
                failed[some[0].name] = _reason(error)
                return {}
            frail = [r for r in some if isinstance(r, Holds) or getattr(r, "where", None)]
            if 0 < len(frail) < len(some):
                return counted([r for r in some if r not in frail]) | counted(frail)
            half = len(some) // 2
            return counted(some[:half]) | counted(some[half:])

    counts = counted(sound)
    return [(r.name, counts.get(r.name, 1), failed.get(r.name)) for r in rules]


def _reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}".splitlines()[0]


def missing_of(expected: Sequence[str], present: Sequence[str]) -> list[str]:
    """Expected tables or marts that are not there (Q14)."""
    return [name for name in expected if name not in set(present)]


def outcome_table(spark: SparkSession, outcomes: Sequence[tuple[str, int, str | None]]) -> DataFrame:
    """Outcomes of :func:`check_rules` as a table, failures with their reason."""
    return spark.createDataFrame(list(outcomes), _OUTCOME)


def check_primary_key(df: DataFrame, *cols: str) -> DataFrame:
    """Key values that are null or repeated."""
    return Unique("primary_key", "t", cols).issues({"t": df})


def check_foreign_key(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Fact rows whose non-null key is absent from the dimension."""
    return ForeignKey("foreign_key", "f", fk, "d", pk, ignore_null=True).issues({"f": fact, "d": dim})


def missing_counts(fact: DataFrame, links: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """One row: for each ``{name: (fk, dim, pk)}`` the fact rows without a member (Q16, Q17).

    The fact is reduced to its key combinations and their counts before the joins.
    """
    fks = list(dict.fromkeys(fk for fk, _, _ in links.values()))
    combos = fact.groupBy(*fks).agg(F.count("*").alias("__n"))
    for i, (fk, dim, pk) in enumerate(links.values()):
        members = dim.select(F.col(pk).alias(f"__k{i}")).dropna().distinct()
        combos = combos.join(members, F.col(fk) == F.col(f"__k{i}"), "left")
    return combos.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(f"__k{i}").isNull(), F.col("__n"))), F.lit(0)).alias(name)
            for i, name in enumerate(links)
        ]
    )


def null_key_counts(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One row of null counts, ``{output name: column}`` (Q18)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for n, c in names.items()])


def count_sheet(tables: Tables, label: str = "table_name", name: str = "row_count") -> DataFrame:
    """Row counts of several tables as one relation."""
    counts = [df.agg(F.lit(t).alias(label), F.count("*").alias(name)) for t, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def missing_names(spark: SparkSession, expected: Sequence[str], actual: DataFrame, col: str) -> DataFrame:
    """Expected names that are absent from a catalog listing (Q14)."""
    wanted = spark.createDataFrame([(n,) for n in expected], f"{col} string")
    return wanted.join(actual.select(col), col, "left_anti")


def guarded(spark: SparkSession, rule: str, check: Callable[[], DataFrame]) -> DataFrame:
    """The check's result, or one row that says why it could not run (Q15)."""
    try:
        found = check()
        found.schema  # analysis errors surface here
        return found.withColumn("dq_rule", F.lit(rule))
    except Exception as error:  # noqa: BLE001 - any failure is itself an issue
        return spark.createDataFrame([(f"{type(error).__name__}: {error}", rule)], "validation_error string, dq_rule string")
