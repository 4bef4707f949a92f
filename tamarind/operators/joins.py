"""Equi-joins, orphan handling and skew-proof lookups."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = str | Sequence[str] | Mapping[str, str]

_RIGHT = "__right_"
_SALT = "__salt"


def key_map(on: Keys) -> dict[str, str]:
    """Join keys as {left name: right name}."""
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def attach(
    left: DataFrame, right: DataFrame, on: Keys, how: str = "left", *, null_safe: bool | Collection[str] = False
) -> DataFrame:
    """Join keeping the left key columns only.

    A null key matches nothing, unless ``null_safe`` (J13), which may name some of the left
    keys: sides dealt by one of the others meet without a shuffle. No broadcast hint is
    given: Spark broadcasts a side when its measured size allows, and splits hot
    partitions of the larger side otherwise.
    """
    keys = key_map(on)
    right = right.withColumnsRenamed({r: _RIGHT + r for r in keys.values()})
    pairs = [(F.col(a), F.col(_RIGHT + b)) for a, b in keys.items()]
    safe = set(null_safe if not isinstance(null_safe, bool) else keys if null_safe else ())
    condition = reduce(and_, [a.eqNullSafe(b) if k in safe else a == b for k, (a, b) in zip(keys, pairs)])
    joined = left.join(right, condition, how)
    return joined.drop(*[_RIGHT + r for r in keys.values()])


def with_parent(child: DataFrame, parent: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key exists in ``parent`` (J01, J10), never multiplied."""
    return attach(child, parent.select(*key_map(on).values()), on, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key does not exist in ``parent``; a null key is an orphan."""
    return attach(child, parent.select(*key_map(on).values()), on, "left_anti")


def flag_match(child: DataFrame, parent: DataFrame, on: Keys, flag: str) -> DataFrame:
    """All rows plus a boolean: does the key exist in ``parent``?"""
    known = parent.select(*key_map(on).values()).dropna().distinct().withColumn(flag, F.lit(True))
    return attach(child, known, on).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def split_by_parent(child: DataFrame, parent: DataFrame, on: Keys) -> tuple[DataFrame, DataFrame]:
    """(rows with a parent, orphans): drop-and-log policy (Q06)."""
    return with_parent(child, parent, on), orphans(child, parent, on)


def rekey_orphans(child: DataFrame, parent: DataFrame, on: Keys, unknown: str = "-1") -> DataFrame:
    """Orphan keys replaced by the unknown member (Q07); no ids reach the driver."""
    flagged = flag_match(child, parent, on, "__known")
    for left_key in key_map(on):
        flagged = flagged.withColumn(left_key, F.when(F.col("__known"), F.col(left_key)).otherwise(F.lit(unknown)))
    return flagged.drop("__known")


def full_merge(left: DataFrame, right: DataFrame, on: Sequence[str], fill: float | int | None = None) -> DataFrame:
    """Full outer join on common key names; ``fill`` replaces missing measures."""
    merged = left.join(right, list(on), "full")
    if fill is None:
        return merged
    return merged.fillna(fill, subset=[c for c in merged.columns if c not in on])


# More rows of one key than this are dealt out to several tasks, and so many hot keys are
# looked for; adaptive execution splits what lies beyond.
ROWS_PER_TASK = 2_000_000
MOST_HOT_KEYS = 10_000


def heavy_hashes(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> list[int]:
    """Hashes of the key values that hold more rows than one task should read.

    One streaming-sketch aggregate over the key columns, run while the plan is built: the
    list only steers the physical plan, so an estimate is enough, and at most
    ``MOST_HOT_KEYS`` hashes reach the driver.
    """
    top = F.expr(f"approx_top_k(h, {MOST_HOT_KEYS}, {20 * MOST_HOT_KEYS})")
    row = df.select(F.xxhash64(*keys).alias("h")).agg(top.alias("top")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] > rows_per_task]


def salted_attach(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "left",
    *,
    null_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    buckets: int = 64,
) -> DataFrame:
    """:func:`attach` whose hot keys are spread over ``buckets`` tasks.

    Rows of a hot key get a salt from a hash of the whole row (stable when a task
    is retried); only the matching rows on the right are repeated once per salt.
    Full copies of a row share a salt; adaptive execution splits what is left of
    them by map output, as in any other join. Cold keys join as usual. A null key matches
    nothing, unless ``null_safe``. ``how`` is inner or left: the left side is split.
    """
    if how not in ("inner", "left"):
        raise ValueError("only the left side is split, so the join must be inner or left")
    keys = key_map(on)
    hot = heavy_hashes(left, list(keys), rows_per_task)
    if not hot:
        return attach(left, right, on, how, null_safe=null_safe)

    def is_hot(cols: Sequence[str]) -> Column:
        return F.xxhash64(*cols).isin(hot)

    salt = F.when(is_hot(list(keys)), F.pmod(F.xxhash64(*left.columns), F.lit(buckets))).otherwise(F.lit(0))
    salts = F.when(is_hot(list(keys.values())), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    joined = attach(
        left.withColumn(_SALT, salt.cast("int")),
        right.withColumn(_SALT, F.explode(salts)),
        {**keys, _SALT: _SALT},
        how,
        null_safe=null_safe,
    )
    return joined.drop(_SALT)


def lookup_key(fact: DataFrame, dim: DataFrame, on: Keys, key: str, as_: str | None = None) -> DataFrame:
    """Surrogate key of a dimension by its natural key, null when absent."""
    keys = key_map(on)
    wanted = dim.select(*keys.values(), F.col(key).alias(as_ or key))
    return attach(fact, wanted, keys)
