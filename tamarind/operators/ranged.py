"""Global order without a single-task window.

``row_number() over (order by ...)`` moves the table to one task, and a lag over a
hot key moves that key's rows to one task. Both only need *neighbours* and *offsets*.

Surrogate keys are numbered on the *key table*: only the distinct natural keys are
range-partitioned, sorted and stored, with their number of rows; prefix sums over the
partitions' totals turn places into global numbers, which are joined back to the rows.
Wide rows are never sorted and never written.

Where rows themselves have to be in order (a lag, the copies of a hot key), they are
range-partitioned on a total order and frozen by a reliable checkpoint. The checkpoint
matters: range borders are sampled, and an offset is only valid for the very partitions
it was counted on, also after an executor is lost. What crosses a partition border is
one row per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.operators.joins import attach
from tamarind.session import by_buckets, ready_for_checkpoints, scratch_path, stored
from tamarind.sources.tables import bucketed_table

# monotonically_increasing_id() puts the partition number above this bit and the
# position within the partition below it.
_POSITION_BITS = 33
_AT, _PART, _COPY = "__at", "__part", "__copy"


def _frozen(df: DataFrame, order: Sequence[str], distinct: bool) -> DataFrame:
    """Rows range-partitioned and sorted by ``order`` (then all other columns),
    checkpointed, with their global position encoded in ``__at``.

    Range borders cannot part rows that are equal in every column. Unless the caller
    knows the rows to be ``distinct``, they get a running id as last sort column, so
    that a large group of copies is spread as well. The id is taken from a first
    checkpoint, because it must not change when a task is retried.
    """
    return _placed_rows(_in_order(df, order, distinct).checkpoint())


def _in_order(df: DataFrame, order: Sequence[str], distinct: bool) -> DataFrame:
    ready_for_checkpoints(df.sparkSession)
    total = [*order, *[c for c in df.columns if c not in order]]
    if not distinct:
        df = df.checkpoint().withColumn(_COPY, F.monotonically_increasing_id())
        total.append(_COPY)
    return df.repartitionByRange(*total).sortWithinPartitions(*total).drop(_COPY)


def _placed_rows(ranged: DataFrame) -> DataFrame:
    return ranged.withColumn(_AT, F.monotonically_increasing_id()).withColumn(
        _PART, F.shiftright(F.col(_AT), _POSITION_BITS)
    )


def _stored_by_part(df: DataFrame, order: Sequence[str], distinct: bool) -> DataFrame:
    """As :func:`_frozen`, in a table whose buckets are the partitions: what is done per
    partition afterwards needs no shuffle. There are more buckets than partitions, so that
    few of them share one."""
    spark = df.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bucketed_table(_placed_rows(_in_order(df, order, distinct)), scratch_path(spark, "ranged"), [_PART], buckets, [_AT])


def _position() -> Column:
    return F.col(_AT) - F.shiftleft(F.col(_PART), _POSITION_BITS)


# Partitions whose totals one task sums up; the sums of so many go to the next level.
_FAN_IN = 1_000
# More rows of one key than this are numbered by ranges of rows instead of in one task.
ROWS_PER_KEY = 1_000_000
_N, _FIRST, _OWN = "__n", "__first", "__own"


def _starts(totals: DataFrame, parts: int) -> DataFrame:
    """Rows before each of so many partitions, from (__part, __n). Beyond ``_FAN_IN``
    partitions, groups of them are summed up first, so that no task adds up more than that
    many partitions or their groups' sums."""
    if parts <= _FAN_IN:
        before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(_PART, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias("__offset"))
    grouped = totals.withColumn("__group", F.floor(F.col(_PART) / _FAN_IN))
    groups = grouped.groupBy("__group").agg(F.sum(_N).alias("__all"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("__group", F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy("__group").orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    local = grouped.withColumn("__local", F.coalesce(F.sum(_N).over(within), F.lit(0)))
    offsets = local.join(bases, "__group").select(_PART, (F.col("__base") + F.col("__local")).alias("__offset"))
    return stored(offsets, "starts")


def _placed(keys: DataFrame, order: Sequence[str]) -> DataFrame:
    """Distinct keys, and what is beside them, in global order, stored with their partition and place in it."""
    laid = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn(_AT, F.monotonically_increasing_id())
    return stored(laid, "keys").withColumn(_PART, F.shiftright(F.col(_AT), _POSITION_BITS))


def _parts(placed: DataFrame) -> int:
    """Partitions that a stored frame was written with: one file each, none if empty."""
    return len(placed.inputFiles())


def number_keys(keys: DataFrame, order: Sequence[str], name: str, carried: Sequence[str] = ()) -> DataFrame:
    """The distinct keys with ``name``: 1..n without gaps, in their order, and with the
    ``carried`` columns."""
    placed = _placed(keys.select(*order, *carried), order)
    starts = _starts(placed.groupBy(_PART).agg(F.count("*").alias(_N)), _parts(placed))
    number = F.col("__offset") + _position() + 1
    return placed.join(starts, _PART).select(*order, number.cast("long").alias(name), *carried)


def dense_key_of(
    df: DataFrame, order: Sequence[str], name: str, source: DataFrame | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """Add ``name``: 1..n in the order of a natural key that is unique in ``df``.

    ``source`` may name a stored frame with the same keys, one row each; then what ``df``
    is made of is not computed for the numbering. Its ``carried`` columns come along.
    """
    numbers = number_keys(source if source is not None else df, order, name, carried)
    return attach(df, numbers, order, null_safe=True).select(name, *df.columns, *carried)


def dense_key_within(
    df: DataFrame, order: Sequence[str], name: str, source: DataFrame | None = None, rows_per_key: int = ROWS_PER_KEY
) -> DataFrame:
    """As :func:`dense_key_of`, for rows that lie in buckets of the first column of their key:
    only the values of that column are numbered and moved, each with its number of rows, and
    its rows are counted where they lie. If one has more than ``rows_per_key`` rows, whole keys
    are numbered by ranges.
    """
    first, *rest = order
    rows = source if source is not None else df
    placed = _placed(rows.groupBy(first).agg(F.count("*").alias(_N)), [first])
    if not placed.where(F.col(_N) > rows_per_key).isEmpty():
        return dense_key_of(df, order, name, source)
    joined = attach(df, by_buckets(_firsts(placed).select(first, _FIRST), [first]), first)
    # a missing value comes before all others, so no rows come before its own
    among = F.row_number().over(Window.partitionBy(first).orderBy(*(rest or [first])))
    return joined.select((F.coalesce(_FIRST, F.lit(0)) + among).cast("long").alias(name), *df.columns)


def _firsts(placed: DataFrame) -> DataFrame:
    """Keys that were placed with their number of rows, with the rows before each of them."""
    before = Window.partitionBy(_PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    starts = _starts(placed.groupBy(_PART).agg(F.sum(_N).alias(_N)), _parts(placed))
    counted = placed.withColumn(_FIRST, F.coalesce(F.sum(_N).over(before), F.lit(0))).join(starts, _PART)
    return counted.withColumn(_FIRST, F.col("__offset") + F.col(_FIRST))


def dense_key(
    df: DataFrame, order: Sequence[str], name: str, *, distinct: bool = False, rows_per_key: int = ROWS_PER_KEY
) -> DataFrame:
    """Add ``name``: 1..n without gaps, in the order of ``order``, then of all other
    columns. Pass ``distinct`` when no row is a full copy of another.

    The key table holds the rows per key; a key's rows are numbered among themselves next
    to it. Keys of more than ``rows_per_key`` rows are numbered by ranges of their rows.
    """
    order = list(order)
    rest = [c for c in df.columns if c not in order]
    placed = _placed(df.groupBy(*order).agg(F.count("*").alias(_N)), order)
    keys = _firsts(placed).select(*order, _N, _FIRST)
    among = Window.partitionBy(*order).orderBy(*(rest or order))
    upto = among.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (F.col(_FIRST) + F.count(F.lit(1)).over(upto)).cast("long").alias(name)
    if placed.where(F.col(_N) > rows_per_key).isEmpty():
        return attach(df, keys.drop(_N), order, null_safe=True).select(found, *df.columns)
    joined = attach(df, keys, order, null_safe=True)
    cold = joined.where(F.col(_N) <= rows_per_key).select(found, *df.columns)
    hot = joined.where(F.col(_N) > rows_per_key).drop(_N)
    return cold.unionAll(_by_ranges(hot, order, name, distinct).select(name, *df.columns))


def _by_ranges(rows: DataFrame, order: list[str], name: str, distinct: bool) -> DataFrame:
    """Numbers of rows of hot keys. Among themselves they are numbered by range; a key's
    first such number leads back to the key's own first number."""
    frozen = _frozen(rows, order, distinct)
    starts = _starts(frozen.groupBy(_PART).agg(F.count("*").alias(_N)), frozen.rdd.getNumPartitions())
    numbered = frozen.join(starts, _PART).withColumn(_OWN, F.col("__offset") + _position())
    firsts = numbered.groupBy(*order).agg(F.min(_OWN).alias("__least"))
    both = attach(numbered, firsts, order, null_safe=True)
    return both.withColumn(name, (F.col(_FIRST) + F.col(_OWN) - F.col("__least") + 1).cast("long"))


def ordered_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lagged: Mapping[str, str],
    *,
    distinct: bool = False,
) -> DataFrame:
    """Add ``{new name: column}`` holding the previous row's value within the key.

    Inside a partition this is an ordinary lag. The first row of a partition takes
    the last row of the partition before it when both have the same key; these last
    rows, one per partition, are all that is moved once the rows are stored.
    """
    rows = _stored_by_part(df, [*keys, *order], distinct)
    inner = Window.partitionBy(_PART, *keys).orderBy(_AT)
    carried = F.struct(
        F.struct(*keys).alias("key"), F.struct(*[F.col(c).alias(new) for new, c in lagged.items()]).alias("values")
    )
    tails = rows.groupBy(_PART).agg(F.max_by(carried, F.col(_AT)).alias("__tail"))
    borders = tails.select(_PART, F.lag("__tail").over(Window.orderBy(_PART)).alias("__border"))
    bordered = rows.withColumns({new: F.lag(c).over(inner) for new, c in lagged.items()}).join(borders, _PART)
    continues = (_position() == 0) & F.col("__border.key").eqNullSafe(F.struct(*keys))
    return bordered.select(
        *df.columns,
        *[F.when(continues, F.col(f"__border.values.{new}")).otherwise(F.col(new)).alias(new) for new in lagged],
    )
