"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import stored


# So few edges are finished in one task: a bound, about 2 MB, whatever the input.
FINISHED_AT_ONCE = 100_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of the edges of one task by union-find."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = node = parent[parent[node]]
        return node

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    columns = [pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["node", "component"])


def _order(node: Column, turn: int) -> Column:
    """Stars that hang on their smallest node vanish in plain order; long chains shrink
    by a constant factor in a random one. The turns take both."""
    return node if turn < 2 or turn % 2 else F.xxhash64(node, F.lit(turn))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); components are named after
    one of their nodes.

    In each turn every node joins its first neighbour, or stays if it is first itself,
    and the edges are rewritten to what their ends have joined. A hub only ever meets
    others in combinable minima and in joins that adaptive execution splits. The edges
    shrink by a factor with each turn; once there are ``FINISHED_AT_ONCE`` at most, one
    task does the rest. The driver learns no more than how many edges are left.
    """
    edges = stored(edges.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "edges")
    levels: list[DataFrame] = []
    while (left := edges.count()) > FINISHED_AT_ONCE:
        turn = len(levels)
        both = edges.select("a", "b").union(edges.select("b", "a"))
        first = both.groupBy("a").agg(
            F.min_by("b", _order(F.col("b"), turn)).alias("b"), F.min(_order(F.col("b"), turn)).alias("order")
        )
        joined = F.when(F.col("order") < _order(F.col("a"), turn), F.col("b")).otherwise(F.col("a"))
        levels.append(stored(first.select(F.col("a").alias("node"), joined.alias("component")), "level"))
        new_a, new_b = (levels[-1].toDF(end, f"new_{end}") for end in ("a", "b"))
        rewritten = edges.join(new_a, "a").join(new_b, "b").where("new_a <> new_b")
        edges = stored(rewritten.selectExpr("least(new_a, new_b) AS a", "greatest(new_a, new_b) AS b").distinct(), "edges")
    if left or not levels:
        levels.append(stored(edges.coalesce(1).mapInArrow(_forest, "node bigint, component bigint"), "level"))
    found = levels[0]
    for level in levels[1:]:
        onward = level.toDF("component", "onward")
        found = found.join(onward, "component", "left").select(
            "node", F.coalesce("onward", "component").alias("component")
        )
    return found
