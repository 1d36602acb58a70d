"""Connected components by alternating large and small stars.

Each round replaces every edge by edges to the least neighbour, with a
groupBy-min and a join; the edge list never grows and the rounds are
logarithmic in the longest chain.  Edges stay distributed and each round is
written to the shared folder, where only the last one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.shared import discard, materialize

#: Rounds after which an unfinished run is an error, far beyond the logarithm of any table.
MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        joined = down.join(least, "a")
        moved = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: any ordered type);
    the component is its least node.  Loops and repeated edges do no harm;
    without edges the result is empty."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        last, edges = edges, materialize(_star(_star(edges, True), False), "edges")
        before, state = state, _state(edges)
        discard(last)  # nothing reads an earlier round
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
