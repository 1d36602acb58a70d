"""Problem 6: documents into containers of one capacity.

Method: sum-of-squares packing.  With N(g) open containers of residual gap g, a
document goes where the sum of N(g) squared becomes smallest, be it an open
container or a new one; ties go to the least gap.  Larger documents are placed
first, and once the open containers have room for all that is left, new ones
are opened only for what fits nowhere.

Documents are packed in hash groups of about ``GROUP_ITEMS``, so no task holds
more, whatever the table's size.  A document above the capacity is cut into full
pieces and a rest; no other is.  Null and blank texts have no tokens and are in
no container.  Repeated rows of a doc_id count once.  Sizes are tokens.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.shared import materialize
from quern.llm.tokens import VOCABULARY, with_tokens

CAPACITY, GROUP_ITEMS = 2048, 50_000


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item; sizes are 1 to ``capacity``."""
    out = np.empty(len(sizes), dtype=np.int64)
    n = np.zeros(capacity + 1, dtype=np.int64)  # open containers by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    made, free, left = 0, 0, int(sizes.sum())
    for item in np.lexsort((np.arange(len(sizes)), -sizes)):
        s = int(sizes[item])
        gaps = np.flatnonzero(n[s:capacity]) + s
        rest = capacity - s
        fresh = 2 * n[rest] + 1 if rest else 0
        gap = capacity
        if len(gaps):
            after = gaps - s
            # A gap that is closed is no longer counted.
            change = 1 - 2 * n[gaps] + np.where(after == 0, 0, 2 * n[after] + 1)
            best = int(change.argmin())
            if change[best] <= fresh or free >= left:
                gap = int(gaps[best])
        if gap == capacity:
            bin_, made = made, made + 1
            free += capacity
        else:
            bin_ = by_gap[gap].pop()
            n[gap] -= 1
        out[item] = bin_
        if gap > s:
            n[gap - s] += 1
            by_gap[gap - s].append(bin_)
        free -= s
        left -= s
    return out


def _packer(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        bins = sum_of_squares(group.column("tokens").to_numpy().astype(np.int64), capacity)
        number = group.column("pack").to_numpy()
        return group.drop_columns(["pack"]).append_column("container", pa.array((number << 32) + bins))

    return pack


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, tokens, container of every piece.  documents:
    doc_id, text.  start: the piece's first token in its document."""
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    sized = with_tokens(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null"), vocabulary)
    sized = materialize(sized.where("tokens > 0").groupBy("doc_id").agg(F.max("tokens").alias("tokens")), "sizes")
    pieces = sized.select("doc_id", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / capacity).cast("int"))).alias("piece"), F.col("tokens").alias("whole"))
    pieces = pieces.withColumn("start", F.col("piece").cast("bigint") * capacity).withColumn("tokens", F.least(F.lit(capacity).cast("bigint"), F.col("whole") - F.col("start")))
    groups = max(1, math.ceil(sized.count() / GROUP_ITEMS))
    pieces = pieces.select("doc_id", "piece", "start", "tokens", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).alias("pack"))
    return pieces.groupBy("pack").applyInArrow(_packer(capacity), "doc_id bigint, piece int, start bigint, tokens bigint, container bigint")


def containers(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """container, items, tokens, room of every container."""
    placed = pack_documents(documents, capacity, vocabulary)
    return placed.groupBy("container").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens")).withColumn("room", F.lit(capacity) - F.col("tokens"))


def fill_report(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row: containers, least possible containers, tokens, share of room used
    (null without containers)."""
    total = containers(documents, capacity, vocabulary).agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return total.select("containers", F.ceil(F.col("tokens") / capacity).alias("least_containers"), "tokens", F.round(F.try_divide("tokens", F.col("containers") * capacity), 6).alias("fill"))
