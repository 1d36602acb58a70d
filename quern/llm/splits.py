"""Problem 1: splits that keep the records of a task together.

Method: min-cost flow allocation.  Records form components by task key;
components of one size and label profile (records per declared split) are one
bundle; bundles and split quotas make a transport network whose costs are the
records moved away from their declared split and the deviation from the quotas;
the flow is rounded to whole components and members are taken by hash rank.

A null or unusable key makes a component of the record's id; an id delivered
under several keys joins their tasks.  Only bundles reach the driver, all of
them with their exact sizes and label profiles at any size of the input: n
records have about n ** 0.8 bundles at most, were there one of each.  How the
plan is joined and members are ranked grows with the input, what they give
does not depend on it.  An empty table gives an empty result; shares are scaled to sum 1.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.core.labels import SPLITS, split_name, task_key
from quern.core.shared import materialize
from quern.llm.components import connected_components

#: Most bundles whose plan is joined by broadcast; that of more is joined by a
#: shuffle, with the same result.  Components of at least total / HOT_PARTS
#: records, of which there are at most HOT_PARTS, are joined by broadcast.
MAX_BUNDLES, HOT_PARTS = 20_000, 10_000
#: Cost of a record beyond its split's quota, against 1 for a record moved.
DEVIATION = 16.0
#: Components within this factor of the largest left are rounded at once.
ROUND_STEP = 4
#: Most splits; more are an error.
MAX_SPLITS = 64
#: Components per rank window.
RANK_ROWS = 100_000
_PROFILE = [f"in_{s}" for s in SPLITS]


def components(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records: id, component; components: component, records, in_train,
    in_validation, in_test).  rows: id, task_group_key, split.  Repeated rows
    count once.  in_*: distinct ids declared for the split.  An id with several
    keys joins all their tasks."""
    keyed = rows.where("id is not null").select(F.col("id").cast("string").alias("id"), task_key(F.col("task_group_key")).alias("key"), split_name(F.col("split")).alias("split"))
    flags = [F.max(F.when(F.col("split") == s, 1).otherwise(0)).alias(f"in_{s}") for s in SPLITS]
    by_id = keyed.groupBy("id").agg(F.min("key").alias("key"), F.max("key").alias("also"), *flags)
    several = by_id.where("key <> also").select("id", F.col("key").alias("a"))
    edges = keyed.where("key is not null").select("id", F.col("key").alias("b")).join(several, "id").where("a <> b").select("a", "b")
    joined = connected_components(edges).withColumnsRenamed({"node": "key", "component": "root"})
    by_id = by_id.join(joined, "key", "left").withColumn("key", F.coalesce("root", "key"))
    records = by_id.select("id", F.coalesce("key", F.concat(F.lit("id:"), "id")).alias("component"), *_PROFILE)
    groups = records.groupBy("component").agg(F.count(F.lit(1)).alias("records"), *(F.sum(c).alias(c) for c in _PROFILE))
    return records.select("id", "component"), groups


def leaking_ids(rows: DataFrame) -> DataFrame:
    """id of every record whose task has rows declared for two splits or more.

    The allocation's own components and bundles tell where to look: the records
    of a bundle that is declared for more than one split, whichever of them is
    assigned, have to move.  An exact check of their tasks follows, since a
    component may hold several tasks that an id joins."""
    records, groups = components(rows)
    torn = groups.where(" + ".join(f"cast({c} > 0 as int)" for c in _PROFILE) + " > 1")
    within = records.join(torn.select("component"), "component", "left_semi").select("id")
    keyed = rows.where("id is not null").select(F.col("id").cast("string").alias("id"), task_key(F.col("task_group_key")).alias("key"), split_name(F.col("split")).alias("split")).where("key is not null")
    keyed = keyed.join(within, "id", "left_semi").groupBy("id", "key").agg(*(F.max(F.when(F.col("split") == s, 1).otherwise(0)).alias(f"in_{s}") for s in SPLITS))
    tasks = keyed.groupBy("key").agg(*(F.max(c).alias(c) for c in _PROFILE)).where(" + ".join(_PROFILE) + " > 1")
    return keyed.join(tasks.select("key"), "key", "left_semi").select("id").distinct()


def quotas(total: int, shares: dict[str, float]) -> dict[str, int]:
    """Whole numbers with sum ``total`` in the given shares, by largest remainder."""
    whole = sum(shares.values()) or 1.0
    exact = {s: total * x / whole for s, x in shares.items()}
    out = {s: math.floor(x + 1e-9) for s, x in exact.items()}
    for s in sorted(shares, key=lambda s: (out[s] - exact[s], s))[: total - sum(out.values())]:
        out[s] += 1
    return out


def transport(supply: np.ndarray, cost: np.ndarray, quota: np.ndarray) -> np.ndarray:
    """Least-cost flow (sources x sinks) of all supplies into sinks of the given
    quotas, beyond which a unit costs DEVIATION more.  Successive shortest
    paths; as the sinks are few, a path is sought among sinks only, over the
    cheapest source to shift between each two of them, kept in a heap for each
    two."""
    sources, sinks = cost.shape
    flow, used = np.zeros((sources, sinks)), np.zeros(sinks)
    heaps: list[list[list]] = [[[] for _ in range(sinks)] for _ in range(sinks)]
    where = range(sinks)

    def held(b: int, s: int) -> None:
        for t in where:
            if t != s:
                heapq.heappush(heaps[s][t], (cost[b, t] - cost[b, s], b))

    for b in range(sources):
        left = float(supply[b])
        while left > 1e-9:
            shift, by = [[math.inf] * sinks for _ in where], [[0] * sinks for _ in where]
            for s in where:
                for t in where:
                    heap = heaps[s][t]
                    while heap and flow[heap[0][1], s] <= 1e-9:
                        heapq.heappop(heap)
                    if heap:
                        shift[s][t], by[s][t] = heap[0]
            dist, came = cost[b].tolist(), [-1] * sinks
            for _ in where:
                for s in where:
                    for t in where:
                        if dist[s] + shift[s][t] < dist[t] - 1e-12:
                            dist[t], came[t] = dist[s] + shift[s][t], s
            end = int(np.argmin(np.array(dist) + np.where(used < quota - 1e-9, 0.0, DEVIATION)))
            path = [end]
            while came[path[-1]] >= 0 and len(path) <= sinks:
                path.append(came[path[-1]])
            path.reverse()
            push = min([left, *([quota[end] - used[end]] if used[end] < quota[end] - 1e-9 else []), *(flow[by[s][t], s] for s, t in zip(path, path[1:]))])
            moves = [(by[s][t], s, t) for s, t in zip(path, path[1:])]
            flow[b, path[0]] += push
            held(b, path[0])
            for x, s, t in moves:
                flow[x, s] -= push
                flow[x, t] += push
                held(x, t)
            used[end] += push
            left -= push
    return flow


def allocate(bundles: list[tuple], shares: dict[str, float]) -> list[list[int]]:
    """Components of each bundle for each split, in the order of ``shares``.
    bundles: (size, records declared for each split ..., components).  The flow
    of all bundles is rounded from the largest components down: those within a
    factor ROUND_STEP of the largest left take their whole part of the flow, what
    is cut is placed at the least cost, and the flow of the rest is solved again."""
    names = list(shares)
    total = round(sum(b[0] * b[-1] for b in bundles))
    quota = np.array([quotas(total, shares)[s] for s in names], dtype=float)
    take = [[0] * len(names) for _ in bundles]
    cost = np.array([[1.0 - min(1.0, b[1 + k] / max(1, b[0])) for k in range(len(names))] for b in bundles])
    left = quota.copy()

    def place(i: int) -> None:
        size = bundles[i][0]
        k = int(np.argmin(np.maximum(0, size - np.maximum(left, 0)) * DEVIATION + size * cost[i] - 1e-6 * left))
        take[i][k] += 1
        left[k] -= size

    rest = sorted(range(len(bundles)), key=lambda i: -bundles[i][0])
    while rest:
        supply = np.array([bundles[i][0] * bundles[i][-1] for i in rest], dtype=float)
        room = np.maximum(left, 0)
        room = np.array([quotas(round(supply.sum()), dict(zip(names, room)))[s] for s in names], dtype=float) if room.sum() else room
        flow = transport(supply, cost[rest], room)
        large = [i for i in rest if bundles[i][0] * ROUND_STEP > bundles[rest[0]][0]]
        for i, f in zip(large, flow):
            for k in range(len(names)):
                n = int((f[k] + 1e-6) // bundles[i][0])
                take[i][k] += n
                left[k] -= n * bundles[i][0]
        for i in large:
            for _ in range(bundles[i][-1] - sum(take[i])):
                place(i)
        rest = rest[len(large) :]
    return take


def assign_splits(rows: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """id, component, split for every id of ``rows`` (id, task_group_key,
    split); targets: split, share (a row for each split)."""
    spark = rows.sparkSession
    shares = {r["split"]: float(r["share"] or 0) for r in targets.groupBy("split").agg(F.sum("share").alias("share")).orderBy("split").where("split is not null").limit(MAX_SPLITS + 1).collect()}
    if len(shares) > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits")
    records, groups = components(rows)
    records, groups = materialize(records, "records"), materialize(groups, "components")
    have = [f"in_{s}" for s in shares if f"in_{s}" in groups.columns]
    key = ["records", *have]
    solved = [tuple(r) for r in groups.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).orderBy(*key).collect()]
    width = [have.index(f"in_{s}") if f"in_{s}" in have else None for s in shares]
    take = allocate([(b[0], *(b[1 + w] if w is not None else 0 for w in width), b[-1]) for b in solved], shares)
    plan = [(*b[:-1], s, sum(t[:k]), sum(t[: k + 1])) for b, t in zip(solved, take) for k, s in enumerate(shares) if t[k]]
    plan_df = spark.createDataFrame(plan, "".join(f"{c} bigint, " for c in key) + "assigned string, lo bigint, hi bigint")
    # Rank by hash within a bundle, from counts per range of hashes, so that no window holds a whole bundle;
    # ranges follow each other as hashes do, so the rank is the same with any number of them.
    buckets = max(1, math.ceil(sum(b[-1] for b in solved) / RANK_ROWS))
    hashed = groups.select("component", *key).withColumn("h", F.xxhash64("component", F.lit(seed)))
    hashed = hashed.withColumn("bucket", F.shiftright((F.shiftright("h", 33) + F.lit(1 << 30)) * F.lit(buckets), 31))
    before = hashed.groupBy(*key, "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.withColumn("before", F.sum("n").over(Window.partitionBy(*key).orderBy("bucket")) - F.col("n"))
    spans = before.join(F.broadcast(plan_df) if len(solved) <= MAX_BUNDLES else plan_df, key).where("lo < before + n and hi > before")
    spans = spans.select(*key, "bucket", "assigned", (F.col("lo") - F.col("before")).alias("lo"), (F.col("hi") - F.col("before")).alias("hi"))
    ranked = hashed.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "bucket").orderBy("h", "component")))
    chosen = ranked.join(spans, [*key, "bucket"]).where("rank > lo and rank <= hi").select("component", "records", F.col("assigned").alias("split"))
    chosen = materialize(chosen, "assigned")
    least_hot = max(2, math.ceil(sum(b[0] * b[-1] for b in solved) / HOT_PARTS))
    hot = F.broadcast(chosen.where(F.col("records") >= least_hot).select("component", "split"))
    cold = records.join(hot, "component", "left_anti").join(chosen.where(F.col("records") < least_hot).select("component", "split"), "component")
    return records.join(hot, "component").unionByName(cold).select("id", "component", "split")


def split_report(rows: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """Per split: records, components, share reached, target, records moved from
    their declared split."""
    done = assign_splits(rows, targets, seed)
    declared = rows.where("id is not null").groupBy(F.col("id").cast("string").alias("id")).agg(*(F.max(F.when(split_name(F.col("split")) == s, 1).otherwise(0)).alias(f"in_{s}") for s in SPLITS))
    moved = F.lit(False)
    for s in SPLITS:
        moved = F.when(F.col("split") == s, (F.col(f"in_{s}") == 0) & (F.greatest(*_PROFILE) > 0)).otherwise(moved)
    per = done.join(declared, "id").withColumn("moved", moved.cast("int")).groupBy("split", "component").agg(F.count(F.lit(1)).alias("records"), F.sum("moved").alias("moved"))
    per = per.groupBy("split").agg(F.sum("records").alias("records"), F.count(F.lit(1)).alias("components"), F.sum("moved").alias("moved"))
    whole = F.sum("records").over(Window.partitionBy(F.lit(1)))  # a row for each split
    return per.join(targets.groupBy("split").agg(F.sum("share").alias("target_share")), "split", "full").withColumn("whole", whole).select("split", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("components", F.lit(0)).alias("components"), F.coalesce("moved", F.lit(0)).alias("moved"), "target_share", F.round(F.coalesce("records", F.lit(0)) / F.col("whole"), 6).alias("share"))
