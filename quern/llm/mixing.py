"""Problem 7: mixing sources to target shares.

Method: multivariate-hypergeometric splitting tree.  Each source's documents
lie in hash blocks; its quota of tokens is a number of whole passes over its
blocks and a part of one more pass, in permuted order.  The exact numbers of
blocks drawn of each source are split between the two halves of the output
shards by a multivariate hypergeometric draw, and so on down to single shards;
every shard takes its numbers from the permuted blocks, disjointly, and is
shuffled locally.

The total is by default the largest at which every source can give its share
within its repeats; a source without tokens can't at any total and is left out
of that, and where a total is asked for, sources give what they can.  A target
is met if the share reached is within ``TOLERANCE`` of it.

Only blocks, at most about ``MAX_PLAN`` drawn ones, reach the driver; documents
never do.  Blocks and shards grow with the table, and the last block of a quota
is cut in parts of about ``FILL_ROWS`` documents, so that no task holds more
than a shard's rows: whole parts are drawn in hash order, and of the next part
the documents that fit.  Documents of no target's source, and null and blank
texts, are not drawn.  Repeated rows of a doc_id count once; repeated targets
of one source are added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.core.labels import source_name
from quern.core.shared import materialize
from quern.llm.tokens import VOCABULARY, with_tokens

MAX_SOURCES, TOLERANCE = 1000, 0.01
#: Documents of a block where there are few, drawn blocks planned for on the
#: driver, blocks and tokens of a shard, documents of a part of a cut block.
BLOCK_DOCUMENTS, MAX_PLAN, SHARD_BLOCKS, SHARD_TOKENS, FILL_ROWS = 16, 200_000, 16, 1 << 20, 4096


def splitting_tree(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """How many of counts[s] blocks of each source go to each shard (shards x
    sources): columns add up to ``counts``, rows differ by one at most."""
    if shards == 1:
        return counts[None, :]
    left = shards // 2
    total = int(counts.sum())
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    taken = rng.multivariate_hypergeometric(counts, sum(sizes[:left])) if total else counts * 0
    return np.vstack([splitting_tree(taken, left, rng), splitting_tree(counts - taken, shards - left, rng)])


def _sized(documents: DataFrame, vocabulary: str) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), source_name(F.col("source")).alias("source"), "text").where("doc_id is not null and source is not null")
    return materialize(with_tokens(rows, vocabulary).where("tokens > 0").groupBy("doc_id").agg(F.min("source").alias("source"), F.max("tokens").alias("tokens")), "sizes")


def largest_total(facts: dict[str, tuple]) -> int:
    """The most tokens at which every source gives its share.  facts: share,
    repeats, documents, tokens by source."""
    return int(min((repeats * tokens / share for share, repeats, _, tokens in facts.values() if share > 0 and repeats * tokens > 0), default=0))


def draw_plan(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, shards: int | None = None, seed: int = 7, vocabulary: str = VOCABULARY) -> tuple[DataFrame, list[tuple], list[tuple], dict[str, tuple]]:
    """(documents with source, block and tokens; draws: source, block, pass,
    shard; cuts: source, block, pass, tokens left, parts, shard; facts by source)."""
    wanted = targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("bigint")).where("source is not null")
    wanted = wanted.groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("repeats")).orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sized = _sized(documents, vocabulary)
    have = {r["source"]: (r["n"], r["tokens"]) for r in sized.where(F.col("source").isin([r["source"] for r in wanted])).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")).collect()}
    facts = {r["source"]: (max(0.0, float(r["share"] or 0.0)), max(0, int(r["repeats"] or 0)), *have.get(r["source"], (0, 0))) for r in wanted}
    total = largest_total(facts) if total_tokens is None else int(total_tokens)
    facts = {s: (*f, int(round(f[0] * total))) for s, f in facts.items()}
    blocks = {s: _blocks(n, -(-min(quota, repeats * tokens) // tokens), len(facts)) for s, (_, repeats, n, tokens, quota) in facts.items() if tokens}
    spread = F.coalesce(*[F.when(F.col("source") == s, F.lit(b)) for s, b in sorted(blocks.items())], F.lit(None).cast("int")) if blocks else F.lit(None).cast("int")
    placed = sized.withColumn("blocks", spread).where("blocks is not null").withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("blocks")).cast("int")).drop("blocks")
    sums: dict[str, dict[int, tuple[int, int]]] = {}
    for r in placed.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")).collect():
        sums.setdefault(r["source"], {})[r["block"]] = (r["n"], r["tokens"])
    rng = np.random.default_rng(seed)
    drawn: dict[str, list[tuple[int, int, int | None]]] = {}
    for s, (_, repeats, _, available, quota) in sorted(facts.items()):
        list_, left, turn = [], min(quota, repeats * available), 0
        while left > 0 and available:
            for b in rng.permutation(sorted(sums[s])).tolist():
                size = sums[s][b][1]
                if left <= 0:
                    break
                list_.append((b, turn, None if size <= left else left))
                left -= size
            turn += 1
        drawn[s] = list_
    names = sorted(drawn)
    most = sum(map(len, drawn.values()))
    shards = shards or max(1, min(most // SHARD_BLOCKS, -(-sum(f[-1] for f in facts.values()) // SHARD_TOKENS)))
    split = splitting_tree(np.array([len(drawn[s]) for s in names], dtype=np.int64), shards, rng) if names else np.zeros((shards, 0), dtype=np.int64)
    draws, cuts = [], []
    for k, s in enumerate(names):
        order, at = rng.permutation(len(drawn[s])), 0
        for shard in range(shards):
            for i in order[at : at + int(split[shard, k])]:
                b, turn, left = drawn[s][i]
                if left is None:
                    draws.append((s, b, turn, shard))
                else:
                    cuts.append((s, b, turn, int(left), -(-sums[s][b][0] // FILL_ROWS), shard))
            at += int(split[shard, k])
    return placed, draws, cuts, facts


def _blocks(documents: int, passes: int, sources: int) -> int:
    """How many blocks a source's documents lie in."""
    return max(1, min(documents // BLOCK_DOCUMENTS, max(16, MAX_PLAN // (sources * max(1, passes)))))


def _fill(part: pa.Table) -> pa.Table:
    """The documents of a source's one cut part that fit in its rest of the
    quota, taken in hash order."""
    part = part.sort_by([("h", "ascending"), ("doc_id", "ascending")])
    left, keep = part.column("rest")[0].as_py(), []
    for k, size in enumerate(part.column("tokens").to_pylist()):
        if size <= left:
            keep.append(k)
            left -= size
    return part.take(pa.array(keep, pa.int64())).drop_columns(["rest", "h"])


def draw(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, shards: int | None = None, seed: int = 7, vocabulary: str = VOCABULARY) -> tuple[DataFrame, dict[str, tuple]]:
    """(drawn: shard, place, doc_id, source, pass, tokens; facts by source)."""
    spark = documents.sparkSession
    placed, draws, cuts, facts = draw_plan(documents, targets, total_tokens, shards, seed, vocabulary)
    columns = ["source", "block", "doc_id", "tokens", "pass", "shard"]
    # At most about MAX_PLAN draws, and one cut a source.
    whole = placed.join(F.broadcast(spark.createDataFrame(draws, "source string, block int, pass int, shard int")), ["source", "block"]).select(*columns)
    part = placed.join(F.broadcast(spark.createDataFrame(cuts, "source string, block int, pass int, quota bigint, parts int, shard int")), ["source", "block"])
    part = part.withColumn("h", F.xxhash64("doc_id", F.lit(seed + 1))).withColumn("part", F.pmod("h", F.col("parts")).cast("int"))
    sums: dict[str, list[tuple[int, int]]] = {}
    for r in part.groupBy("source", "part").agg(F.sum("tokens").alias("tokens")).orderBy("source", "part").collect():
        sums.setdefault(r["source"], []).append((r["part"], r["tokens"]))
    ends = []
    for s, _, _, left, parts, _ in cuts:
        end = parts
        for at, size in sums[s]:
            if size > left:
                end = at
                break
            left -= size
        ends.append((s, end, left))
    part = part.join(F.broadcast(spark.createDataFrame(ends, "source string, end int, rest bigint")), "source")
    rest = part.where("part = end").select(*columns, "rest", "h").groupBy("source").applyInArrow(_fill, "source string, block int, doc_id bigint, tokens bigint, pass int, shard int")
    both = whole.unionByName(part.where("part < end").select(*columns)).unionByName(rest.select(*columns))
    place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("doc_id", "pass", F.lit(seed + 2)), "doc_id", "pass"))
    return both.withColumn("place", place).select("shard", "place", "doc_id", "source", "pass", "tokens"), facts


def drawn_documents(documents: DataFrame, targets: DataFrame, **options) -> DataFrame:
    return draw(documents, targets, **options)[0]


def share_report(documents: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """Per target: documents and tokens there, quota, drawn documents, tokens
    and most uses of a document, target and reached share, whether it is met."""
    drawn, facts = draw(documents, targets, **options)
    spark = documents.sparkSession
    known = spark.createDataFrame([(s, *f) for s, f in sorted(facts.items())], "source string, target_share double, max_repeats bigint, documents bigint, available_tokens bigint, quota bigint")
    got = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("draws"), F.sum("tokens").alias("drawn_tokens"), (F.max("pass") + 1).cast("bigint").alias("most_uses"))
    zero = {"draws": 0, "drawn_tokens": 0, "most_uses": 0}
    out = known.join(got, "source", "left").fillna(zero)
    all_tokens = F.sum("drawn_tokens").over(Window.partitionBy(F.lit(1)))  # at most MAX_SOURCES rows
    reached = F.when(all_tokens > 0, F.col("drawn_tokens") / all_tokens).otherwise(0.0)
    out = out.withColumn("met", F.abs(reached - F.col("target_share")) <= TOLERANCE * F.col("target_share")).withColumn("reached_share", F.round(reached, 6))
    return out.select(*(c for c in out.columns if c != "met"), "met")
