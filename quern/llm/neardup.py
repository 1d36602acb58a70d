"""Problem 3: sessions that tell the same with small edits.

Method: prefix-tree join of globally ordered sets of word runs (``setjoin`` and
``trie``), then connected components of the links.

Records without three words are alike to none; repeated rows and equal sets of
runs are one class, so copies are never expanded into pairs before the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.components import connected_components
from quern.llm.overlap import THRESHOLD, WIDTH, session_text
from quern.llm.setjoin import similarity_join


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(groups: id, group; members with links: id, class, links).  rows: id,
    messages_json.  Ids in no group of two are left out of groups."""
    records = rows.where("id is not null").select(F.col("id").cast("string").alias("node"), F.lit(0).alias("side"), F.col("messages_json").alias("text"))
    members, links = similarity_join(records, session_text, width, threshold)
    members = members.drop("same")
    head = members.groupBy("class").agg(F.min("node").alias("head"))
    own = members.join(head, "class").select(F.col("node").alias("a"), F.col("head").alias("b"))
    across = links.join(head.withColumnsRenamed({"class": "a", "head": "x"}), "a").join(head.withColumnsRenamed({"class": "b", "head": "y"}), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    groups = connected_components(own.unionByName(across)).select(F.col("node").alias("id"), F.col("component").alias("group")).distinct()
    degree = links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class"))).groupBy("class").agg(F.count(F.lit(1)).alias("links"))
    counted = members.join(degree, "class", "left").groupBy(F.col("node").alias("id")).agg(F.min("class").alias("class"), F.sum(F.coalesce("links", F.lit(0))).alias("links"))
    return groups, counted


def duplicate_pairs(rows: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """id_a, id_b (id_a < id_b): all pairs of different ids of one group."""
    groups, _ = near_duplicates(rows, threshold, width)
    a, b = (groups.select("group", F.col("id").alias(f"id_{x}")) for x in "ab")
    return a.join(b, "group").where("id_a < id_b").select("id_a", "id_b")


def duplicate_groups(rows: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """One row per id: its group (its own id if alone), class of equal sets
    (null without a chance of a link) and number of links of its classes."""
    groups, counted = near_duplicates(rows, threshold, width)
    ids = rows.where("id is not null").select(F.col("id").cast("string").alias("id")).distinct()
    return ids.join(groups, "id", "left").join(counted, "id", "left").select("id", F.coalesce("group", "id").alias("group"), "class", F.coalesce("links", F.lit(0)).alias("links"))
