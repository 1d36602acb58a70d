"""Problem 2: records of evaluation splits that also occur in training.

Method: records are canonicalised (roles but system, case, punctuation and white
space put aside) and hashed, and evaluation hashes are joined with training
hashes: of whole records for the same, of three-word runs for the almost same.
Matches are counted by split and source.  The join and its bounds are in
``setjoin``.

Null, blank and cut-off messages, records without a letter or digit and labels
that are no split match nothing; repeated rows count once; an id on both sides
is not paired with itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.jsonio import content_text, load_list
from quern.core.labels import source_name, split_name
from quern.llm.setjoin import similarity_join

#: Words of a run and least share of runs in common, from the statement of the problem.
WIDTH, THRESHOLD = 3, 0.5


def session_text(messages_json: str | None) -> str:
    """Texts of the messages other than role system, joined by newlines."""
    return "\n".join(content_text(m.get("content")) for m in load_list(messages_json) if isinstance(m, dict) and m.get("role") != "system")


def overlap_join(rows: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(members: node, side, class, same; links: a, b, shared) of evaluation records
    (side 1) with training records (side 0).  rows: id, source_split, messages_json."""
    side = F.when(split_name(F.col("source_split")) == "train", 0).when(split_name(F.col("source_split")).isNotNull(), 1)
    records = rows.select(F.col("id").alias("node"), side.alias("side"), F.col("messages_json").alias("text")).where("side is not null")
    return similarity_join(records, session_text, width, threshold, two_sides=True)


def overlap_pairs(rows: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """id_a, id_b (id_a < id_b): a training and an evaluation id with the same
    or alike rows."""
    members, links = overlap_join(rows, threshold, width)
    train = members.where("side = 0").select(F.col("node").alias("x"), F.col("class").alias("a"), "same")
    other = members.where("side = 1").select(F.col("node").alias("y"), F.col("class").alias("b"), "same")
    same = train.drop("a").join(other.drop("b"), "same").select("x", "y")
    alike = links.join(train.drop("same"), "a").join(other.drop("same"), "b").select("x", "y")
    return same.unionByName(alike).where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def overlap_report(rows: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """Per evaluation split and source_dataset: distinct record ids, those whose
    whole record is in training, those alike (the same included), and the share.
    One training match of another id is enough, so no pairs are expanded."""
    members, links = overlap_join(rows, threshold, width)

    def hits(matches: DataFrame, key: str, strength: int) -> DataFrame:
        # A group has a training id other than y unless its only id is y.
        evaluated = members.where("side = 1").select(F.col("node").alias("id"), F.col("same" if key == "same" else "class").alias(key))
        return evaluated.join(matches, key).where("least <> id or most <> id").select("id", F.lit(strength).alias("strength"))

    ends = [F.min("node").alias("least"), F.max("node").alias("most")]
    train = members.where("side = 0")
    alike = links.select("a", "b").join(train.groupBy(F.col("class").alias("a")).agg(*ends), "a")
    both = hits(train.where("same is not null").groupBy("same").agg(*ends), "same", 2).unionByName(hits(alike, "b", 1))
    both = both.groupBy("id").agg(F.max("strength").alias("strength"))
    known = rows.select("id", split_name(F.col("source_split")).alias("source_split"), F.coalesce(source_name(F.col("source_dataset")), F.lit("")).alias("source_dataset")).where("source_split in ('validation', 'test')").distinct()
    counts = known.join(both, "id", "left").groupBy("source_split", "source_dataset").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("strength") == 2).alias("same"), F.count("strength").alias("alike"))
    return counts.withColumn("alike_share", F.round(F.col("alike") / F.col("records"), 6))
