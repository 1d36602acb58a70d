"""Queries of the training-data problems, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.core.labels import source_name
from quern.llm import abuse, mixing, neardup, overlap, packing, pieces, splits
from quern.llm.oracles import oracle_sql  # noqa: F401


def _table(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*columns) if columns else df


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.leaking_ids(_table(spark, d, "trajectories", "id", "task_group_key", "split"))


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(_table(spark, d, "trajectories", "id", "task_group_key", "split"), _table(spark, d, "split_targets"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_report(_table(spark, d, "trajectories", "id", "task_group_key", "split"), _table(spark, d, "split_targets"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_pairs(_table(spark, d, "training_rows", "id", "source_split", "messages_json"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_report(_table(spark, d, "training_rows", "id", "source_split", "source_dataset", "messages_json"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_pairs(_table(spark, d, "trajectories", "id", "messages_json"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_groups(_table(spark, d, "trajectories", "id", "messages_json"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces.oversized(_table(spark, d, "trajectories", "id", "messages_json", "message_loss_mask"))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.cut_sessions(_table(spark, d, "trajectories", "id", "messages_json", "message_loss_mask"))


def p6_placements(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(_table(spark, d, "documents", "doc_id", "text"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(_table(spark, d, "documents", "doc_id", "text"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_table(spark, d, "documents", "doc_id", "text"))


def p7_drawn(spark: SparkSession, d: str) -> DataFrame:
    return mixing.drawn_documents(_table(spark, d, "documents", "doc_id", "source", "text"), _table(spark, d, "mix_targets"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(_table(spark, d, "documents", "doc_id", "source", "text"), _table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse.abusive_documents(_table(spark, d, "documents", "doc_id", "text"), _table(spark, d, "review_labels"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rate_report(_table(spark, d, "documents", "doc_id", "source", "text"), _table(spark, d, "review_labels"))


def p1_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Every task with its records and the splits they are in: always one."""
    done = p1_splits(spark, d).where("not startswith(component, 'id:')")
    return done.groupBy(F.col("component").alias("task")).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("split").alias("splits"))


def p5_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Every cut session: the characters its pieces give without what they
    repeat, whether all are within the limit, and whether all but the first
    repeat exactly the overlap."""
    parts = pieces.cut_sessions(_table(spark, d, "trajectories", "id", "messages_json", "message_loss_mask"), with_text=False)
    size = parts.groupBy("id", "variant", "piece").agg(F.sum(F.col("end") - F.col("start")).alias("chars"), F.sum("repeated").alias("repeated"))
    whole = size.groupBy("id", "variant").agg(F.sum(F.col("chars") - F.col("repeated")).alias("chars"), (F.max("chars") <= pieces.LIMIT).alias("within"), F.bool_and(F.col("repeated") == F.when(F.col("piece") > 0, pieces.OVERLAP).otherwise(0)).alias("overlaps"))
    return whole.select("id", "chars", "within", "overlaps").distinct()


def p6_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every document in containers: whether its pieces follow each other without
    gaps, all full but the last, in containers within their capacity."""
    placed = packing.pack_documents(_table(spark, d, "documents", "doc_id", "text"))
    full = placed.groupBy("container").agg((F.sum("tokens") <= packing.CAPACITY).alias("within"))
    per = placed.join(full, "container").groupBy("doc_id").agg(F.bool_and("within").alias("within"), (F.sum("tokens") == F.max(F.col("start") + F.col("tokens"))).alias("gapless"), F.bool_and((F.col("tokens") == packing.CAPACITY) | (F.col("tokens") > 0)).alias("filled"), F.count(F.lit(1)).alias("n"), F.max("piece").alias("last"))
    return per.select("doc_id", "within", (F.col("gapless") & F.col("filled") & (F.col("n") == F.col("last") + 1)).alias("whole"))


def p7_uses(spark: SparkSession, d: str) -> DataFrame:
    """Every document of a target's source: whether it is drawn no more often
    than its source may be repeated, each time in another pass."""
    documents, targets = _table(spark, d, "documents", "doc_id", "source", "text"), _table(spark, d, "mix_targets")
    drawn = mixing.drawn_documents(documents, targets).groupBy("doc_id").agg(F.count(F.lit(1)).alias("uses"), F.count_distinct("pass").alias("passes"))
    most = targets.groupBy(source_name(F.col("source")).alias("source")).agg(F.max("max_repeats").alias("most"))
    rows = documents.where(F.trim("text") != "").select("doc_id", source_name(F.col("source")).alias("source")).distinct().join(most, "source")
    return rows.join(drawn, "doc_id", "left").select("doc_id", (F.coalesce("uses", F.lit(0)) <= F.col("most")).alias("within"), (F.coalesce("uses", F.lit(0)) == F.coalesce("passes", F.lit(0))).alias("apart"))


_QUERIES = (p1_found, p1_splits, p1_report, p1_tasks, p2_found, p2_report, p3_found, p3_groups, p5_found, p5_pieces, p5_sizes, p6_placements, p6_containers, p6_report, p6_whole, p7_drawn, p7_report, p7_uses, p8_found, p8_report)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}
