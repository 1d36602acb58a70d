"""Journals of rewrite jobs and their attempts, and reuse of finished results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X

#: Token counts summed over attempts; others in a usage record are not.
USAGE_KEYS = ("prompt_tokens", "completion_tokens", "total_tokens", "prompt_cache_hit_tokens")


def provenance_regions(rows: DataFrame) -> DataFrame:
    """Regions of provenance as a table: the row's columns, position, range,
    source indices, origin, request and decision."""
    keys = [c for c in rows.columns if c != "bridge_provenance_json"]
    region = rows.select(*keys, F.posexplode(X.items(X.json_value(F.col("bridge_provenance_json")))).alias("position", "region"))
    r = F.col("region")
    indices = F.transform(X.items(X.field(r, "source_indices")), lambda x: F.try_variant_get(x, "$", "int"))
    decision = X.field(r, "review_decision")
    return region.select(*keys, "position", X.field(r, "target_start", "int").alias("target_start"), X.field(r, "target_end", "int").alias("target_end"), indices.alias("source_indices"), X.text_field(r, "origin").alias("origin"), X.text_field(r, "request_id").alias("request_id"), X.text_field(decision, "decision").alias("decision"), X.text_field(decision, "route").alias("route"), X.field(decision, "promoted_calls", "bigint").alias("promoted_calls"), F.transform(X.items(X.field(decision, "rejection_reasons")), lambda x: F.try_variant_get(x, "$", "string")).alias("reasons"))


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def usage_sums(attempts: DataFrame) -> DataFrame:
    """name, total of each whole-number usage of distinct attempts."""
    value = F.try_parse_json("usage")
    pairs = F.array(*(F.struct(F.lit(k).alias("name"), X.field(value, k, "bigint").alias("total")) for k in USAGE_KEYS))
    return attempts.dropDuplicates(["id"]).select(F.explode(pairs).alias("u")).where("u.total is not null").groupBy("u.name").agg(F.sum("u.total").alias("total"))


def attempts_per_job(jobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Jobs with the number of their distinct attempts, 0 included."""
    n = attempts.dropDuplicates(["id"]).groupBy("job_id").agg(F.count(F.lit(1)).alias("attempts"))
    return jobs.join(n, jobs["id"] == n["job_id"], "left").select(jobs["*"], F.coalesce("attempts", F.lit(0)).alias("attempts"))


def latest_state(attempts: DataFrame) -> DataFrame:
    """Each job's state by its latest attempt: done after a status 200 without
    error, else failed."""
    state = F.when((F.col("status") == 200) & F.col("error").isNull(), "done").otherwise("failed")
    return attempts.groupBy("job_id").agg(F.max_by(state, F.struct("recorded_at", "id")).alias("state"), F.max("recorded_at").alias("at"))


def sampled_priority(jobs: DataFrame, category: list[str], eligible: Column, first: int = 2) -> DataFrame:
    """The priority of new jobs: 10 for the ``first`` of each category by seq,
    5 for others that are eligible, else 0."""
    place = F.row_number().over(Window.partitionBy(*category).orderBy("seq"))
    return jobs.withColumn("new_priority", F.when(place <= first, 10).when(eligible, 5).otherwise(0).cast("bigint"))


def next_jobs(jobs: DataFrame, k: int) -> DataFrame:
    """The k pending jobs to run next: highest priority, then earliest."""
    return jobs.where("status = 'pending'").orderBy(F.desc("priority"), "seq").limit(k)


def reusable(donors: DataFrame, prompt: list[str]) -> DataFrame:
    """The first finished donor, by seq, of each prompt with exactly one attempt
    and no error."""
    fit = donors.where("status = 'done' and attempts = 1 and error is null")
    return fit.groupBy(*prompt).agg(F.min_by("id", "seq").alias("donor"))


def conflicts(results: DataFrame) -> DataFrame:
    """Request ids with several different results: an error where not empty."""
    return results.groupBy("request_id").agg(F.count_distinct("result").alias("bodies")).where("bodies > 1")
