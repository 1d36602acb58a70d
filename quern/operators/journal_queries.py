"""Queries over exported rows and the job journal, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.operators import journal as J
from quern.sources import sessions as S

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_REGIONS = """WITH p0 AS (SELECT *, CASE WHEN json_valid(bridge_provenance_json) THEN bridge_provenance_json ELSE 'null' END AS a FROM training_rows), p1 AS (SELECT *, CASE WHEN json_type(a) = 'VARCHAR' THEN a->>'$' ELSE a END AS b FROM p0),
p2 AS (SELECT *, CASE WHEN json_valid(b) THEN b ELSE 'null' END AS c FROM p1), p3 AS (SELECT row_number() OVER () AS k, *, CASE WHEN json_type(c) = 'ARRAY' THEN c ELSE '[]' END AS pj FROM p2),
r AS (SELECT k, p3.id, target_harness, len(message_loss_mask) AS n_mask, CAST(e.key AS INT) AS position, CAST(e.value->>'$.target_start' AS INT) AS target_start, CAST(e.value->>'$.target_end' AS INT) AS target_end, list_transform(from_json(coalesce(e.value->'$.source_indices', '[]'), '["int"]'), lambda x: x) AS source_indices,
  e.value->>'$.origin' AS origin, e.value->>'$.request_id' AS request_id, e.value->>'$.review_decision.decision' AS decision, e.value->>'$.review_decision.route' AS route, CAST(e.value->>'$.review_decision.promoted_calls' AS BIGINT) AS promoted_calls,
  coalesce(from_json(e.value->'$.review_decision.rejection_reasons', '["varchar"]'), []) AS reasons FROM p3, json_each(p3.pj) e)
"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _regions(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "training_rows").select("id", "target_harness", F.size("message_loss_mask").alias("n_mask"), "bridge_provenance_json", S.row_key().alias("row_key"))
    return J.provenance_regions(rows)


@query("SELECT status, count(*) AS n FROM jobs GROUP BY 1")
def job_status(spark: SparkSession, d: str) -> DataFrame:
    return J.status_counts(_table(spark, d, "jobs"))


@query("SELECT status, error, count(*) AS n FROM (SELECT DISTINCT id, status, error FROM attempts) GROUP BY 1, 2")
def attempt_errors(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "attempts").select("id", "status", "error").distinct().groupBy("status", "error").agg(F.count(F.lit(1)).alias("n"))


_USED = " UNION ALL ".join(f"SELECT '{k}' AS name, try_cast(usage->>'$.{k}' AS BIGINT) AS v FROM (SELECT DISTINCT id, usage FROM attempts) WHERE json_valid(usage)" for k in J.USAGE_KEYS)


@query(f"SELECT name, CAST(sum(v) AS BIGINT) AS total FROM ({_USED}) WHERE v IS NOT NULL GROUP BY 1")
def token_usage(spark: SparkSession, d: str) -> DataFrame:
    return J.usage_sums(_table(spark, d, "attempts"))


@query("SELECT status, attempts, count(*) AS jobs FROM (SELECT j.id, any_value(j.status) AS status, count(DISTINCT a.id) AS attempts FROM jobs j LEFT JOIN attempts a ON a.job_id = j.id GROUP BY 1) GROUP BY 1, 2")
def job_attempts(spark: SparkSession, d: str) -> DataFrame:
    return J.attempts_per_job(_table(spark, d, "jobs"), _table(spark, d, "attempts")).groupBy("status", "attempts").agg(F.count(F.lit(1)).alias("jobs"))


@query("SELECT state, count(*) AS jobs FROM (SELECT DISTINCT ON (job_id) job_id, CASE WHEN status = 200 AND error IS NULL THEN 'done' ELSE 'failed' END AS state FROM attempts ORDER BY job_id, recorded_at DESC, id DESC) GROUP BY 1")
def journal_states(spark: SparkSession, d: str) -> DataFrame:
    return J.latest_state(_table(spark, d, "attempts")).groupBy("state").agg(F.count(F.lit(1)).alias("jobs"))


@query("SELECT route, new_priority, count(*) AS n, CAST(min(seq) AS BIGINT) AS first_seq FROM (SELECT *, CAST(CASE WHEN row_number() OVER (PARTITION BY target, route ORDER BY seq) <= 2 THEN 10 WHEN route = 'candidate_resolution' THEN 5 ELSE 0 END AS BIGINT) AS new_priority FROM jobs) GROUP BY 1, 2")
def queue_priority(spark: SparkSession, d: str) -> DataFrame:
    return J.sampled_priority(_table(spark, d, "jobs"), ["target", "route"], F.col("route") == "candidate_resolution").groupBy("route", "new_priority").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


@query("SELECT id, seq, priority FROM jobs WHERE status = 'pending' ORDER BY priority DESC, seq LIMIT 20")
def pending_top(spark: SparkSession, d: str) -> DataFrame:
    return J.next_jobs(_table(spark, d, "jobs"), 20).select("id", "seq", "priority")


@query("SELECT target, route, min(seq) AS seq, arg_min(id, seq) AS id FROM jobs GROUP BY 1, 2")
def first_examples(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "jobs").groupBy("target", "route").agg(F.min("seq").alias("seq"), F.min_by("id", "seq").alias("id"))


@query("SELECT source_id, target, arg_min(id, seq) AS donor FROM (SELECT j.id, j.seq, j.source_id, j.target FROM jobs j JOIN attempts a ON a.job_id = j.id WHERE j.status = 'done' AND j.error IS NULL GROUP BY ALL HAVING count(DISTINCT a.id) = 1) GROUP BY 1, 2")
def reuse_donors(spark: SparkSession, d: str) -> DataFrame:
    return J.reusable(J.attempts_per_job(_table(spark, d, "jobs"), _table(spark, d, "attempts")), ["source_id", "target"])


@query("WITH w AS (SELECT source_id, target, arg_min(id, seq) AS donor FROM (SELECT j.id, j.seq, j.source_id, j.target FROM jobs j JOIN attempts a ON a.job_id = j.id WHERE j.status = 'done' AND j.error IS NULL GROUP BY ALL HAVING count(DISTINCT a.id) = 1) GROUP BY 1, 2) SELECT j.id, w.donor FROM jobs j JOIN w USING (source_id, target) WHERE j.status = 'pending'")
def reused_jobs(spark: SparkSession, d: str) -> DataFrame:
    jobs = _table(spark, d, "jobs")
    donors = J.reusable(J.attempts_per_job(jobs, _table(spark, d, "attempts")), ["source_id", "target"])
    return jobs.where("status = 'pending'").join(donors, ["source_id", "target"]).select("id", "donor")


@query("SELECT hour, count(*) AS attempts, count(DISTINCT job_id) AS jobs, count(*) FILTER (status = 200) AS ok FROM (SELECT DISTINCT id, job_id, status, strftime(date_trunc('hour', started), '%Y-%m-%d %H:%M:%S') AS hour FROM attempts) GROUP BY 1")
def progress_by_hour(spark: SparkSession, d: str) -> DataFrame:
    a = _table(spark, d, "attempts").select("id", "job_id", "status", F.date_format(F.date_trunc("hour", F.col("started")), "yyyy-MM-dd HH:mm:ss").alias("hour")).distinct()
    return a.groupBy("hour").agg(F.count(F.lit(1)).alias("attempts"), F.count_distinct("job_id").alias("jobs"), F.count_if(F.col("status") == 200).alias("ok"))


# --- provenance


@query(_REGIONS + "SELECT target_harness, origin, count(*) AS n, CAST(sum(target_end - target_start) AS BIGINT) AS messages, CAST(sum(len(source_indices)) AS BIGINT) AS sources FROM r GROUP BY 1, 2")
def region_counts(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).groupBy("target_harness", "origin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("target_end") - F.col("target_start")).alias("messages"), F.sum(F.size("source_indices")).alias("sources"))


@query(_REGIONS + "SELECT decision, route, count(*) AS n, CAST(sum(promoted_calls) AS BIGINT) AS promoted FROM r WHERE decision IS NOT NULL GROUP BY 1, 2")
def decision_counts(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).where("decision is not null").groupBy("decision", "route").agg(F.count(F.lit(1)).alias("n"), F.sum("promoted_calls").alias("promoted"))


@query(_REGIONS + "SELECT target_harness, reason, count(*) AS n FROM (SELECT target_harness, unnest(reasons) AS reason FROM r) GROUP BY 1, 2")
def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).select("target_harness", F.explode("reasons").alias("reason")).groupBy("target_harness", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(_REGIONS + """, f AS (SELECT k, flatten(list(source_indices ORDER BY position)) AS cover, max(target_end) AS last, max(n_mask) AS n_mask, sum(target_end - target_start) AS total FROM r GROUP BY 1)
SELECT cover = range(0, len(cover)) AS covered, last = n_mask AS ends, total = last AS gapless, count(*) AS n FROM f GROUP BY 1, 2, 3""")
def provenance_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose regions cover all sources in order, and their messages without gaps."""
    f = _regions(spark, d).groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("position", "source_indices"))).alias("all"), F.max("target_end").alias("last"), F.max("n_mask").alias("n_mask"), F.sum(F.col("target_end") - F.col("target_start")).alias("total"))
    f = f.withColumn("cover", F.flatten(F.transform("all", lambda x: x["source_indices"])))
    whole = F.when(F.size("cover") == 0, F.lit(True)).otherwise(F.col("cover") == F.sequence(F.lit(0), F.size("cover") - 1))
    return f.select(whole.alias("covered"), (F.col("last") == F.col("n_mask")).alias("ends"), (F.col("total") == F.col("last")).alias("gapless")).groupBy("covered", "ends", "gapless").agg(F.count(F.lit(1)).alias("n"))


@query(_REGIONS + "SELECT target_harness, target_start = cursor AS aligned, count(*) AS n FROM (SELECT *, coalesce(sum(target_end - target_start) OVER (PARTITION BY k ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cursor FROM r) GROUP BY 1, 2")
def target_cursors(spark: SparkSession, d: str) -> DataFrame:
    before = Window.partitionBy("row_key").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    r = _regions(spark, d).withColumn("cursor", F.coalesce(F.sum(F.col("target_end") - F.col("target_start")).over(before), F.lit(0)))
    return r.groupBy("target_harness", (F.col("target_start") == F.col("cursor")).alias("aligned")).agg(F.count(F.lit(1)).alias("n"))


_REQUESTED = _REGIONS + ", q AS (SELECT DISTINCT id, target_harness, request_id FROM r WHERE request_id IS NOT NULL)"


def _requested(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).where("request_id is not null").select("id", "target_harness", "request_id").distinct()


@query(_REQUESTED + " SELECT target_harness, coalesce(status, 'missing') AS status, count(*) AS n FROM q LEFT JOIN (SELECT id AS request_id, status FROM jobs) USING (request_id) GROUP BY 1, 2")
def request_results(spark: SparkSession, d: str) -> DataFrame:
    jobs = _table(spark, d, "jobs").select(F.col("id").alias("request_id"), "status")
    return _requested(spark, d).join(jobs, "request_id", "left").groupBy("target_harness", F.coalesce("status", F.lit("missing")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(_REQUESTED + " SELECT status, count(*) AS n FROM jobs WHERE id NOT IN (SELECT request_id FROM q) GROUP BY 1")
def unused_results(spark: SparkSession, d: str) -> DataFrame:
    used = _requested(spark, d).select(F.col("request_id").alias("id")).distinct()
    return _table(spark, d, "jobs").join(used, "id", "left_anti").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(_REQUESTED + " SELECT target_harness, count(*) AS rows_, count(*) FILTER (missing > 0) AS pending FROM (SELECT q.id, target_harness, count(*) FILTER (j.id IS NULL OR j.status <> 'done') AS missing FROM q LEFT JOIN jobs j ON j.id = q.request_id GROUP BY 1, 2) GROUP BY 1")
def pending_rows(spark: SparkSession, d: str) -> DataFrame:
    """Exported rows that lack a finished result of one of their requests."""
    done = _table(spark, d, "jobs").where("status = 'done'").select(F.col("id").alias("request_id"), F.lit(1).alias("done"))
    per = _requested(spark, d).join(done, "request_id", "left").groupBy("id", "target_harness").agg(F.count_if(F.col("done").isNull()).alias("missing"))
    return per.groupBy("target_harness").agg(F.count(F.lit(1)).alias("rows_"), F.count_if(F.col("missing") > 0).alias("pending"))


# --- exported rows against their sessions

_BOTH = """WITH t AS (SELECT DISTINCT id, source_scaffold FROM trajectories), x AS (SELECT DISTINCT id, target_harness, source_scaffold, split FROM training_rows)"""


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return _table(spark, d, "trajectories").select("id", "source_scaffold").distinct(), _table(spark, d, "training_rows").select("id", "target_harness", "source_scaffold", "split").distinct()


@query(_BOTH + " SELECT CASE WHEN x.id IS NULL THEN 'only source' WHEN t.id IS NULL THEN 'only exported' WHEN t.source_scaffold IS DISTINCT FROM x.source_scaffold THEN 'changed' ELSE 'aligned' END AS state, count(*) AS n FROM t FULL JOIN x ON t.id = x.id GROUP BY 1")
def source_alignment(spark: SparkSession, d: str) -> DataFrame:
    t, x = _both(spark, d)
    both = t.alias("t").join(x.alias("x"), F.col("t.id") == F.col("x.id"), "full")
    state = F.when(F.col("x.id").isNull(), "only source").when(F.col("t.id").isNull(), "only exported").when(~F.col("t.source_scaffold").eqNullSafe(F.col("x.source_scaffold")), "changed").otherwise("aligned")
    return both.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query(_BOTH + ", j AS (SELECT DISTINCT source_id AS id FROM jobs) SELECT t.id IS NOT NULL AS in_source, x.id IS NOT NULL AS exported, j.id IS NOT NULL AS queued, count(*) AS n FROM t FULL JOIN (SELECT DISTINCT id FROM x) x ON t.id = x.id FULL JOIN j ON j.id = coalesce(t.id, x.id) GROUP BY 1, 2, 3")
def three_way_alignment(spark: SparkSession, d: str) -> DataFrame:
    t, x = _both(spark, d)
    t, x, j = (df.distinct().withColumn(flag, F.lit(True)) for df, flag in ((t.select("id"), "in_source"), (x.select("id"), "exported"), (_table(spark, d, "jobs").select(F.col("source_id").alias("id")), "queued")))
    both = t.join(x, "id", "full").join(j, "id", "full")
    flags = [F.coalesce(f, F.lit(False)).alias(f) for f in ("in_source", "exported", "queued")]
    return both.select(*flags).groupBy("in_source", "exported", "queued").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'split' AS violation, count(*) AS n FROM training_rows WHERE split IS DISTINCT FROM 'train' UNION ALL SELECT 'not ready', count(*) FROM training_rows WHERE training_ready IS DISTINCT FROM true UNION ALL SELECT 'mask value', count(*) FROM training_rows WHERE len(list_filter(message_loss_mask, lambda x: x NOT IN (0, 1))) > 0 UNION ALL SELECT 'no weight', count(*) FROM training_rows WHERE NOT coalesce(list_contains(message_loss_mask, 1), false) UNION ALL SELECT 'rewrites', count(*) FROM training_rows WHERE masked_rewrite_count + promoted_region_count <> rewrite_count UNION ALL SELECT 'policy', count(*) FROM training_rows WHERE observation_policy IS DISTINCT FROM 'recorded_source_projection_no_target_execution'")
def export_violations(spark: SparkSession, d: str) -> DataFrame:
    """Counts of exported rows that break an invariant."""
    from quern.plans.audit import ROW_RULES

    rows = _table(spark, d, "training_rows")
    counts = rows.agg(*(F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(name) for name, rule in ROW_RULES.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(name).alias("violation"), F.col(f"`{name}`").alias("n")) for name in ROW_RULES))).alias("v")).select("v.*")


@query("SELECT id, count(*) AS copies, count(DISTINCT coalesce(split, '') || '|' || coalesce(task_group_key, '')) AS versions FROM trajectories GROUP BY 1 HAVING count(DISTINCT coalesce(split, '') || '|' || coalesce(task_group_key, '')) > 1")
def conflicting_rows(spark: SparkSession, d: str) -> DataFrame:
    """Union with conflict check: ids delivered with different metadata."""
    version = F.concat_ws("|", F.coalesce("split", F.lit("")), F.coalesce("task_group_key", F.lit("")))
    return _table(spark, d, "trajectories").groupBy("id").agg(F.count(F.lit(1)).alias("copies"), F.count_distinct(version).alias("versions")).where("versions > 1")


@query("SELECT target_harness, source_scaffold, count(*) AS n, CAST(sum(list_sum(message_loss_mask)) AS BIGINT) AS weight, CAST(sum(rewrite_count) AS BIGINT) AS rewrites, CAST(sum(promoted_target_calls) AS BIGINT) AS promoted, count(*) FILTER (has_target_finish) AS finished FROM training_rows GROUP BY 1, 2")
def export_counts(spark: SparkSession, d: str) -> DataFrame:
    total = F.aggregate("message_loss_mask", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return _table(spark, d, "training_rows").groupBy("target_harness", "source_scaffold").agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("weight"), F.sum("rewrite_count").alias("rewrites"), F.sum("promoted_target_calls").alias("promoted"), F.count_if("has_target_finish").alias("finished"))


# --- the session passes


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    return S.read_sessions(spark, f"{d}/trajectories.parquet").withColumnRenamed("file_row_index", "source_row_index")


@query()
def compiled_plans(spark: SparkSession, d: str) -> DataFrame:
    from quern.plans.sessions import compile_sessions

    return compile_sessions(_sessions(spark, d)).drop("observations", "requirements", "verified", "tools", "implementations")


@query()
def definition_catalog(spark: SparkSession, d: str) -> DataFrame:
    from quern.plans.sessions import definition_catalog as catalog

    return catalog(_sessions(spark, d))


@query()
def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sums of the staging counts by target."""
    from quern.plans.sessions import stage_sessions

    staged = stage_sessions(_sessions(spark, d), kinds=("staged",), bodies=False)
    both = staged.select("target", F.explode("counts").alias("what", "n")).unionByName(staged.select("target", F.concat(F.lit("rows/"), "status").alias("what"), F.lit(1).cast("bigint").alias("n")))
    return both.groupBy("target", "what").agg(F.sum("n").alias("n"))


@query()
def stage_ready_rows(spark: SparkSession, d: str) -> DataFrame:
    from quern.plans.sessions import export_ready

    return export_ready(_sessions(spark, d))


@query()
def stage_requests(spark: SparkSession, d: str) -> DataFrame:
    from quern.plans.sessions import stage_sessions

    r = stage_sessions(_sessions(spark, d), kinds=("request",))
    return r.select("id", "target", "seq", "request_id", "route", "eligible", F.array_join("reasons", ",").alias("reasons"), F.length("body").alias("chars"))


@query()
def stage_violations(spark: SparkSession, d: str) -> DataFrame:
    """Audit of the stage, recomputed from the sessions; empty if sound."""
    from quern.core.shared import materialize
    from quern.plans.audit import audit_stage
    from quern.plans.sessions import stage_sessions

    rows = S.first_of_each_id(_sessions(spark, d), "source_row_index")
    return audit_stage(rows, materialize(stage_sessions(rows), "stage"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
