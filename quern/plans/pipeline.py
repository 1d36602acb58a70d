"""The pipeline: compile, prepare, ask clients, finalize, audit.

Each step reads tables and writes new ones; a manifest with counts and the
hashes of the step's inputs comes last, so that a directory without one is not
complete.  Results are keyed by request id, so a repeated step changes nothing.
"""

from __future__ import annotations

import hashlib
import json
import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from quern.core.jsonio import canonical
from quern.core.shared import discard, materialize
from quern.operators.journal import conflicts, sampled_priority
from quern.plans import sessions as P
from quern.plans.audit import audit_final, audit_stage
from quern.plans.clients import client_messages, envelope, error_label, mechanical_result, read_answer
from quern.plans.codes import CONTEXT_PRODUCER, PROFILES, REVIEW_PRODUCER, TARGETS, TRAINING_VERSION, VERSION, Refusal
from quern.plans.requests import promotable
from quern.plans.results import evaluate
from quern.sources.files import exists, read_document, remove, write_document, write_json_lines, write_parquet
from quern.sources.sessions import dense_row_index, first_of_each_id, read_sessions


def fingerprint(spark: SparkSession, path: str) -> str:
    """One hash over the rows of a table, whatever their order and files: the
    sums of parts of each row's SHA-256, which any changed row changes."""
    rows = spark.read.parquet(path)
    plain = [F.array_sort(F.map_entries(f.name)).alias(f.name) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in rows.schema]
    own = F.sha2(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring("own", k, 15), 16, 10).cast("decimal(38,0)")) for k in (1, 16, 31, 46)]
    sums = rows.select(own.alias("own")).agg(F.count(F.lit(1)), *parts).first()
    return hashlib.sha256(",".join(map(str, sums)).encode()).hexdigest()


def _counts(df: DataFrame, *keys: str) -> dict[str, int]:
    """Counts by keys, joined by slashes: a small report."""
    return {"/".join(str(x) for x in r[:-1]): r[-1] for r in df.groupBy(*keys).count().collect()}


def load(spark: SparkSession, source: str, limit: int = 0) -> DataFrame:
    """Sessions with their dense row index; the first ``limit`` rows if given.
    A repeated id is an error."""
    rows = dense_row_index(read_sessions(spark, source))
    rows = rows.where(F.col("source_row_index") < limit) if limit else rows
    if rows.groupBy("id").count().where("count > 1").limit(1).count():
        raise Refusal("DUPLICATE_TRAJECTORY_ID")
    return rows


def load_first(spark: SparkSession, source: str) -> DataFrame:
    """Sessions with their dense row index, the first row of each id."""
    return first_of_each_id(dense_row_index(read_sessions(spark, source)))


def compile_to(rows: DataFrame, source: str, out: str, targets: tuple[str, ...] = tuple(TARGETS)) -> dict:
    """Plans and the definition catalog under ``out``."""
    spark = rows.sparkSession
    write_parquet(P.compile_sessions(rows, targets), f"{out}/plans", ("target",))
    write_parquet(P.definition_catalog(rows), f"{out}/definitions")
    plans = spark.read.parquet(f"{out}/plans")
    manifest = {"version": VERSION, "input": fingerprint(spark, source), "plans": fingerprint(spark, f"{out}/plans"), "targets": list(targets), "by_source": _counts(plans.where(F.col("target") == targets[0]), "source_scaffold", "kind"), "by_target": _counts(plans.where("kind <> 'refused'"), "target", "status"), "by_kind": _counts(plans.where("kind <> 'refused'"), "target", "kind", "status"), "refused": _counts(plans.where("kind = 'refused'"), "reason"), "execution": "NOT_RUN", "training_ready": False}
    write_document(spark, f"{out}/manifest.json", manifest)
    return manifest


def prepare_to(rows: DataFrame, source: str, compiled: str, out: str, targets: tuple[str, ...] = tuple(TARGETS)) -> dict:
    """Staged sessions, the request queue and rows that need no results."""
    spark = rows.sparkSession
    before = read_document(spark, f"{compiled}/manifest.json")
    if before["version"] != VERSION:
        raise Refusal("COMPILED_VERSION_MISMATCH")
    if before["input"] != fingerprint(spark, source):
        raise Refusal("COMPILED_SOURCE_HASH_MISMATCH")
    if before["plans"] != fingerprint(spark, f"{compiled}/plans"):
        raise Refusal("COMPILED_FILE_HASH_MISMATCH")
    if not set(targets) <= set(before["targets"]):
        raise Refusal("PREPARE_TARGET_SELECTION_INVALID")
    write_parquet(P.stage_sessions(rows, targets), f"{out}/stage", ("kind",))
    stage = spark.read.parquet(f"{out}/stage")
    write_parquet(P.ready_rows(stage), f"{out}/ready", ("target_harness",))
    staged = stage.where("kind = 'staged'")
    sums = {f"{r[0]}/{r[1]}": r[2] for r in staged.select("target", F.explode("counts").alias("what", "n")).groupBy("target", "what").agg(F.sum("n")).collect()}
    manifest = {"version": TRAINING_VERSION, "phase": "prepare", "targets": list(targets), "source": before["input"], "stage": fingerprint(spark, f"{out}/stage"), "counts": sums, "rows": _counts(staged, "target", "status"), "refused": _counts(stage.where("kind = 'refused'"), "code")}
    write_document(spark, f"{out}/profiles.json", PROFILES)
    write_document(spark, f"{out}/manifest.json", manifest)
    return manifest


def export_prompts(stage: DataFrame, path: str, limit: int = 0) -> None:
    """Requests as prompts, one a line; the first ``limit`` by id and seq if given."""

    def rows_of(r: dict) -> Iterator[dict]:
        request = json.loads(r["body"])
        yield {"request_id": r["request_id"], "route": r["route"], "messages": canonical(client_messages(request))}

    queue = stage.where("kind = 'request'")
    queue = queue.orderBy("id", "target", "seq").limit(limit) if limit else queue
    fields = "request_id string, route string, messages string"
    write_json_lines(queue.select("request_id", "route", "body").mapInArrow(P._pass(fields, rows_of), fields), path)


# --- clients


@dataclass(frozen=True)
class Answer:
    """What a client gave: an HTTP-like status, text, how it ended, usage."""

    status: int
    text: str | None = None
    finish: str = "stop"
    usage: dict | None = None


#: A client gets the messages and an output budget.
Client = Callable[[list[dict], int], Answer]
LEAST_BUDGET, MOST_BUDGET = 4096, 32768
_FATAL = (401, 402, 403)


def output_budget(request: dict) -> int:
    if not promotable(request):
        return LEAST_BUDGET
    actions = [e["recompiled_plan"]["actions"] for e in request["payload"]["review"]["entries"]]
    return min(MOST_BUDGET, max(LEAST_BUDGET, len(canonical(actions)) // 2 + 2048))


def ask(request: dict, client: Client, attempts: int = 6, sleep: Callable[[float], Any] = time.sleep) -> tuple[dict | None, list[dict], str]:
    """(result, journal of attempts, state) of one request; errors are redacted.  A refused answer is
    followed by one corrective message; other failures by a growing pause.  The
    state is done, failed, or pending where the service refuses all requests."""
    if (result := mechanical_result(request)) is not None:
        evaluate(request, result)
        return result, [], "done"
    messages, budget, journal = client_messages(request), output_budget(request), []
    first = len(messages)
    for n in range(attempts):
        answer, error = Answer(0), None
        began = time.time()
        try:
            answer = client(messages, budget)
            if answer.status != 200:
                raise Refusal(f"HTTP_{answer.status}")
            if answer.finish != "stop":
                budget = min(MOST_BUDGET, 2 * budget) if answer.finish == "length" else budget
                raise Refusal(f"MODEL_FINISH_{answer.finish}")
            result = envelope(request, read_answer(answer.text), REVIEW_PRODUCER if promotable(request) else CONTEXT_PRODUCER)
            evaluate(request, result)
        except (ValueError, KeyError, TypeError, OSError) as e:
            error = error_label(e)
        journal.append({"started": began, "seconds": time.time() - began, "status": answer.status, "error": error, "usage": canonical(answer.usage) if answer.usage else None})
        if error is None:
            return result, journal, "done"
        if answer.status in _FATAL:
            return None, journal, "pending"
        if answer.status == 400:
            break
        if answer.status == 200:
            messages = [*messages[:first], {"role": "user", "content": f"The last answer was refused: {error}. Give one whole corrected JSON object, with quotes and indices from exact_quote_suggestions and no markup."}]
        if n + 1 < attempts:
            sleep(min(45, 2**n) + random.random())
    return None, journal, "failed"


ASKED_FIELDS = "request_id string, state string, result string, producer string, attempts bigint, journal string"
#: Requests asked at once by a task, and those whose results are committed together.
CONCURRENT, COMMITTED = 32, 1000


def ask_all(requests: DataFrame, make_client: Callable[[], Client], attempts: int = 6, concurrent: int = CONCURRENT) -> DataFrame:
    """Every request (request_id, body) with its state and result, as they come.
    A client is made on each worker and asked by up to ``concurrent`` threads;
    keys stay in its environment and out of tables.  Once the service refuses
    all requests a task sends no more: the rest is pending.  Turn speculative
    execution off, or requests may be sent twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, stop = make_client(), threading.Event()

        def one(r: dict) -> dict:
            result, journal, state = (None, [], "pending") if stop.is_set() else ask(json.loads(r["body"]), client, attempts)
            if state == "pending":
                stop.set()
            return {"request_id": r["request_id"], "state": state, "result": canonical(result) if result else None, "producer": result["producer"] if result else None, "attempts": len(journal), "journal": canonical(journal)}

        with ThreadPoolExecutor(concurrent) as pool:
            for batch in batches:
                found = {pool.submit(one, r) for r in batch.to_pylist()}
                yield from P._pass(ASKED_FIELDS, lambda row: [row])(pa.RecordBatch.from_pylist([f.result()], P._arrow(ASKED_FIELDS)) for f in as_completed(found))

    return requests.select("request_id", "body").mapInArrow(run, ASKED_FIELDS)


def _exclusive(spark: SparkSession, journal: str, settings: dict) -> str:
    """Takes the journal for this run, refused while another has it or if it was
    begun with other settings; the path to give it back."""
    lock = f"{journal}.lock"
    try:
        write_document(spark, lock, {"taken": time.time()})
    except Exception as e:
        raise Refusal("JOURNAL_IN_USE:" + lock) from e
    known = f"{journal}.settings.json"
    if not exists(spark, known):
        write_document(spark, known, settings)
    elif (before := read_document(spark, known)) != settings:
        remove(spark, lock)
        raise Refusal("RESUME_SETTINGS_CHANGED:" + ",".join(sorted(k for k in before.keys() | settings.keys() if before.get(k) != settings.get(k))))
    return lock


def run_queue(stage: DataFrame, journal: str, make_client: Callable[[], Client], limit: int = 0, attempts: int = 6, concurrent: int = CONCURRENT, committed: int = COMMITTED, retry_failed: bool = True, settings: dict | None = None) -> DataFrame:
    """Asks for what the journal (a Parquet directory) has no finished result
    for, by priority, and gives all finished results.  About ``committed``
    requests at a time are appended to it, so that a lost run loses no more, and
    no further ones are sent once the service refuses all.  Stopping and starting
    again repeats no finished request; failed ones are asked again unless told
    otherwise.  ``settings`` (model, options) must be those the journal was begun
    with."""
    spark = stage.sparkSession
    lock = _exclusive(spark, journal, {"attempts": attempts, **(settings or {})})
    try:
        queue = stage.where("kind = 'request'").select("request_id", "body", "route", "eligible", "target", "id", "seq").dropDuplicates(["request_id"])
        if exists(spark, journal):
            over = ("done",) if retry_failed else ("done", "failed")
            queue = queue.join(spark.read.parquet(journal).where(F.col("state").isin(*over)).select("request_id"), "request_id", "left_anti")
        if limit:
            queue = sampled_priority(queue.withColumn("seq", F.struct("id", "seq")), ["target", "route", "eligible"], F.col("eligible")).orderBy(F.desc("new_priority"), "seq").limit(limit)
        queue = materialize(queue.select("request_id", "body"), "queue")
        turns = max(1, -(-queue.count() // committed))
        for turn in range(turns):
            asked = materialize(ask_all(queue.where(F.pmod(F.xxhash64("request_id"), F.lit(turns)) == turn), make_client, attempts, concurrent), "asked")
            asked.write.mode("append").parquet(journal)
            refused = asked.where("state = 'pending'").limit(1).count()
            discard(asked)
            if refused:
                break
        discard(queue)
    finally:
        remove(spark, lock)
    return spark.read.parquet(journal).where("state = 'done'").select("request_id", "result", "producer")


def in_order(results: DataFrame, stage: DataFrame) -> DataFrame:
    """Results in the order their requests were staged: id, target, seq."""
    place = stage.where("kind = 'request'").select("request_id", "id", "target", "seq").dropDuplicates(["request_id"])
    return results.dropDuplicates(["request_id"]).join(place, "request_id").orderBy("id", "target", "seq")


def unite(*results: DataFrame) -> DataFrame:
    """Results of several files; one request with different ones is an error."""
    both = results[0].select("request_id", "result")
    for more in results[1:]:
        both = both.unionByName(more.select("request_id", "result"))
    both = both.distinct()
    if (bad := conflicts(both).limit(1).collect()):
        raise Refusal("CONFLICTING_REWRITE_RESULTS:" + bad[0]["request_id"])
    return both


def finalize_to(stage_path: str, results: DataFrame, out: str, targets: tuple[str, ...] | None = None) -> dict:
    """Training rows, pending rows and decisions of a stage with its results."""
    spark = results.sparkSession
    before = read_document(spark, f"{stage_path}/manifest.json")
    if before.get("phase") != "prepare":
        raise Refusal("FINALIZE_REQUIRES_PREPARED_STAGE")
    if before["version"] != TRAINING_VERSION:
        raise Refusal("STAGE_VERSION_MISMATCH")
    if before["stage"] != fingerprint(spark, f"{stage_path}/stage"):
        raise Refusal("STAGE_HASH_MISMATCH")
    targets = tuple(targets or before["targets"])
    if len(set(targets)) < len(targets) or not set(targets) <= set(before["targets"]):
        raise Refusal("FINALIZE_TARGET_SELECTION_INVALID")
    stage = spark.read.parquet(f"{stage_path}/stage").where(F.col("target").isin(*targets))
    requests = stage.where("kind = 'request'")
    if results.join(requests.select("request_id"), "request_id", "left_anti").limit(1).count():
        raise Refusal("UNKNOWN_REWRITE_RESULTS")
    judged = materialize(P.judge(requests, results), "judged")
    if (bad := judged.where("decision = 'invalid'").limit(1).collect()):
        raise Refusal(bad[0]["reasons"][0])
    finished = materialize(P.finish(stage, judged), "finished")
    write_parquet(P.final_rows(finished), f"{out}/rows", ("target_harness",))
    write_parquet(finished.where("status <> 'exported'").drop("body"), f"{out}/pending")
    write_parquet(judged, f"{out}/decisions")
    rows = spark.read.parquet(f"{out}/rows")
    weight = F.aggregate("message_loss_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sums = {r[0]: r[1] for r in rows.groupBy("target_harness").agg(F.sum(weight)).collect()}
    manifest = {"version": TRAINING_VERSION, "phase": "finalize", "targets": list(targets), "stage": before["stage"], "rows": _counts(finished, "target", "status"), "decisions": _counts(judged, "target", "decision"), "rejections": _counts(judged.select("target", F.explode("reasons").alias("reason")), "target", "reason"), "supervised_messages": sums}
    write_document(spark, f"{out}/manifest.json", manifest)
    return manifest


def audit(rows: DataFrame, stage_path: str, final_path: str | None = None) -> DataFrame:
    """All violations of a stage and, if given, of its final rows."""
    spark = rows.sparkSession
    stage = spark.read.parquet(f"{stage_path}/stage")
    found = audit_stage(rows, stage)
    if final_path:
        found = found.unionByName(audit_final(stage, spark.read.parquet(f"{final_path}/decisions"), spark.read.parquet(f"{final_path}/rows")))
    return found
