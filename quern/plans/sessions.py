"""The per-session stages as one Arrow pass each: no shuffle, no driver rows.

A session's calls depend on each other in order, so a session is compiled or
staged where it lies; what comes out is flat tables for ordinary plans.
Sessions that can't be read give one row of kind ``refused`` with the code.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.jsonio import canonical, digest
from quern.core.shared import spread
from quern.plans.clients import mechanical_result
from quern.plans.codes import TARGETS, Refusal
from quern.plans.lowering import definitions, tool_calls
from quern.plans.requests import Region
from quern.plans.results import evaluate
from quern.plans.staging import Session, Stage, assemble

#: Columns of a session record; missing ones are null.
COLUMNS = {
    "id": "string", "source_scaffold": "string", "split": "string", "messages_json": "string", "tools_json": "string", "message_loss_mask": "array<bigint>", "task_group_key": "string",
    "source_dataset": "string", "source_revision": "string", "teacher": "string", "acceptance_basis": "string", "reference_tokens": "bigint", "source_row_index": "bigint",
}

PLAN_FIELDS = (
    "id string, source_scaffold string, split string, target string, message_index int, call_index int, call_id string, source_tool string, kind string, supervised boolean, observations array<int>, definition_sha256 string, "
    "status string, reason string, requirements array<string>, verified array<string>, tools array<string>, implementations array<string>, operation_json string, actions_json string, preimage_json string, source_payload_sha256 string, source_row_index bigint"
)
STAGE_FIELDS = "id string, target string, kind string, seq int, request_id string, route string, eligible boolean, source_scaffold string, status string, body string, counts map<string,bigint>, reasons array<string>, source_indices array<int>, code string"
ROW_FIELDS = (
    "id string, source_scaffold string, task_group_key string, split string, source_split string, source_dataset string, source_revision string, teacher string, acceptance_basis string, target_harness string, source_payload_sha256 string, "
    "messages_json string, tools_json string, bridge_provenance_json string, observation_policy string, source_reference_tokens bigint, source_row_index bigint, message_loss_mask array<bigint>, training_ready boolean, has_target_finish boolean, "
    "rewrite_count bigint, masked_rewrite_count bigint, promoted_region_count bigint, promoted_target_calls bigint"
)


def records(rows: DataFrame) -> DataFrame:
    """``rows`` with exactly the columns of a record."""
    have = set(rows.columns)
    return rows.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()))


def _arrow(fields: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "map<string,bigint>": pa.map_(pa.string(), pa.int64())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in fields.split(", ")])


def _clean(value):
    if isinstance(value, str):
        return value if value.isascii() else value.encode("utf-8", "replace").decode()
    return [_clean(v) for v in value] if isinstance(value, list) else value


def _pass(fields: str, rows_of):
    """An Arrow pass over records; rows_of gives the output rows (dicts) of one."""
    schema = _arrow(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                out = [{k: _clean(v) for k, v in row.items()} for record in batch.slice(at, 128).to_pylist() for row in rows_of(record)]
                if out:
                    yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in out], schema=schema)

    return run


def _plan_rows(targets: tuple[str, ...], texts: bool = True):
    def rows_of(record: dict) -> Iterator[dict]:
        base = {k: record[k] for k in ("id", "source_scaffold", "split", "source_row_index")}
        try:
            s = Session(record)
        except Refusal as e:
            yield base | {"kind": "refused", "status": "refused", "reason": str(e)}
            return
        for target in targets:
            for c, p in zip(s.calls, s.plans(target)):
                yield base | {
                    "target": target, "message_index": c["message_index"], "call_index": c["call_index"], "call_id": c["call_id"], "source_tool": c["source_tool"], "kind": c["operation"]["kind"], "supervised": c["supervised"], "observations": c["observation_indices"], "definition_sha256": c["definition_sha256"],
                    "status": p["status"], "reason": p["reason"], "requirements": p["requirements"], "verified": p["verified_properties"], "tools": [a["tool"] for a in p["actions"]], "implementations": [a["implementation"] for a in p["actions"]],
                } | ({"operation_json": canonical(c["operation"]), "actions_json": canonical(p["actions"]), "preimage_json": canonical(p["preimage_sha256"]), "source_payload_sha256": s.payload_hash} if texts else {})

    return rows_of


def compile_sessions(rows: DataFrame, targets: tuple[str, ...] = tuple(TARGETS), texts: bool = True) -> DataFrame:
    """A row for each call and target; sessions that can't be read, one row of
    kind and status ``refused``.  Without ``texts`` no JSON or hash is made."""
    return spread(records(rows)).mapInArrow(_pass(PLAN_FIELDS, _plan_rows(targets, texts)), PLAN_FIELDS)


#: Kinds of rows a stage is written as; ``source`` only where it is audited.
STAGE_KINDS = ("staged", "request", "segment", "ready", "refused")


def _stage_rows(targets: tuple[str, ...], kinds: tuple[str, ...] = STAGE_KINDS, bodies: bool = True):
    def rows_of(record: dict) -> Iterator[dict]:
        base = {"id": record["id"], "source_scaffold": record["source_scaffold"]}
        try:
            session = Session(record)
            out = [base | row for t in targets for row in of_stage(Stage(session, t))]
        except Refusal as e:
            if "refused" in kinds:
                yield base | {"kind": "refused", "status": "refused", "code": str(e)}
            return
        if "source" in kinds:
            yield base | {"kind": "source", "body": json.dumps({"calls": [len(tool_calls(m)) for m in session.messages], "mask": [int(bool(x)) for x in session.mask]})}
        yield from out

    def of_stage(stage: Stage) -> Iterator[dict]:
        own = {"target": stage.target}
        if "staged" in kinds or "ready" in kinds:
            yield from of_session(stage, own)
        if "request" in kinds:
            for n, r in enumerate(stage.regions):
                named = {"request_id": r.request["request_id"], "body": canonical(r.request)} if bodies else {}
                yield own | named | {"kind": "request", "seq": n, "route": r.route, "eligible": r.eligible, "reasons": r.reasons, "source_indices": r.indices}
        if "segment" in kinds:
            for n, s in enumerate(stage.staged):
                if isinstance(s, Region):
                    named = {"request_id": s.request["request_id"]} if bodies else {}
                    yield own | named | {"kind": "segment", "seq": n, "route": "rewrite", "eligible": s.eligible, "status": s.route, "source_indices": s.indices, "reasons": s.reasons, "counts": [("messages", 0), ("weight", 0)]}
                else:
                    yield own | {"kind": "segment", "seq": n, "route": "messages", "status": s["origin"], "source_indices": s["source_indices"], "reasons": [], "counts": [("messages", len(s["messages"])), ("weight", sum(s["masks"]))]}

    def of_session(stage: Stage, own: dict) -> Iterator[dict]:
        row, code = None, None
        if not stage.regions or bodies:
            staged = stage.as_dict()
            try:
                row, state = assemble(staged, {})
            except Refusal as e:
                state, code = "invalid_dialogue", str(e)
        else:
            state = "pending_rewrites"
        if "staged" in kinds:
            yield own | {"kind": "staged", "seq": 0, "status": state, "body": canonical(staged) if bodies else None, "counts": [*stage.counts.items()], "code": code}
        if "ready" in kinds and row is not None:
            yield own | {"kind": "ready", "seq": 0, "body": json.dumps(row)}

    return rows_of


def stage_sessions(rows: DataFrame, targets: tuple[str, ...] = tuple(TARGETS), kinds: tuple[str, ...] = STAGE_KINDS, bodies: bool = True) -> DataFrame:
    """Rows of the wanted ``kinds``.  Without ``bodies`` no JSON and no hash of
    a request is made, which is enough to count."""
    return spread(records(rows)).mapInArrow(_pass(STAGE_FIELDS, _stage_rows(targets, kinds, bodies)), STAGE_FIELDS)


def export_ready(rows: DataFrame, targets: tuple[str, ...] = tuple(TARGETS)) -> DataFrame:
    """Training rows of sessions that need no results, straight from sessions."""

    def rows_of(record: dict) -> Iterator[dict]:
        try:
            session = Session(record)
        except Refusal:
            return
        for t in targets:
            try:
                stage = Stage(session, t)
                row = None if stage.regions else assemble(stage.as_dict(), {})[0]
            except Refusal:
                continue
            if row is not None:
                yield row

    return spread(records(rows)).mapInArrow(_pass(ROW_FIELDS, rows_of), ROW_FIELDS)


def ready_rows(stages: DataFrame) -> DataFrame:
    """Training rows of sessions that need no results."""
    return stages.where("kind = 'ready'").select(F.from_json("body", ROW_FIELDS).alias("r")).select("r.*")


def _judge(record: dict) -> Iterator[dict]:
    try:
        messages, mask, decision = evaluate(json.loads(record["request"]), json.loads(record["result"]))
        yield {"id": record["id"], "target": record["target"], "request_id": record["request_id"], "decision": decision["decision"], "promoted_calls": decision["promoted_calls"], "restored": decision["restored_supervised_calls"], "reasons": decision["rejection_reasons"], "outcome": canonical([messages, mask, decision])}
    except (Refusal, ValueError, KeyError, TypeError) as e:
        yield {"id": record["id"], "target": record["target"], "request_id": record["request_id"], "decision": "invalid", "reasons": [str(e)]}


JUDGED_FIELDS = "id string, target string, request_id string, decision string, promoted_calls bigint, restored bigint, reasons array<string>, outcome string"


def judge(requests: DataFrame, results: DataFrame) -> DataFrame:
    """The decision on every result that has a request.  requests: id, target,
    request_id, body; results: request_id, result."""
    joined = requests.select("id", "target", "request_id", F.col("body").alias("request")).join(results.select("request_id", "result"), "request_id")
    return joined.mapInArrow(_pass(JUDGED_FIELDS, _judge), JUDGED_FIELDS)


FINAL_FIELDS = "id string, target string, status string, missing array<string>, code string, body string"


def _finish(record: dict) -> Iterator[dict]:
    staged = json.loads(record["body"])
    evaluated = {o["request_id"]: tuple(json.loads(o["outcome"])) for o in record["outcomes"] or [] if o["outcome"]}
    base = {"id": record["id"], "target": record["target"]}
    try:
        row, state = assemble(staged, evaluated)
        yield base | {"status": state, "body": json.dumps(row) if row else None, "missing": [r for r in staged["pending_request_ids"] if r not in evaluated]}
    except Refusal as e:
        yield base | {"status": "invalid_dialogue", "code": str(e)}


def finish(stages: DataFrame, judged: DataFrame) -> DataFrame:
    """Every staged session with its decisions: status, and its row if exported."""
    outcomes = judged.groupBy("id", "target").agg(F.collect_list(F.struct("request_id", "outcome")).alias("outcomes"))
    staged = stages.where("kind = 'staged'").select("id", "target", "body")
    return staged.join(outcomes, ["id", "target"], "left").mapInArrow(_pass(FINAL_FIELDS, _finish), FINAL_FIELDS)


def final_rows(finished: DataFrame) -> DataFrame:
    return finished.where("status = 'exported'").select(F.from_json("body", ROW_FIELDS).alias("r")).select("r.*")


CATALOG_FIELDS = "definition_sha256 string, name string, definition string"


def _definitions(record: dict) -> Iterator[dict]:
    from quern.core.jsonio import load_list

    for name, d in definitions(load_list(record["tools_json"])).items():
        yield {"definition_sha256": digest(d), "name": name, "definition": canonical(d)}


def definition_catalog(rows: DataFrame) -> DataFrame:
    """Distinct tool definitions by content hash."""
    return rows.select("tools_json").mapInArrow(_pass(CATALOG_FIELDS, _definitions), CATALOG_FIELDS).dropDuplicates(["definition_sha256"])


RESULT_FIELDS = "request_id string, result string, producer string"


def _mechanical(record: dict) -> Iterator[dict]:
    result = mechanical_result(json.loads(record["body"]))
    if result:
        yield {"request_id": record["request_id"], "result": canonical(result), "producer": result["producer"]}


def mechanical_results(requests: DataFrame) -> DataFrame:
    """Results that need no client."""
    return requests.select("request_id", "body").mapInArrow(_pass(RESULT_FIELDS, _mechanical), RESULT_FIELDS)
