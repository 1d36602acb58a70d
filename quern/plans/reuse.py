"""Reuse of finished contexts for requests with the same prompt."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.jsonio import canonical, digest
from quern.plans.clients import client_messages, envelope
from quern.plans.codes import CONTEXT_PRODUCER, Refusal
from quern.plans.requests import promotable
from quern.plans.results import evaluate
from quern.plans.sessions import _pass

PRODUCER = "reused_llm_segment_context_v2"
_PROMPT_FIELDS = "request_id string, body string, prompt_sha256 string, promotable boolean"


def _prompt(r: dict) -> Iterator[dict]:
    request = json.loads(r["body"])
    yield {"request_id": r["request_id"], "body": r["body"], "prompt_sha256": digest(client_messages(request)), "promotable": promotable(request)}


def prompts(requests: DataFrame) -> DataFrame:
    return requests.select("request_id", "body").mapInArrow(_pass(_PROMPT_FIELDS, _prompt), _PROMPT_FIELDS)


def donors(requests: DataFrame, journal: DataFrame) -> DataFrame:
    """The donor of each prompt: a context given by a client in one attempt; of
    several, that of the request staged first (id, target, seq).  A journal with
    unfinished requests is an error."""
    if journal.where("state <> 'done'").limit(1).count():
        raise Refusal("REUSE_DONOR_INCOMPLETE")
    fit = journal.where(f"producer = '{CONTEXT_PRODUCER}' and attempts = 1").select("request_id", "result")
    place = requests.groupBy("request_id").agg(F.min(F.struct("id", "target", "seq", "request_id")).alias("place"))
    both = prompts(requests).where(~F.col("promotable")).join(fit, "request_id").join(place, "request_id")
    return both.groupBy("prompt_sha256").agg(F.min("place")["request_id"].alias("donor_id"), F.min_by("result", "place").alias("donor_result"))


_REUSED_FIELDS = "request_id string, result string, producer string, donor_id string"


def _adapt(r: dict) -> Iterator[dict]:
    request, old = json.loads(r["body"]), json.loads(r["donor_result"])
    body = old["resolution"]["fallback"] if "resolution" in old else old["rewrite"]
    if old.get("resolution", {}).get("decision", "context") != "context" or old.get("resolution", {}).get("promotions"):
        raise Refusal("REUSE_REQUIRES_CONTEXT_RESULT")
    result = envelope(request, body, PRODUCER) | {"reuse": {"donor_request_id": r["donor_id"], "donor_result_sha256": digest(old), "prompt_sha256": r["prompt_sha256"], "new_http_call": False}}
    _, mask, decision = evaluate(request, result)
    if decision["decision"] != "context" or any(mask):
        raise Refusal("REUSE_CANNOT_RESTORE_SUPERVISION")
    yield {"request_id": r["request_id"], "result": canonical(result), "producer": PRODUCER, "donor_id": r["donor_id"]}


def reuse(requests: DataFrame, given: DataFrame) -> DataFrame:
    """Results of pending requests from the donors of their prompts."""
    pending = prompts(requests).where(~F.col("promotable"))
    return pending.join(given, "prompt_sha256").mapInArrow(_pass(_REUSED_FIELDS, _adapt), _REUSED_FIELDS)
