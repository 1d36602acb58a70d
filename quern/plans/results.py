"""Results: what a request was answered, judged by tables of checks.

A result is either context, shown with no weight, or a promotion of calls that
compiling with recorded evidence confirms in full.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property

from quern.core.jsonio import canonical, digest
from quern.plans.codes import CONTEXT_OPENING, CONTEXT_ROUTE, EVIDENCE_OPENING, PROFILES, UNCERTAIN_OPENING, Refusal
from quern.plans.compiler import Evidence
from quern.plans.dialogue import check_dialogue, spoken
from quern.plans.requests import resolves
from quern.plans.review import bound_answers, confirmed_plan, one_action, promoted_turns
from quern.plans.schema_check import check

_FILLED = {"type": "string", "minLength": 1}


def _closed(**properties: dict) -> dict:
    return {"type": "object", "properties": properties, "required": [*properties], "additionalProperties": False}


def _several(items: dict, **more: object) -> dict:
    return {"type": "array", "items": items, **more}


#: What an answer may hold.
CONTEXT_SCHEMA = _closed(context=_FILLED, evidence=_several(_closed(message_index={"type": "integer"}, quote=_FILLED), minItems=1), uncertainties=_several({"type": "string"}))
_ACTION = _closed(tool={"type": "string"}, arguments={"type": "object"})
RESOLUTION_SCHEMA = _closed(decision={"enum": ["promote", "context"]}, promotions=_several(_closed(call_id=_FILLED, action=_ACTION, evidence_ids=_several(_FILLED, uniqueItems=True))), fallback=CONTEXT_SCHEMA)
#: Fixed value: markup of tool and chat protocols.
_MARKUP = re.compile(r"<\|[^>]*\|>|</?tool_call\b|</?function\b|\[/?INST\]", re.I)
#: The field a result has by route.
_FIELD = {True: "resolution", False: "rewrite"}


def result_field(request: dict) -> str:
    return _FIELD[resolves(request)]


def response_schema(request: dict) -> dict:
    return RESOLUTION_SCHEMA if resolves(request) else CONTEXT_SCHEMA


def _parts(value: object) -> list:
    if isinstance(value, list):
        return [b.get("text", b.get("thinking", "")) for b in value if isinstance(b, dict)]
    return [value]


def _texts(event: dict) -> list[str]:
    """What may be quoted of a message."""
    fields = (event["message"].get(name) for name in ("content", "reasoning_content"))
    return [t for t in [event["evidence_text"], *(p for value in fields for p in _parts(value))] if isinstance(t, str)]


class Case:
    """A request and its result, as the checks see them."""

    def __init__(self, request: dict, result: dict):
        self.request, self.result, self.resolves = request, result, resolves(request)
        self.given = result.get(_FIELD[self.resolves])
        self.misplaced = _FIELD[not self.resolves] in result

    @property
    def context(self) -> dict:
        return self.given["fallback"] if self.resolves else self.given

    @cached_property
    def segment(self) -> dict[int, list[str]]:
        return {e["message_index"]: _texts(e) for e in self.request["payload"]["source_messages"]}

    def fits(self) -> bool:
        check(response_schema(self.request), self.given)  # its own Refusal names the place
        return True

    def names_input(self) -> bool:
        return all(self.result.get(k) == self.request[k] for k in ("request_id", "input_sha256"))

    def quotes_within(self) -> bool:
        return all(q["message_index"] in self.segment and q["quote"].strip() for q in self._quotes_to_first_fault())

    def quotes_verbatim(self) -> bool:
        return all(any(q["quote"] in t for t in self.segment[q["message_index"]]) for q in self.context["evidence"] if q["message_index"] in self.segment)

    def _quotes_to_first_fault(self) -> Iterator[dict]:
        """Quotes up to the first that is not verbatim, as faults are told in their order."""
        for q in self.context["evidence"]:
            yield q
            if q["message_index"] in self.segment and not any(q["quote"] in t for t in self.segment[q["message_index"]]):
                return


#: (route or None for both, code, what must hold), in order; the first that fails is the result's fault.
CHECKS: tuple[tuple[bool | None, str, Callable[[Case], bool]], ...] = (
    (None, "REWRITE_INPUT_MISMATCH", Case.names_input),
    (None, "REWRITE_PAYLOAD_HASH_MISMATCH", lambda c: digest(c.request["payload"]) == c.request["input_sha256"]),
    (False, "CONTEXT_ONLY_REQUEST_CANNOT_PROMOTE", lambda c: not c.misplaced),
    (None, "SCHEMA", Case.fits),
    (True, "CONTEXT_DECISION_HAS_PROMOTIONS", lambda c: c.given["decision"] == "promote" or not c.given["promotions"]),
    (True, "AMBIGUOUS_RESULT_BODY", lambda c: not c.misplaced),
    (None, "EMPTY_REWRITE", lambda c: c.context["context"].strip() != ""),
    (None, "REWRITE_CONTAINS_PROTOCOL_TAG", lambda c: not _MARKUP.search("\n".join([c.context["context"], *c.context["uncertainties"]]))),
    (None, "REWRITE_EVIDENCE_OUTSIDE_SEGMENT", Case.quotes_within),
    (None, "REWRITE_EVIDENCE_NOT_VERBATIM", Case.quotes_verbatim),
)


def check_result(request: dict, result: dict) -> dict:
    """The context a result gives; a Refusal with its first fault."""
    case = Case(request, result)
    for route, code, holds in CHECKS:
        if route in (None, case.resolves) and not holds(case):
            raise Refusal(code)
    return case.context


def render(request: dict, result: dict) -> dict:
    """The context message of a result, with the segment itself."""
    return _rendered(request, check_result(request, result))


def _rendered(request: dict, context: dict) -> dict:
    record = [{"message_index": e["message_index"], "message": e["message"]} for e in request["payload"]["source_messages"]]
    doubts = [UNCERTAIN_OPENING, *context["uncertainties"]] if context["uncertainties"] else []
    return {"role": "user", "content": "\n".join([CONTEXT_OPENING, context["context"], *doubts, EVIDENCE_OPENING, canonical(record)])}


class Promotion:
    """Calls of a reviewed segment beside what a result proposes for them."""

    def __init__(self, payload: dict, proposals: list[dict]):
        self.payload, self.proposals, self.calls, self.entries = payload, proposals, payload["source_calls"], payload["review"]["entries"]
        self.covers = [p["call_id"] for p in proposals] == [c["call_id"] for c in self.calls]
        self.plans = [confirmed_plan(c, payload["target"], Evidence.from_dict(e["context"])) for c, e in zip(self.calls, self.entries)]

    def faults(self) -> list[str]:
        if not self.covers:
            return sorted({*self.payload["review"]["blockers"], "PROMOTION_SOURCE_CALL_COVERAGE"})
        rows = zip(self.calls, self.entries, self.plans, self.proposals)
        return sorted({*self.payload["review"]["blockers"], *(f"{code}:{call['call_id']}" for call, entry, plan, proposal in rows for code in _faults(entry, plan, proposal))})

    def outcome(self, seed: str) -> tuple[list[dict], list[int]]:
        messages = {e["message_index"]: e["message"] for e in self.payload["source_messages"]}
        out, mask = spoken(promoted_turns(self.calls, self.plans, bound_answers(self.calls, messages), messages, seed))
        check_dialogue(out, mask, PROFILES[self.payload["target"]]["tools"], self.payload["target"])
        return out, mask


def _faults(entry: dict, plan: dict, proposal: dict) -> Iterator[str]:
    action = one_action(plan)
    if action is None:
        yield "PROMOTION_UNRESOLVED_REQUIREMENTS"
    else:
        if (proposal["action"]["tool"], proposal["action"]["arguments"]) != (action["tool"], action["arguments"]):
            yield "PROMOTION_ACTION_NOT_VERIFIED"
        if {*proposal["evidence_ids"]} ^ {f["evidence_id"] for f in entry["evidence"]}:
            yield "PROMOTION_EVIDENCE_MISMATCH"


def evaluate(request: dict, result: dict) -> tuple[list[dict], list[int], dict]:
    """(messages, weights, decision) of a result: promoted calls with the
    weights of their source, or context without weight."""
    context, payload = check_result(request, result), request["payload"]
    faults: list[str] = []
    if result_field(request) == "resolution" and result["resolution"]["decision"] == "promote":
        promotion = Promotion(payload, result["resolution"]["promotions"])
        if not (faults := promotion.faults()):
            out, mask = promotion.outcome(request["request_id"])
            return out, mask, _decision(request, result, "promoted", promoted_calls=len(promotion.calls), restored_supervised_calls=sum(mask), **_proof(promotion))
    return [_rendered(request, context)], [0], _decision(request, result, "promotion_rejected_context" if faults else "context", rejection_reasons=faults)


def _decision(request: dict, result: dict, decision: str, **more: object) -> dict:
    none = {"rejection_reasons": [], "promoted_calls": 0, "restored_supervised_calls": 0}
    named = {"request_id": request["request_id"], "input_sha256": request["input_sha256"], "result_sha256": digest(result)}
    return named | {"route": request["payload"].get("route", CONTEXT_ROUTE), "decision": decision} | none | more


def _proof(promotion: Promotion) -> dict:
    """What a promotion rests on."""
    facts = {f["evidence_id"] for e in promotion.entries for f in e["evidence"]}
    return {"evidence_ids": sorted(facts), "verification_sha256": digest(promotion.payload["review"]), "verified_properties": {c["call_id"]: p["verified_properties"] for c, p in zip(promotion.calls, promotion.plans)}}
