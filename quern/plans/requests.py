"""Requests: a segment that can't be mapped, as content-addressed work.

The payload is made field by field from the segment; its hash is the request's
name.  Nothing of it is made before it is asked for, so that counting requests
costs no JSON.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from quern.core.jsonio import canonical, digest, load_list
from quern.plans.codes import CONTEXT_ROUTE, REVIEW_ROUTE, SUPERVISION_POLICY, TRAINING_VERSION
from quern.plans.lowering import definitions
from quern.plans.review import Review

#: Messages before a segment that are shown with it.
SHOWN_BEFORE = 2


@dataclass
class Region:
    """A segment of a session, its calls and plans, and why it is requested."""

    record: dict
    target: str
    indices: list[int]
    reasons: list[str]
    calls: list[dict]
    plans: list[dict]
    session: list[dict]
    review: Review | None = None

    @property
    def route(self) -> str:
        return CONTEXT_ROUTE if self.review is None else REVIEW_ROUTE

    @property
    def eligible(self) -> bool:
        return self.review is not None and self.review.eligible

    @cached_property
    def request(self) -> dict:
        payload = {name: value(self) for name, value in _PAYLOAD.items()}
        if self.review is not None:
            payload |= {name: value(self) for name, value in _REVIEWED.items()}
        own = digest(payload)
        return {"request_id": own, "input_sha256": own, "payload": payload}

    def shown(self, indices: list[int] | range) -> list[dict]:
        return [{"message_index": i, "message": self.session[i]} for i in indices]


def evidence_text(message: dict) -> str:
    """What of a message may be quoted, beside its texts."""
    return canonical({k: v for k, v in message.items() if k in ("content", "reasoning_content", "tool_calls")})


#: The fields of a payload, each with what it holds.
_PAYLOAD = {
    "version": lambda r: TRAINING_VERSION,
    "route": lambda r: r.route,
    "source_id": lambda r: r.record["id"],
    "source_archive_key": lambda r: r.record["id"],
    "source_scaffold": lambda r: r.record["source_scaffold"],
    "source_split": lambda r: r.record["split"],
    "split": lambda r: "train",
    "target": lambda r: r.target,
    "loss_mask": lambda r: 0,
    "reasons": lambda r: r.reasons,
    "source_message_indices": lambda r: r.indices,
    "source_messages": lambda r: [shown | {"evidence_text": evidence_text(shown["message"])} for shown in r.shown(r.indices)],
    "context_before": lambda r: r.shown(range(max(0, min(r.indices) - SHOWN_BEFORE), min(r.indices))),
    "source_calls": lambda r: r.calls,
    "target_candidates": lambda r: r.plans,
    "source_failure_kind": lambda r: [p["reason"] or p["status"] for p in r.plans],
}
#: The fields only reviewed segments have.
_REVIEWED = {
    "review": lambda r: r.review.as_dict(r.session),
    "supervision_policy": lambda r: SUPERVISION_POLICY,
    "source_tool_definitions": lambda r: _known_tools(r),
}


def _known_tools(r: Region) -> dict:
    known = definitions(load_list(r.record["tools_json"]))
    return {c["source_tool"]: known.get(c["source_tool"]) for c in r.calls}


def resolves(request: dict) -> bool:
    """Whether the request is of the route that may promote calls."""
    return request["payload"].get("route") == REVIEW_ROUTE


def promotable(request: dict) -> bool:
    return bool((request["payload"].get("review") or {}).get("promotion_eligible"))
