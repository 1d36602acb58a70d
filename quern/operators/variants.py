"""Nested sessions as related flat tables (problem 4).

Method: structural-variant tables.  A bottom-up tree automaton gives every
object a state, its shape; the state routes the object to the typed subtype
table of its variant, whose columns are the state's members (those of members
that are objects under dotted names, open members as JSON text).  All subtypes
of a kind keep the supertype's key (id, target_harness, own position) and the
position of their parent.  Items of arrays are rows of child tables: calls,
blocks, possible calls, spans, reasons, verified properties (verifications),
and any other as ``item``, with its owner's kind and positions and its path.
So every member of a routed object is a column or row.  What a tool parameter
says of its own properties is in their rows, not repeated in its own.

Null, blank and cut-off JSON gives no rows; JSON encoded twice is read; members
of another type than expected count as absent; repeated rows count once: rows
that agree in every column are one.  Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from quern.core.jsonio import canonical, content_text, load_list, loads
from quern.core.shared import materialize, spread

_NODE = "kind string, id string, target_harness string, parent_pos bigint, pos bigint, child string, variant string, data string, own string, plan string"
_NAMES = ["kind", "id", "target_harness", "parent_pos", "pos", "child", "variant", "data", "own", "plan"]

#: Typed columns of each kind, read from the node's data.
COLUMNS = {
    "message": "role string, text string, reasoning string, blocks bigint, calls bigint, tool_call_id string",
    "call": "call_id string, name string, arguments string, arguments_are string",
    "answer": "call_pos bigint, message_pos bigint",
    "tool": "name string, description string, parameters_are string",
    "param": "path string, type string, required boolean",
    "span": "source_index bigint",
    "region": "target_start bigint, target_end bigint, origin string, request_id string",
    "decision": "request_id string, route string, decision string, promoted_calls bigint",
    "reason": "reason string",
    "block": "type string, text string, thinking string",
    "possible_call": "call_id string",
    "verification": "name string",
    "item": "owner string, owner_parent_pos bigint, path string",
}
#: Arrays whose items have a kind of their own, by owner and path, with the test
#: of the items the kind takes; other items are of kind ``item``.
_TAKEN = {
    ("message", ("tool_calls",)): lambda v: isinstance(v, dict),
    ("message", ("content",)): lambda v: True,
    ("message", ("possible_tool_call_ids",)): lambda v: isinstance(v, str),
    ("region", ("source_indices",)): lambda v: _whole(v) is not None,
    ("decision", ("rejection_reasons",)): lambda v: isinstance(v, str),
}
#: Objects within an owner that are rows of their own.
_APART = {"region": frozenset({("review_decision",)})}
#: Members whose own members are free: their state is their type alone.
OPEN_MEMBERS = {"arguments", "parameters", "properties", "verified_properties", "usage"}
#: SQL types of a subtype table's columns by state; open members are JSON text.
_SQL = {"bool": "boolean", "int": "bigint", "number": "double"}
_TYPES = {"boolean": BooleanType(), "bigint": LongType(), "double": DoubleType(), "string": StringType()}


class ShapeAutomaton:
    """A deterministic bottom-up tree automaton over JSON values.

    The state of a scalar is its type, that of an array the set of its items'
    states, that of an object its members with their states.  States are
    numbered as they are met; ``name`` is the same for a shape everywhere."""

    def __init__(self) -> None:
        self._states: dict[tuple, int] = {}
        self._keys: list[tuple] = []
        self._texts: dict[int, str] = {}
        self._plans: dict[tuple, tuple] = {}

    def _state(self, key: tuple) -> int:
        if key not in self._states:
            self._states[key] = len(self._keys)
            self._keys.append(key)
        return self._states[key]

    def _leaf(self, value: Any) -> int:
        if isinstance(value, int) and not isinstance(value, bool) and abs(value) >= 2**63:
            return self._state(("long int",))
        return self._state(({bool: "bool", int: "int", float: "number", str: "text", type(None): "null", dict: "object", list: "array"}[type(value)],))

    def state(self, value: Any, open_value: bool = False) -> int:
        if open_value or not isinstance(value, (dict, list)):
            return self._leaf(value)

        def frame(key: str | None, v: Any) -> tuple:
            return key, v, iter(sorted(v.items())) if isinstance(v, dict) else ((None, x) for x in v), []

        stack = [frame(None, value)]
        while True:
            own, v, rest, found = stack[-1]
            for key, child in rest:
                if isinstance(child, (dict, list)) and key not in OPEN_MEMBERS:
                    stack.append(frame(key, child))
                    break
                found.append((key, self._leaf(child)))
            else:
                state = self._state(("o", tuple(found)) if isinstance(v, dict) else ("a", tuple(sorted({s for _, s in found}))))
                stack.pop()
                if not stack:
                    return state
                stack[-1][3].append((own, state))

    def _inner(self, state: int) -> list[int]:
        key = self._keys[state]
        return [s for _, s in key[1]] if key[0] == "o" else list(key[1]) if key[0] == "a" else []

    def text(self, state: int) -> str:
        """The shape written out."""
        if state not in self._texts:
            reached, stack = {state}, [state]
            while stack:
                fresh = set(self._inner(stack.pop())) - reached
                reached |= fresh
                stack += fresh
            texts: dict[int, str] = {}
            uses = Counter(s for at in reached for s in self._inner(at))
            for at in sorted(reached):  # an inner state has the lower number
                key = self._keys[at]
                if key[0] == "o":
                    texts[at] = "{" + ",".join(f"{k}:{texts[s]}" for k, s in key[1]) + "}"
                else:
                    texts[at] = "[" + "|".join(sorted(texts[s] for s in key[1])) + "]" if key[0] == "a" else key[0]
                for s in self._inner(at):
                    uses[s] -= 1
                    if not uses[s]:
                        del texts[s]
            self._texts[state] = texts[state]
        return self._texts[state]

    def name(self, value: Any) -> str:
        return self.text(self.state(value))

    def plan(self, state: int, apart: frozenset = frozenset()) -> tuple[list, list]:
        """The typed columns (name, path, SQL type, as JSON text or not) of the
        state's subtype table, and the paths of its arrays, whose items are rows
        of child tables.  Objects at the paths ``apart`` are rows of their own."""
        if (state, apart) not in self._plans:
            columns, arrays, used = [], [], set()
            stack: list[tuple[tuple, int]] = [((), state)]
            while stack:
                path, at = stack.pop()
                key = self._keys[at]
                if key[0] == "a":
                    arrays.append(path)
                elif key[0] != "o":
                    name = plain = ".".join(path) or "value"
                    while name.lower() in used:
                        name = f"{plain}#{len(used)}"
                    used.add(name.lower())
                    columns.append((name, path, _SQL.get(key[0], "string"), key[0] in ("object", "array", "long int")))
                elif not path or path not in apart:
                    stack += [((*path, k), s) for k, s in reversed(key[1])]
            self._plans[state, apart] = columns, arrays
        return self._plans[state, apart]


def _text(value: Any) -> str | None:
    return value if isinstance(value, str) else None


def _whole(value: Any) -> int | None:
    return value if isinstance(value, int) and not isinstance(value, bool) and abs(value) < 2**63 else None


def _kind_of(value: Any) -> str:
    return {dict: "object", list: "array", str: "text", type(None): "absent"}.get(type(value), "scalar")


#: The object of rows that are links alone, of one variant.
_NO_OBJECT = ...


def message_nodes(messages: list) -> Iterator[tuple]:
    """(kind, parent_pos, pos, child, object, data) of messages, calls and answers."""
    for at, m in enumerate(messages):
        if not isinstance(m, dict):
            continue
        content, calls = m.get("content"), m.get("tool_calls")
        calls = calls if isinstance(calls, list) else []
        data = {"role": _text(m.get("role")), "text": content_text(content), "reasoning": _text(m.get("reasoning_content")), "blocks": len(content) if isinstance(content, list) else None, "calls": len(calls), "tool_call_id": _text(m.get("tool_call_id"))}
        yield "message", None, at, str(at), m, data
        for k, block in enumerate(content if isinstance(content, list) else ()):
            yield "block", at, k, str(k), block, {x: _text(block.get(x)) if isinstance(block, dict) else None for x in ("type", "text", "thinking")}
        possible = m.get("possible_tool_call_ids")
        for k, call_id in enumerate(possible if isinstance(possible, list) else ()):
            if isinstance(call_id, str):
                yield "possible_call", at, k, str(k), call_id, {"call_id": call_id}
        for k, call in enumerate(calls):
            if not isinstance(call, dict):
                continue
            function = call.get("function")
            function = function if isinstance(function, dict) else {}
            arguments = function.get("arguments")
            written = arguments if isinstance(arguments, str) else None if arguments is None else canonical(arguments)
            yield "call", at, k, str(k), call, {"call_id": _text(call.get("id")), "name": _text(function.get("name")), "arguments": written, "arguments_are": _kind_of(arguments)}
            own = call.get("id")
            if not isinstance(own, str) or not own:
                continue
            for after in range(at + 1, len(messages)):
                answer = messages[after]
                if not isinstance(answer, dict) or answer.get("role") != "tool":
                    break
                if answer.get("tool_call_id") == own:
                    yield "answer", at, after, f"{k}:{after}", _NO_OBJECT, {"call_pos": k, "message_pos": after}


def _inner_schemas(schema: Any, prefix: str) -> Iterator[tuple]:
    """(path, schema, required, prefix of its properties) of the properties and
    items of a schema, path None for items."""
    if isinstance(schema, str):
        schema = loads(schema)
    if not isinstance(schema, dict):
        return
    inner = schema.get("properties")
    required = schema.get("required") if isinstance(schema.get("required"), list) else []
    for name, sub in inner.items() if isinstance(inner, dict) else ():
        yield prefix + name, sub, name in required, f"{prefix}{name}."
    items = schema.get("items")
    for item in items if isinstance(items, list) else [items]:
        yield None, item, False, prefix


def _properties(schema: Any) -> Iterator[tuple[str, Any, bool]]:
    stack = [_inner_schemas(schema, "")]
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            continue
        path, sub, required, prefix = step
        if path is not None:
            yield path, sub, required
        stack.append(_inner_schemas(sub, prefix))


def _bare(schema: Any) -> Any:
    """A property's schema without the properties that have rows of their own."""
    if not isinstance(schema, dict):
        return schema
    out: dict = {}
    stack = [(schema, out)]
    while stack:
        whole, part = stack.pop()
        for key, value in whole.items():
            if key == "properties" and isinstance(value, dict):
                continue
            if key == "items" and isinstance(value, dict):
                part[key] = {}
                stack.append((value, part[key]))
            elif key == "items" and isinstance(value, list):
                part[key] = [{} if isinstance(v, dict) else v for v in value]
                stack += [(v, into) for v, into in zip(value, part[key]) if isinstance(v, dict)]
            else:
                part[key] = value
    return out


def tool_nodes(tools: list) -> Iterator[tuple]:
    for at, tool in enumerate(tools):
        if not isinstance(tool, dict):
            continue
        own = tool.get("function") if isinstance(tool.get("function"), dict) else tool
        parameters = own.get("parameters")
        yield "tool", None, at, str(at), tool, {"name": _text(own.get("name")), "description": _text(own.get("description")), "parameters_are": _kind_of(parameters)}
        for k, (path, sub, required) in enumerate(_properties(parameters)):
            kind = sub.get("type") if isinstance(sub, dict) else None
            yield "param", at, k, path, _bare(sub), {"path": path, "type": kind if isinstance(kind, str) or kind is None else canonical(kind), "required": required}


def provenance_nodes(spans: list) -> Iterator[tuple]:
    for at, span in enumerate(spans):
        if not isinstance(span, dict):
            continue
        yield "region", None, at, str(at), span, {k: _whole(span.get(k)) for k in ("target_start", "target_end")} | {k: _text(span.get(k)) for k in ("origin", "request_id")}
        sources = span.get("source_indices")
        for k, index in enumerate(sources if isinstance(sources, list) else ()):
            if _whole(index) is not None:
                yield "span", at, k, str(index), index, {"source_index": index}
        decision = span.get("review_decision")
        if isinstance(decision, dict):
            yield "decision", at, 0, "0", decision, {k: _text(decision.get(k)) for k in ("request_id", "route", "decision")} | {"promoted_calls": _whole(decision.get("promoted_calls"))}
            reasons = decision.get("rejection_reasons")
            for k, reason in enumerate(reasons if isinstance(reasons, list) else ()):
                if isinstance(reason, str):
                    yield "reason", at, k, reason, reason, {"reason": reason}
            verified = decision.get("verified_properties")
            for k, (name, value) in enumerate(verified.items() if isinstance(verified, dict) else ()):
                yield "verification", at, k, name, value, {"name": name}


_READERS = {"messages_json": message_nodes, "tools_json": tool_nodes, "bridge_provenance_json": provenance_nodes}


def _at(value: Any, path: tuple) -> Any:
    for name in path:
        value = value[name]
    return value


def _own(shapes: ShapeAutomaton, kind: str, parent: int | None, pos: int, value: Any) -> Iterator[tuple]:
    """(kind, parent_pos, pos, child, state, data, own) of an object routed by
    its state, and of the items of its arrays that no other kind takes."""
    state, apart = shapes.state(value), _APART.get(kind, frozenset())
    columns, arrays = shapes.plan(state, apart)
    yield kind, parent, pos, None, state, None, _members(columns, value)
    stack = [("", path, _at(value, path), _TAKEN.get((kind, path))) for path in reversed(arrays)]
    while stack:
        before, path, items, taken = stack.pop()
        place, deeper = before + ".".join(path), []
        for k, item in enumerate(items):
            if taken is not None and taken(item):
                continue
            state = shapes.state(item)
            columns, arrays = shapes.plan(state)
            yield "item", pos, k, f"{kind}:{place}[{k}]", state, {"owner": kind, "owner_parent_pos": parent, "path": place}, _members(columns, item)
            deeper += [(f"{place}[{k}]" + ("." if inner else ""), inner, _at(item, inner), None) for inner in arrays]
        stack += reversed(deeper)


def _members(columns: list, value: Any) -> dict:
    out = {}
    for name, path, _, as_json in columns:
        x = _at(value, path)
        out[name] = canonical(x) if as_json else x
    return out


def _flattener(readers: list[str], kinds: frozenset | None):
    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, told = ShapeAutomaton(), set()
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5]

        def row(own: str, harness: str, kind: str, parent: int | None, pos: int, child: str, state: int, data: dict, members: dict) -> tuple:
            plan = None
            if (kind, state) not in told:  # once in a partition
                told.add((kind, state))
                plan = json.dumps([[name, sql] for name, _, sql, _ in shapes.plan(state, _APART.get(kind, frozenset()))[0]])
            return kind, own, harness, parent, pos, child, shapes.text(state), json.dumps(data), json.dumps(members), plan

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for own, harness, *texts in zip(*columns):
                if own is None:
                    continue
                for reader, text in zip(readers, texts):
                    for kind, parent, pos, child, value, data in _READERS[reader](load_list(text)):
                        if kinds is not None and kind not in kinds and "item" not in kinds:
                            continue
                        if value is _NO_OBJECT:
                            if kinds is None or kind in kinds:
                                yield kind, own, harness or "", parent, pos, child, kind, json.dumps(data), "{}", "[]"
                            continue
                        for k, up, at, below, state, inner, members in _own(shapes, kind, parent, pos, value):
                            if kinds is None or k in kinds:
                                yield row(own, harness or "", k, up, at, child if below is None else below, state, data if inner is None else inner, members)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = list(rows(batch.slice(at, 512)))
                if found:
                    clean = [tuple(x.encode("utf-8", "replace").decode() if isinstance(x, str) and not x.isascii() else x for x in r) for r in found]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*clean), types)], names=_NAMES)

    return flatten


def nodes(rows: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Every node of the nested columns of ``rows`` (id, target_harness if it
    has one, and any of messages_json, tools_json, bridge_provenance_json) with
    its variant, its supertype columns (data) and those of its subtype (own);
    ``plan`` has the names and types of the latter, in one row or more of each
    variant."""
    readers = [c for c in _READERS if c in rows.columns]
    harness = F.col("target_harness") if "target_harness" in rows.columns else F.lit("")
    wanted = frozenset(kinds) if kinds else None
    return spread(rows.select(F.col("id").cast("string"), harness.cast("string").alias("target_harness"), *readers)).mapInArrow(_flattener(readers, wanted), _NODE)


def _variant(shape: str = "variant") -> Column:
    return F.substring(F.sha2(shape, 256), 1, 16)


def _typed(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumn("data", F.from_json("data", COLUMNS[kind])).select("id", "target_harness", "parent_pos", "pos", "variant", "data.*").distinct()


def table(rows: DataFrame, kind: str) -> DataFrame:
    """The flat table of one kind: id, target_harness, parent_pos, pos, variant
    (16 hex digits of the shape's hash) and the kind's typed columns."""
    return _typed(nodes(rows, (kind,)).withColumn("variant", _variant()), kind)


def variants(rows: DataFrame) -> DataFrame:
    """The subtype tables: kind, variant, its shape and the rows routed to it."""
    out = nodes(rows).select("kind", "id", "target_harness", "parent_pos", "pos", "child", F.col("variant").alias("shape")).distinct()
    return out.groupBy("kind", "shape").agg(F.count(F.lit(1)).alias("rows")).select("kind", _variant("shape").alias("variant"), "shape", "rows")


def routed(rows: DataFrame) -> DataFrame:
    """The nodes of every kind routed to their subtype tables, written once to
    the shared folder: a folder of each kind, in it the variants in order."""
    out = nodes(rows).withColumn("shape", F.col("variant")).withColumn("variant", _variant())
    return materialize(out.sortWithinPartitions("kind", "variant"), "subtypes", "kind")


def kinds_of(tables: DataFrame) -> dict[str, DataFrame]:
    """The flat table of every kind, as ``table`` gives it, from one pass over
    the sessions: ``tables`` is what ``routed`` wrote, and each kind reads only
    its own folder."""
    return {kind: _typed(tables.where(F.col("kind") == kind), kind) for kind in COLUMNS}


def subtypes(tables: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """The typed subtype table of every (kind, variant) in ``tables``, as made
    by ``routed``: id, target_harness, parent_pos, pos and the state's columns.
    Names of the key among these are given after ``own.``."""
    keys = ["id", "target_harness", "parent_pos", "pos"]
    plans = tables.where("plan IS NOT NULL").groupBy("kind", "variant").agg(F.max("plan").alias("plan")).collect()
    out = {}
    for kind, variant, plan in plans:
        types = json.loads(plan)
        schema = StructType([StructField(name, _TYPES[sql]) for name, sql in types])
        part = tables.where((F.col("kind") == kind) & (F.col("variant") == variant)).withColumn("own", F.from_json("own", schema))
        own = [F.col("own").getField(name).alias(f"own.{name}" if name.lower() in keys else name) for name, _ in types]
        extra = [F.get_json_object("data", f"$.{x}").cast(t).alias(f"owner.{x}") for x, t in (("owner", "string"), ("owner_parent_pos", "bigint"), ("path", "string"))] if kind == "item" else []
        out[kind, variant] = part.select(*keys, *extra, *own, "child").distinct().drop("child")
    return out


def members(rows: DataFrame) -> DataFrame:
    """All subtype tables in one: kind, variant, id, target_harness, parent_pos,
    pos, child, and name and value of each of the variant's columns."""
    out = nodes(rows).withColumn("own", F.from_json("own", "map<string,string>")).withColumn("variant", _variant())
    return out.select("kind", "variant", "id", "target_harness", "parent_pos", "pos", "child", F.explode("own").alias("name", "value")).distinct()


#: The parent-child links among the nodes.
LINKS = ("call", "answer", "param", "span", "reason")


def links(rows: DataFrame) -> DataFrame:
    """id, target_harness, kind, parent_pos, child of every parent-child link,
    read from the subtype tables."""
    return routed(rows).where(F.col("kind").isin(*LINKS)).select("id", "target_harness", "kind", "parent_pos", "child")


def all_links(trajectories: DataFrame, training_rows: DataFrame) -> DataFrame:
    """Links of sessions (target_harness '') and of provenance, each once."""
    sessions = links(trajectories.select("id", "messages_json", "tools_json"))
    exported = links(training_rows.select("id", "target_harness", "bridge_provenance_json"))
    return sessions.unionByName(exported).distinct()
