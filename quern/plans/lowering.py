"""Lowering: every tool call of a session as a typed operation.

An operation is ``{kind, parameters, contracts}``.  Which reader a call gets is
looked up by scaffold and tool; a reader takes the call's arguments and the
tool's description, and refuses with a code what it can't take over exactly.
Refused calls are operations of kind ``unsupported`` with their reason.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable
from typing import Any

from quern.core.jsonio import canonical, content_text, digest, loads
from quern.plans.codes import PER_ACTION_SHELL, READ_ONLY_KINDS, SOURCE_TOOLS, TESTBED_MARK, Refusal
from quern.plans.patches import read_patch
from quern.plans.schema_check import check

_MISSING = object()
_ROOTS = (re.compile(r"<uploaded_files>\s*(/[^\n<]+)"), re.compile(r"Cloned path:\s*(/[^\n]+)"))


class Arguments:
    """A call's arguments, of which only ``allowed`` names may occur."""

    def __init__(self, values: dict, allowed: str):
        more = sorted(values.keys() - set(allowed.split()))
        if more:
            raise Refusal("UNSUPPORTED_ARGUMENTS:" + ",".join(more))
        self.values = values

    def first(self, *names: str, default: Any = None) -> Any:
        return next((self.values[n] for n in names if n in self.values), default)

    def text(self, label: str, *names: str, filled: bool = False, default: Any = None) -> str:
        value = self.first(*names, default=default)
        if not isinstance(value, str) or "\0" in value or (filled and value == ""):
            raise Refusal("INVALID_TEXT:" + label)
        return value

    def path(self) -> str:
        return self.text("path", "path", "file_path", "filePath", filled=True)

    def needed(self, name: str) -> Any:
        if name not in self.values:
            raise Refusal(f"'{name}'")
        return self.values[name]


# Fixed values in the readers below: argument names, parameter and contract names,
# texts looked for in descriptions, and codes, as the sources and users' data have them.


def _operation(kind: str, parameters: dict, /, **contracts: Any) -> dict:
    return {"kind": kind, "parameters": parameters, "contracts": contracts}


def _patch(source: str, values: dict, told: str, _: str) -> dict:
    a = Arguments(values, "patch cwd")
    files = [c.as_dict() for c in read_patch(a.needed("patch"))]
    return _operation("apply_patch", {"files": files, "patch": a.values["patch"], "cwd": a.first("cwd")}, matching="exact_lines", contextless_update="error", syntax_check_python="syntax-checked" in told, rollback_on_syntax_error="rolled back" in told, source_format="codex_patch", newline_policy="source_patch_text", parent_creation="source_runtime_unspecified")


def _write(source: str, values: dict, told: str, _: str) -> dict:
    a = Arguments(values, "file_path filePath content")
    if "overwrite the existing file" not in told:
        raise Refusal("WRITE_MODE_UNDECLARED")
    return _operation("write_file", {"path": a.path(), "content": a.text("content", "content"), "mode": "overwrite"}, encoding="utf-8", preserve_content_bytes=True, read_before_overwrite="Read tool first" in told, create_parents=False)


def _edit(source: str, values: dict, told: str, _: str) -> dict:
    a = Arguments(values, "file_path filePath old_string oldString new_string newString replace_all replaceAll")
    old, new = a.text("old", "old_string", "oldString", filled=True), a.text("new", "new_string", "newString")
    mode = "all" if a.first("replace_all", "replaceAll", default=False) else "unique"
    return _operation("replace_text", {"path": a.path(), "old": old, "new": new, "mode": mode}, matching="literal", missing_match="error_without_modification", encoding="utf-8", read_before_edit="Read tool" in told or "Read` tool" in told)


def _order(told: str) -> str:
    return "mtime" if "modification time" in told else "unspecified"


def _glob(source: str, values: dict, told: str, _: str) -> dict:
    a = Arguments(values, "pattern path")
    return _operation("find_files", {"root": a.first("path"), "pattern": a.text("pattern", "pattern", filled=True)}, dialect=source, order=_order(told), hidden_files="unspecified", ignore_files="unspecified", symlinks="unspecified", output="file_paths")


def _delete(source: str, values: dict, told: str, _: str) -> dict:
    return _operation("delete_file", {"path": Arguments(values, "file_path").path()}, missing="error", kind="regular_file", recursive=False)


def _read(source: str, values: dict, told: str, _: str) -> dict:
    a = Arguments(values, "file_path filePath path offset limit")
    whole = 2000 if source in ("Claude Code", "OpenCode") else None
    return _operation("read_file", {"path": a.path(), "start": a.first("offset", default=1), "limit": a.first("limit", default=whole)}, line_base=1, negative_offset=source == "Codex-format", presentation="source_numbered_lines")


def _editor(source: str, values: dict, told: str, _: str) -> dict:
    a = Arguments(values, "command path file_text old_str new_str insert_line view_range")
    command, path = a.needed("command"), a.path()
    if command == "create":
        return _operation("write_file", {"path": path, "content": a.text("content", "file_text"), "mode": "create"}, existing="error", native_editor_semantics=True)
    if command == "str_replace":
        return _operation("replace_text", {"path": path, "old": a.text("old", "old_str", filled=True), "new": a.text("new", "new_str", default=""), "mode": "unique"}, missing_match="error_without_modification", native_editor_semantics=True)
    if command == "view":
        view = a.first("view_range", default=[1, -1])
        if not isinstance(view, list) or len(view) != 2:
            raise Refusal("INVALID_VIEW_RANGE")
        limit = None if view[1] == -1 else view[1] - view[0] + 1
        return _operation("read_file", {"path": path, "start": view[0], "limit": limit}, line_base=1, native_editor_semantics=True)
    if command in ("insert", "undo_edit"):
        return _operation("editor_action", dict(values), native_editor_semantics=True)
    raise Refusal("EDITOR_COMMAND_UNSUPPORTED")


def _shell(source: str, values: dict, told: str, operating: str) -> dict:
    a = Arguments(values, "command description timeout timeout_ms command_timeout workdir mode is_input run_in_background dangerouslyDisableSandbox")
    command, argv = a.text("command", "command"), None
    if source == "Codex-format" and command.lstrip()[:1] == "[":
        try:
            argv = json.loads(command)
        except ValueError as e:
            raise Refusal("INVALID_ARGV") from e
        if not isinstance(argv, list) or not argv or any(not isinstance(x, str) or "\0" in x for x in argv):
            raise Refusal("INVALID_ARGV")
    scope = {"mini-swe-agent": "per_call" if PER_ACTION_SHELL in operating else "unknown", "Codex-format": "per_call"}.get(source, "persistent")
    to_process = a.first("is_input", default=False)
    if to_process not in (True, False, "true", "false"):
        raise Refusal("INVALID_IS_INPUT")
    limits = [values[k] for k in ("timeout_ms", "timeout", "command_timeout") if values.get(k) is not None]
    if len(limits) > 1:
        raise Refusal("CONFLICTING_TIMEOUT_ARGUMENTS")
    parameters = {"command": None if argv else command, "argv": argv, "cwd": a.first("workdir"), "is_input": to_process in (True, "true"), "timeout": limits[0] if limits else None, "timeout_unit": "seconds" if source == "OpenHands" else "milliseconds"}
    return _operation("run_command", parameters, scope=scope, login=source == "Codex-format" and argv is None, login_declared="-lc" in told, background=bool(a.first("run_in_background")), sandbox_override=bool(a.first("dangerouslyDisableSandbox")), original_mode=a.first("mode"))


def _search(source: str, values: dict, told: str, _: str) -> dict:
    Arguments(values, "pattern path glob include type output_mode -A -B -C -n -i multiline head_limit offset ignore_case max_count")
    return _operation("search_text", dict(values), source_dialect=source, order=_order(told))


def _finish(source: str, values: dict, told: str, _: str) -> dict:
    return _operation("finish", {"message": values.get("message", "")})


def _think(source: str, values: dict, told: str, _: str) -> dict:
    return _operation("think", {"thought": values.get("thought", "")})


_READERS: dict[str, Callable[[str, dict, str, str], dict]] = {
    "apply_patch": _patch, "write_file": _write, "replace_text": _edit, "find_files": _glob, "delete_file": _delete, "read_file": _read,
    "editor": _editor, "run_command": _shell, "search_text": _search, "finish": _finish, "think": _think,
}


def lower(source: str, tool: str, values: dict, definition: dict, operating: str = "") -> dict:
    """The operation of one call; a Refusal if its arguments don't fit."""
    slot = SOURCE_TOOLS.get(source, {}).get(tool)
    if slot is None:
        return _operation("unsupported", {"source_tool": tool, "arguments": values}, reason="SOURCE_TOOL_UNSUPPORTED")
    told = definition.get("description")
    return _READERS[slot](source, values, told if isinstance(told, str) else "", operating)


def definitions(tools: list) -> dict[str, dict]:
    """Definitions by name, wrapped or not; the last of a name holds."""
    flat = (t.get("function", t) for t in tools if isinstance(t, dict))
    return {f["name"]: f for f in flat if isinstance(f, dict) and isinstance(f.get("name"), str)}


def tool_calls(message: Any) -> list:
    """Calls of a message; null and anything but an array count as none."""
    calls = message.get("tool_calls") if isinstance(message, dict) else None
    return calls if isinstance(calls, list) else []


def texts_of(messages: list, roles: tuple[str, ...]) -> str:
    return "\n".join(content_text(m.get("content")) for m in messages if m.get("role") in roles)


def declared_root(messages: list) -> str | None:
    """The repository's path where the user or system messages declare one."""
    text = texts_of(messages, ("user", "system")).replace("\\n", "\n")
    for pattern in _ROOTS:
        if m := pattern.search(text):
            return m[1].strip()
    return "/testbed" if TESTBED_MARK in text else None


def _arguments(call: dict, definition: dict | None, seen: Counter) -> dict:
    own = call.get("id")
    if not own or seen[own] != 1:
        raise Refusal("NONUNIQUE_CALL_ID")
    values = (call.get("function") or {}).get("arguments")
    if isinstance(values, str):
        try:
            values = json.loads(values)
        except ValueError as e:
            raise Refusal("ARGUMENTS_NOT_JSON") from e
    if not isinstance(values, dict):
        raise Refusal("ARGUMENTS_NOT_OBJECT")
    if definition is None:
        raise Refusal("SOURCE_DEFINITION_MISSING")
    schema = definition.get("parameters")
    schema = loads(schema) if isinstance(schema, str) else schema  # some are delivered as text
    check(canonical({} if schema is None else schema), values)
    return values


def lower_session(source: str, messages: list, tools: list, mask: list) -> list[dict]:
    """The calls of a session in order, each with its operation, bound
    observations and supervision.  A mask of another length refuses the session."""
    if len(mask) != len(messages):
        raise Refusal("MASK_LENGTH_MISMATCH")
    known, operating = definitions(tools), texts_of(messages, ("system", "user"))
    hashes = {name: digest(d) for name, d in known.items()}
    seen = Counter(c.get("id") for m in messages for c in tool_calls(m) if isinstance(c, dict) and isinstance(c.get("id"), str))
    answers: dict[str, list[int]] = {}
    for at, m in enumerate(messages):
        if m.get("role") == "tool" and isinstance(m.get("tool_call_id"), str) and m["tool_call_id"]:
            answers.setdefault(m["tool_call_id"], []).append(at)
    last_assistant = max((at for at, m in enumerate(messages) if m.get("role") == "assistant"), default=-1)
    out = []
    for at, m in enumerate(messages):
        batch = []
        for k, call in enumerate(tool_calls(m)):
            call = call if isinstance(call, dict) else {}
            function = call.get("function") if isinstance(call.get("function"), dict) else {}
            name, own = function.get("name", ""), call.get("id")
            name, own = name if isinstance(name, str) else "", own if isinstance(own, str) else ""
            try:
                operation = lower(source, name, _arguments(call, known.get(name), seen), known.get(name) or {}, operating)
                if operation["kind"] == "finish" and last_assistant > at:
                    operation["contracts"]["nonterminal"] = True
            except (ValueError, TypeError) as e:
                operation = _operation("unsupported", {"source_tool": name}, reason=(str(e).splitlines() or ["UNREADABLE_ARGUMENTS"])[0][:240])
            batch.append({"call_id": own, "source": source, "source_tool": name, "message_index": at, "call_index": k, "operation": operation, "original_call": call, "definition_sha256": hashes.get(name), "observation_indices": answers.get(own, []), "supervised": bool(mask[at])})
        if len(batch) > 1:
            ordered = not all(c["operation"]["kind"] in READ_ONLY_KINDS for c in batch)
            for c in batch:
                c["operation"]["contracts"] |= {"source_batch_size": len(batch), "source_batch_order_unverified": ordered}
        out += batch
    return out
