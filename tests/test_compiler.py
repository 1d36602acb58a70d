import json

import pytest
from conftest import session_row

from quern.plans.codes import PER_ACTION_SHELL, TARGETS, Refusal
from quern.plans.compiler import Evidence, GlobPolicy, compile_operation, status, wire_calls
from quern.plans.lowering import declared_root, lower, lower_session
from quern.plans.schema_check import check

BOTH = pytest.mark.parametrize("target", list(TARGETS))
AT = Evidence(cwd="/r")


def op(source, tool, told="", operating="", **args):
    return lower(source, tool, args, {"description": told}, operating)


@pytest.mark.parametrize(("source", "tool", "args", "kind"), [
    ("Claude Code", "Read", {"file_path": "/a"}, "read_file"), ("OpenCode", "edit", {"filePath": "/a", "oldString": "x", "newString": "y"}, "replace_text"), ("Codex-format", "delete", {"file_path": "/a"}, "delete_file"),
    ("Codex-format", "rg", {"pattern": "x"}, "search_text"), ("OpenHands", "think", {"thought": "t"}, "think"), ("SWE-agent", "submit", {}, "finish"), ("SWE-agent", "str_replace_editor", {"command": "insert", "path": "/a", "insert_line": 1, "new_str": "x"}, "editor_action"),
    ("SWE-agent", "str_replace_editor", {"command": "create", "path": "/a", "file_text": "x"}, "write_file"), ("Claude Code", "Glob", {"pattern": "*"}, "find_files"), ("mini-swe-agent", "bash", {"command": "ls"}, "run_command"), ("SWE-agent", "Write", {}, "unsupported"),
])
def test_kinds(source, tool, args, kind):
    assert op(source, tool, **args)["kind"] == kind


@pytest.mark.parametrize(("source", "tool", "args", "code"), [
    ("Claude Code", "Write", {"file_path": "/a", "content": "x"}, "WRITE_MODE_UNDECLARED"), ("Claude Code", "Read", {"file_path": "/a", "odd": 1, "more": 2}, "UNSUPPORTED_ARGUMENTS:more,odd"), ("Claude Code", "Edit", {"file_path": "/a", "old_string": "", "new_string": "y"}, "INVALID_TEXT:old"),
    ("SWE-agent", "str_replace_editor", {"command": "view", "path": "/a", "view_range": [1]}, "INVALID_VIEW_RANGE"), ("SWE-agent", "str_replace_editor", {"command": "jump", "path": "/a"}, "EDITOR_COMMAND_UNSUPPORTED"), ("Codex-format", "shell", {"command": "[1]"}, "INVALID_ARGV"),
    ("OpenHands", "execute_bash", {"command": "x", "is_input": "maybe"}, "INVALID_IS_INPUT"), ("Claude Code", "Bash", {"command": "x", "timeout": 1, "timeout_ms": 2}, "CONFLICTING_TIMEOUT_ARGUMENTS"), ("Claude Code", "Bash", {"command": "a\0"}, "INVALID_TEXT:command"),
])
def test_lowering_refuses(source, tool, args, code):
    with pytest.raises(Refusal, match=code):
        op(source, tool, **args)


def test_view_range_and_limits():
    assert op("SWE-agent", "str_replace_editor", command="view", path="/a", view_range=[3, 7])["parameters"]["limit"] == 5
    assert op("SWE-agent", "str_replace_editor", command="view", path="/a")["parameters"] == {"path": "/a", "start": 1, "limit": None}
    assert op("OpenCode", "read", filePath="/a")["parameters"]["limit"] == 2000


def test_scopes():
    assert op("mini-swe-agent", "bash", command="ls")["contracts"]["scope"] == "unknown"
    assert op("mini-swe-agent", "bash", "", PER_ACTION_SHELL, command="ls")["contracts"]["scope"] == "per_call"
    assert op("Codex-format", "shell", command='["a", "b c"]')["parameters"]["argv"] == ["a", "b c"]


@BOTH
def test_overwrite(target):
    told = "will overwrite the existing file. Use the Read tool first"
    plan = compile_operation(op("Claude Code", "Write", told, file_path="x", content="a\n"), target, AT)
    assert (plan["status"], plan["requirements"], plan["actions"][0]["implementation"]) == ("conditional", ["SOURCE_READ_ACCESS_PRECONDITION"], "simple_shell")
    known = Evidence(cwd="/r", read_paths=frozenset({"/r/x"}))
    assert compile_operation(op("Claude Code", "Write", told, file_path="x", content="a\n"), target, known)["status"] == "ready"
    assert compile_operation(op("Claude Code", "Write", told, file_path="x", content="a\n"), target, Evidence(cwd="/r", source_succeeded=True))["notes"]


@BOTH
def test_replace(target):
    edit = op("OpenCode", "edit", filePath="/f", oldString="b", newString="c")
    assert compile_operation(edit, target)["requirements"] == ["NATIVE_EDITOR_TEXT_NORMALIZATION_EQUIVALENCE"]
    plan = compile_operation(edit, target, Evidence(files={"/f": "a b\n"}))
    assert plan["verified_properties"] == ["literal_replace_on_full_preimage"] and plan["preimage_sha256"].keys() == {"/f"}
    assert compile_operation(edit, target, Evidence(files={"/f": "bb"}))["reason"] == "REPLACE_PREIMAGE_MATCH_CONTRACT_FAILED"
    tabs = compile_operation(edit, target, Evidence(files={"/f": "\tb"}))
    assert tabs["actions"][0]["implementation"] == ("simple_shell" if target == "sweagent" else "native")
    every = op("OpenCode", "edit", filePath="/f", oldString="b", newString="c", replaceAll=True)
    assert "sed" in compile_operation(every, target)["actions"][0]["arguments"]["command"]
    assert compile_operation(op("SWE-agent", "str_replace_editor", command="str_replace", path="/f", old_str="b"), target)["status"] == "ready"


@BOTH
def test_commands(target):
    run = compile_operation(op("SWE-agent", "bash", command="ls"), target, AT)
    assert run["actions"][0]["arguments"]["command"] == "ls" and run["status"] == "ready"
    per = compile_operation(op("mini-swe-agent", "bash", "", PER_ACTION_SHELL, command="ls"), target, AT)["actions"][0]["arguments"]["command"]
    assert per == "(\ncd -- /r || exit $?\nls\n)"
    assert compile_operation(op("Codex-format", "shell", command="ls"), target)["reason"] == "SOURCE_LOGIN_SHELL_UNDECLARED"
    assert "bash -lc" in compile_operation(op("Codex-format", "shell", "runs bash -lc", command="ls"), target)["actions"][0]["arguments"]["command"]
    assert compile_operation(op("Claude Code", "Bash", command="x", run_in_background=True), target)["reason"] == "SOURCE_RUNTIME_EXTENSION_REQUIRED"
    late = compile_operation(op("Claude Code", "Bash", command="x", timeout=5), target)
    assert late["requirements"] == ["SOURCE_TIMEOUT_LIFECYCLE_EQUIVALENCE"]
    to_process = compile_operation(op("OpenHands", "execute_bash", command="y", is_input="true"), target)
    assert (to_process["reason"] == "TARGET_HAS_NO_PROCESS_INPUT") == (target == "sweagent")


@BOTH
def test_reads_and_searches(target):
    view = compile_operation(op("Codex-format", "read_file", file_path="/f", offset=3, limit=4), target)["actions"][0]["arguments"]
    assert view["view_range"] == [3, 6]
    for bad, code in (({"offset": -1}, "READ_OFFSET"), ({"offset": True}, "READ_OFFSET"), ({"limit": 0}, "INVALID_READ_LIMIT")):
        assert compile_operation(op("Codex-format", "read_file", file_path="/f", **bad), target)["reason"].startswith(code)
    grep = compile_operation(op("Claude Code", "Grep", "by modification time", pattern="a b", path="/r", **{"-i": True, "-A": 2}), target)
    assert grep["actions"][0]["arguments"]["command"] == "rg -l -A 2 -i -- 'a b' /r" and grep["requirements"] == ["SOURCE_SEARCH_ORDER_AND_PAGINATION"]
    assert compile_operation(op("OpenCode", "grep", pattern="x", **{"-n": False}), target, AT)["actions"][0]["arguments"]["command"] == "rg -- x /r/."


@BOTH
def test_globs_with_and_without_policy(target):
    find = op("Claude Code", "Glob", "by modification time", pattern="*.py", path="/r")
    assert compile_operation(find, target)["requirements"] == ["SOURCE_GLOB_DIALECT_HIDDEN_IGNORE_SYMLINK_AND_ORDER_POLICY"]
    plan = compile_operation(find, target, Evidence(glob_policy=GlobPolicy()))
    assert plan["status"] == "ready" and "PIPESTATUS" in plan["actions"][0]["arguments"]["command"]
    assert compile_operation(find, target, Evidence(glob_policy=GlobPolicy(order="path")))["reason"] == "GLOB_ORDER_CONTRACT_CONFLICT"
    assert compile_operation(op("Claude Code", "Glob", pattern="/x", path="/r"), target)["reason"] == "GLOB_PATTERN_DIALECT_UNSUPPORTED"


def patch(*lines):
    return op("Codex-format", "apply_patch", "syntax-checked", patch="\n".join(["*** Begin Patch", *lines, "*** End Patch"]))


@BOTH
def test_patches(target):
    update = patch("*** Update File: f.py", "@@", "-a = 1", "+a = 2")
    unknown = compile_operation(update, target, AT)
    assert unknown["requirements"] == ["PATCH_FULL_PREIMAGE_AND_LINE_MATCH_EQUIVALENCE", "NATIVE_EDITOR_TEXT_NORMALIZATION_EQUIVALENCE", "PATCH_SYNTAX_CHECK_AND_ROLLBACK"]
    known = Evidence(cwd="/r", files={"/r/f.py": "a = 1\n"}, python_feature_version=(3, 11))
    plan = compile_operation(update, target, known)
    assert plan["status"] == "ready" and "python_syntax_on_full_postimage" in plan["verified_properties"]
    bad = compile_operation(patch("*** Update File: f.py", "@@", "-a = 1", "+a ="), target, known)
    assert bad["status"] == "unsupported" and not bad["actions"]
    add = compile_operation(patch("*** Add File: g.txt", "+x"), target, Evidence(cwd="/r", files={"/r/g.txt": None}, directories=frozenset({"/r"})))
    assert add["status"] == "ready" and add["verified_properties"] == ["patch_add_absent_path_and_existing_parent"]
    moved = compile_operation(patch("*** Update File: f.txt", "*** Move to: h.txt", "@@", "-a", "+b"), target, Evidence(cwd="/r", files={"/r/f.txt": "a\n"}))
    assert moved["actions"][-1]["arguments"]["command"] == "mv -- /r/f.txt /r/h.txt" and moved["requirements"] == ["PATCH_MOVE_DESTINATION_AND_PARENT_POLICY"]
    gone = compile_operation(patch("*** Delete File: f.txt", "*** Update File: f.txt", "@@", "-a", "+b"), target, AT)
    assert gone["reason"] == "PATCH_UPDATE_PATH_ABSENT"


def test_ends_and_thoughts():
    end = op("OpenHands", "finish", message="m")
    assert compile_operation(end, "openhands_sdk")["actions"][0]["arguments"] == {"message": "m"}
    assert compile_operation(end, "sweagent")["actions"][0] == {"tool": "submit", "arguments": {}, "implementation": "native"}
    assert compile_operation(op("OpenHands", "think", thought="t"), "sweagent")["reason"] == "TARGET_HAS_NO_THINK_TOOL"


def test_status_and_wire():
    assert [status("x", []), status(None, ["r"]), status(None, [])] == ["unsupported", "conditional", "ready"]
    plan = {"status": "ready", "actions": [{"tool": "t", "arguments": {"ä": 1}}, {"tool": "u", "arguments": {}}]}
    assert [c["id"] for c in wire_calls(plan, "c")] == ["c:0", "c:1"]
    assert wire_calls(plan, "c")[0]["function"]["arguments"] == '{"ä": 1}'
    with pytest.raises(Refusal, match="PLAN_NOT_READY"):
        wire_calls({"status": "conditional", "reason": None, "requirements": ["R"]}, "c")


def lowered(row):
    return lower_session(row["source_scaffold"], json.loads(row["messages_json"]), json.loads(row["tools_json"]), row["message_loss_mask"])


def test_session_calls():
    calls = lowered(session_row())
    assert [c["operation"]["kind"] for c in calls] == ["write_file", "replace_text", "run_command"]
    assert calls[0]["observation_indices"] == [3] and calls[0]["supervised"]
    with pytest.raises(Refusal, match="MASK_LENGTH_MISMATCH"):
        lowered(session_row(message_loss_mask=[1]))


def test_call_problems_are_reasons():
    def reason(change):
        row = session_row()
        messages = json.loads(row["messages_json"])
        change(messages)
        return lowered(row | {"messages_json": json.dumps(messages)})[0]["operation"]["contracts"].get("reason")

    assert reason(lambda m: m[4]["tool_calls"][0].update(id="c1")) == "NONUNIQUE_CALL_ID"
    assert reason(lambda m: m[2]["tool_calls"][0]["function"].update(arguments="[1]")) == "ARGUMENTS_NOT_OBJECT"
    assert reason(lambda m: m[2]["tool_calls"][0]["function"].update(name="Nope")) == "SOURCE_DEFINITION_MISSING"
    assert reason(lambda m: m[2]["tool_calls"][0]["function"].update(arguments='{"content": 3}')).startswith("SCHEMA:$.content")
    assert reason(lambda m: m[2]["tool_calls"][0].update(function=None)) == "ARGUMENTS_NOT_OBJECT"


def test_batches():
    row = session_row()
    messages = json.loads(row["messages_json"])
    messages[2]["tool_calls"].append({"id": "cx", "function": {"name": "Read", "arguments": {"file_path": "/a"}}})
    calls = lowered(row | {"messages_json": json.dumps(messages)})
    assert calls[0]["operation"]["contracts"]["source_batch_order_unverified"] and calls[1]["operation"]["contracts"]["source_batch_size"] == 2


def test_roots():
    assert declared_root([{"role": "user", "content": "<uploaded_files>\\n/a b \\n</uploaded_files>"}]) == "/a b"
    assert declared_root([{"role": "system", "content": "Cloned path: /x"}]) == "/x"
    assert declared_root([{"role": "user", "content": "- MODIFY: Regular source code files in /testbed"}]) == "/testbed"
    assert declared_root([{"role": "assistant", "content": "Cloned path: /x"}]) is None


@pytest.mark.parametrize(("schema", "value", "ok"), [
    ({"type": "integer"}, True, False), ({"type": "integer"}, 2.0, True), ({"enum": [1]}, True, False), ({"anyOf": [{"type": "null"}, {"minimum": 0, "type": "number"}]}, -1, False), ({"type": "object", "additionalProperties": False, "properties": {"a": {}}}, {"b": 1}, False),
    ({"type": "array", "items": {"type": "string"}, "uniqueItems": True, "minItems": 1}, ["a", "a"], False), ({"odd": 1}, 1, False), ({"description": "x", "type": ["string", "null"]}, None, True), ({"not": {"type": "string"}}, "x", False), ({"pattern": "^a"}, "b", False),
])
def test_schema(schema, value, ok):
    if ok:
        check(schema, value)
    else:
        with pytest.raises(Refusal, match="SCHEMA"):
            check(schema, value)
