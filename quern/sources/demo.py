"""A few small sessions, one of each source, to try the pipeline with."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from quern.sources.sessions import SESSION_SCHEMA

#: By source: the calls (tool, arguments, what was heard) of its session.
_CALLS = {
    "OpenHands": [("str_replace_editor", {"command": "view", "path": "/repo/a.py"}, "1  x = 1"), ("str_replace_editor", {"command": "str_replace", "path": "/repo/a.py", "old_str": "x = 1", "new_str": "x = 2"}, "edited"), ("execute_bash", {"command": "python a.py"}, ""), ("finish", {"message": "x is 2 now"}, None)],
    "SWE-agent": [("bash", {"command": "ls /repo"}, "a.py"), ("str_replace_editor", {"command": "create", "path": "/repo/b.py", "file_text": "y = 1\n"}, "created"), ("submit", {}, None)],
    "mini-swe-agent": [("bash", {"command": "cat /repo/a.py"}, "x = 1")],
    "Claude Code": [("Read", {"file_path": "/repo/a.py"}, "     1\u2192x = 1"), ("Write", {"file_path": "/repo/c.py", "content": "z = 1\n"}, "File created successfully at: /repo/c.py"), ("Edit", {"file_path": "/repo/c.py", "old_string": "z = 1", "new_string": "z = 2"}, "The file /repo/c.py has been updated"), ("Grep", {"pattern": "z"}, "/repo/c.py")],
    "OpenCode": [("glob", {"pattern": "*.py"}, "a.py"), ("bash", {"command": "git status"}, "clean")],
    "Codex-format": [("shell", {"command": json.dumps(["ls", "/repo"])}, "a.py"), ("apply_patch", {"patch": "*** Begin Patch\n*** Update File: /repo/a.py\n@@\n-x = 1\n+x = 3\n*** End Patch"}, "Execution output of [apply_patch]:\nUpdated file: /repo/a.py")],
}
_DESCRIBED = {"Write": "This will overwrite the existing file. Use the Read tool first."}


def _records() -> Iterator[dict]:
    for n, (source, calls) in enumerate(_CALLS.items()):
        tools = [{"type": "function", "function": {"name": name, "description": _DESCRIBED.get(name, name), "parameters": {"type": "object", "properties": {}}}} for name in dict.fromkeys(t for t, _, _ in calls)]
        messages = [{"role": "system", "content": "You work on a repository."}, {"role": "user", "content": "<uploaded_files>\n/repo\n</uploaded_files>\nChange the value."}]
        for k, (tool, arguments, heard) in enumerate(calls):
            messages.append({"role": "assistant", "content": f"Step {k + 1}.", "tool_calls": [{"id": f"call-{k}", "type": "function", "function": {"name": tool, "arguments": json.dumps(arguments)}}]})
            if heard is not None:
                messages.append({"role": "tool", "content": heard, "tool_call_id": f"call-{k}"})
        if calls[-1][2] is not None:
            messages.append({"role": "assistant", "content": "Done."})
        mask = [int(m["role"] == "assistant") for m in messages]
        yield {"id": f"demo-{n}", "source_scaffold": source, "split": "train", "messages_json": json.dumps(messages), "tools_json": json.dumps(tools), "message_loss_mask": mask, "task_group_key": f"demo__repo-{n}", "source_dataset": "demo", "reference_tokens": 100 + n}


def demo_sessions(spark: SparkSession) -> DataFrame:
    names = [x.split()[0] for x in SESSION_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in _records()], SESSION_SCHEMA)
