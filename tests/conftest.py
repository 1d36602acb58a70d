import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def session_row(**over):
    """A small session of a source with overwriting writes and literal edits."""
    import json

    tools = [{"type": "function", "function": {"name": n, "description": d, "parameters": {"type": "object", "properties": p, "required": []}}} for n, d, p in (
        ("Write", "This will overwrite the existing file.", {"file_path": {"type": "string"}, "content": {"type": "string"}}),
        ("Edit", "Replaces text.", {"file_path": {"type": "string"}, "old_string": {"type": "string"}, "new_string": {"type": "string"}, "replace_all": {"type": "boolean"}}),
        ("Bash", "Runs.", {"command": {"type": "string"}, "timeout": {"type": "number"}}),
        ("Read", "Reads.", {"file_path": {"type": "string"}, "offset": {"type": "integer"}}),
    )]

    def call(i, name, **args):
        return {"role": "assistant", "content": f"step {i}", "tool_calls": [{"id": f"c{i}", "type": "function", "function": {"name": name, "arguments": json.dumps(args)}}]}

    messages = over.pop("messages", None) or [
        {"role": "system", "content": "sys"},
        {"role": "user", "content": "<uploaded_files>\n/repo\n</uploaded_files>\nfix it"},
        call(1, "Write", file_path="/repo/a.txt", content="one\ntwo\n"),
        {"role": "tool", "content": "File created successfully at: /repo/a.txt", "tool_call_id": "c1"},
        call(2, "Edit", file_path="/repo/a.txt", old_string="two", new_string="three"),
        {"role": "tool", "content": "The file /repo/a.txt has been updated", "tool_call_id": "c2"},
        call(3, "Bash", command="ls"),
        {"role": "tool", "content": "a.txt", "tool_call_id": "c3"},
        {"role": "assistant", "content": "done"},
    ]
    row = {"id": "s1", "source_scaffold": "Claude Code", "split": "validation", "messages_json": json.dumps(messages), "tools_json": json.dumps(tools), "message_loss_mask": [int(m["role"] == "assistant") for m in messages], "task_group_key": "o__r-1", "source_dataset": "d", "source_revision": None, "teacher": None, "acceptance_basis": None, "reference_tokens": 12}
    return row | over
