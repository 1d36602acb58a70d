"""Fixed values of the session format: tools of each scaffold, target tools,
reason and requirement codes.  They are what users' data and reports hold."""

from __future__ import annotations

#: Names in generated shell text and the beginning of target call ids.
CONTENT_MARK, CONTENT_MARK_MORE = "TB_CONTENT_", "_X"
SCRIPT_MARK, SCRIPT_MARK_MORE = "TB_SCRIPT", "_END"
SCRIPT_NAME, COPY_NAME, STATUS_NAME = "tb_source_script", "tb_replace_tmp", "tb_glob_status"
CALL_ID = "tb_"
VERSION = "source-ir-target-v3"
TRAINING_VERSION = "source_ir_training_v3"

#: The tools of each source scaffold and the kind each is lowered to.
#: ``editor`` is decided by its command.
SOURCE_TOOLS = {
    "SWE-agent": {"bash": "run_command", "str_replace_editor": "editor", "submit": "finish"},
    "mini-swe-agent": {"bash": "run_command"},
    "OpenHands": {"execute_bash": "run_command", "str_replace_editor": "editor", "finish": "finish", "think": "think"},
    "Claude Code": {"Bash": "run_command", "Read": "read_file", "Edit": "replace_text", "Write": "write_file", "Glob": "find_files", "Grep": "search_text"},
    "OpenCode": {"bash": "run_command", "read": "read_file", "edit": "replace_text", "write": "write_file", "glob": "find_files", "grep": "search_text"},
    "Codex-format": {"shell": "run_command", "read_file": "read_file", "apply_patch": "apply_patch", "rg": "search_text", "delete": "delete_file"},
}
#: Fixed value: the statement by which a one-shell-per-action source declares it.
PER_ACTION_SHELL = "Directory or environment variable changes are not persistent. Every action is executed in a new subshell."
#: Fixed value: the statement of the default repository root.
TESTBED_MARK = "- MODIFY: Regular source code files in /testbed"
#: Texts that exported messages begin with or are joined by.
CONTEXT_OPENING = "Historical source context (not a new user request or target execution):"
UNCERTAIN_OPENING = "Recorded uncertainties:"
EVIDENCE_OPENING = "Original source evidence (authoritative if the summary disagrees):"
OPERATING_OPENING = "Historical source operating context (quoted record; target tools remain authoritative):\n"
NARRATION_OPENING = "Historical source assistant context:\n"
ROOT_OPENING = "Recorded initial repository path: "
#: Routes of requests, origins of exported messages, outcomes of results.
CONTEXT_ROUTE, REVIEW_ROUTE = "context_rewrite", "candidate_resolution"
PROFILE_ORIGIN, USER_ORIGIN, OPERATING_ORIGIN, NARRATION_ORIGIN = "target_profile", "source_user", "source_operating_context", "nonterminal_source_narration"
CLOSING_ORIGIN, ACTED_ORIGIN, REWRITE_ORIGIN, PROMOTED_ORIGIN = "source_final_text_to_target_finish", "source_observation_projection", "llm_context_rewrite", "verified_candidate_promotion"
REVIEW_POLICY, SUPERVISION_POLICY, OBSERVATION_POLICY = "source_evidence_recompile_v1", "inherit_source_only_after_program_acceptance", "recorded_source_projection_no_target_execution"
COALESCED = "single_file_patch_coalesced_with_one_recorded_response"
#: Kinds of evidence.
INITIAL_CWD, SNAPSHOT, READ_ACCESS, SOURCE_SUCCESS, PATCH_SUCCESS = "declared_initial_cwd", "exact_file_snapshot", "recorded_read_access", "bound_source_success", "bound_patch_success"
#: The text by which a source submits, producers of results.
SUBMISSION_MARK = "COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"
MECHANICAL, CONTEXT_PRODUCER, REVIEW_PRODUCER = "mechanical_unobserved_submission_v1", "llm_segment_context_v2", "llm_candidate_review"
READ_ONLY_KINDS = frozenset({"read_file", "find_files", "search_text", "think"})
KINDS = ("apply_patch", "write_file", "replace_text", "find_files", "delete_file", "read_file", "run_command", "search_text", "editor_action", "finish", "think", "unsupported")

UTILITIES = ("bash", "printf", "cat", "rm", "test", "sed-gnu", "rg", "mkdir", "mv", "mktemp", "tr")
EDITOR_COMMANDS = ("view", "create", "str_replace", "insert", "undo_edit")


class Target:
    """What a target harness offers."""

    def __init__(self, name: str, shell: str, editor: str, finish: str, input_to_process: bool, thinks: bool, utilities=UTILITIES, editor_commands=EDITOR_COMMANDS):
        self.name, self.shell, self.editor, self.finish = name, shell, editor, finish
        self.input_to_process, self.thinks = input_to_process, thinks
        self.utilities, self.editor_commands = frozenset(utilities), frozenset(editor_commands)


TARGETS = {t.name: t for t in (Target("openhands_sdk", "terminal", "file_editor", "finish", True, True), Target("sweagent", "bash", "str_replace_editor", "submit", False, False))}


class Refusal(ValueError):
    """A call, plan or row that can't be taken further; its text is the code."""


def _tool(name: str, description: str, properties: dict, required: list[str]) -> dict:
    return {"type": "function", "function": {"name": name, "description": description, "parameters": {"type": "object", "properties": properties, "required": required}}}


def _maybe(schema: dict) -> dict:
    return {"anyOf": [schema, {"type": "null"}], "default": None}


_TEXT, _WHOLE = {"type": "string"}, {"type": "integer"}
_COMMANDS = {"type": "string", "enum": ["view", "create", "str_replace", "insert", "undo_edit"]}
#: System text and tool schemas of each target.
PROFILES = {
    "openhands_sdk": {
        "system": "You work on a software repository through the tools given to you.",
        "tools": [
            _tool("file_editor", "View, create and edit text files.", {"command": _COMMANDS, "path": _TEXT, "file_text": _maybe(_TEXT), "old_str": _maybe(_TEXT), "new_str": _maybe(_TEXT), "insert_line": _maybe(_WHOLE | {"minimum": 0}), "view_range": _maybe({"type": "array", "items": _WHOLE})}, ["command", "path"]),
            _tool("terminal", "Run a command in a shell that keeps its state.", {"command": _TEXT, "is_input": {"type": "boolean", "default": False}, "timeout": _maybe({"type": "number", "minimum": 0}), "reset": {"type": "boolean", "default": False}}, ["command"]),
            _tool("finish", "End the task with a closing message.", {"message": _TEXT}, ["message"]),
            _tool("think", "Note a thought without any effect.", {"thought": _TEXT}, ["thought"]),
        ],
    },
    "sweagent": {
        "system": "You work on a computer through the tools given to you.",
        "tools": [
            _tool("bash", "Run a command in a shell that keeps its state.", {"command": _TEXT}, ["command"]),
            _tool("str_replace_editor", "View, create and edit text files.", {"command": _COMMANDS, "path": _TEXT, "file_text": _TEXT, "old_str": _TEXT, "new_str": _TEXT, "insert_line": _WHOLE, "view_range": {"type": "array", "items": _WHOLE}}, ["command", "path"]),
            _tool("submit", "End the task.", {}, []),
        ],
    },
}
