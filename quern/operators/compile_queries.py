"""Queries over lowered and compiled calls, and the SQL that says the same.

The engine's session pass gives the rows; the SQL works the same calls out from
the delivered tables alone.  Calls that the tables lack are made from those they
have: the same paths and texts as calls of tools with other contracts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.core.jsonio import load_list
from quern.core.shared import spread
from quern.operators.session_sql import BASE, DISPATCH, WORD
from quern.plans.codes import CONTENT_MARK, PER_ACTION_SHELL, PROFILES, READ_ONLY_KINDS, SCRIPT_MARK, SCRIPT_NAME, TESTBED_MARK, Refusal
from quern.plans.dialogue import check_dialogue
from quern.plans.requests import resolves
from quern.plans.results import evaluate
from quern.plans.sessions import _pass, compile_sessions, export_ready, stage_sessions
from quern.sources import sessions as S

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _add(name: str, f: Query, sql: str, doc: str) -> None:
    f.__doc__ = doc
    _QUERIES[name], _SQL[name] = f, sql


# --- the rows of the session pass

_PARAMETERS = "path string, old string, new string, mode string, content string, start bigint, limit bigint, command string, argv array<string>, cwd string, is_input boolean, timeout double, pattern string, root string, thought string, message string, patch string"
_CONTRACTS = "reason string, scope string, login boolean, native_editor_semantics boolean, source_dialect string, source_batch_size bigint, source_batch_order_unverified boolean"
_ARGUMENTS = "command string, path string, file_text string, old_str string, new_str string, view_range array<bigint>, thought string, message string, is_input boolean"
_KEY = ["id", "message_index", "call_index"]


def _compiled(spark: SparkSession, d: str, texts: bool = True) -> DataFrame:
    rows = S.read_sessions(spark, f"{d}/trajectories.parquet").withColumnRenamed("file_row_index", "source_row_index")
    return compile_sessions(rows, texts=texts)


def _opened(plans: DataFrame) -> DataFrame:
    """Plans with their operation (p: parameters, c: contracts) and first action (a)."""
    operation = F.from_json("operation_json", f"parameters struct<{_nested(_PARAMETERS)}>, contracts struct<{_nested(_CONTRACTS)}>")
    action = F.from_json("actions_json", f"array<struct<tool: string, arguments: struct<{_nested(_ARGUMENTS)}>>>")
    out = plans.where("kind <> 'refused'").withColumns({"o": operation, "actions": action})
    return out.select("*", F.col("o.parameters").alias("p"), F.col("o.contracts").alias("c"), F.try_element_at("actions", F.lit(1)).alias("a"), F.array_join("requirements", ",").alias("needed"))


def _nested(fields: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (x.split() for x in fields.split(", ")))


def _lowered(kinds: tuple[str, ...], **columns: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _opened(_compiled(spark, d)).where(F.col("kind").isin(*kinds) & (F.col("target") == "sweagent"))
        return rows.select(*_KEY, "source_tool", "supervised", *(F.expr(x).alias(n) for n, x in columns.items()))

    return run


def _planned(kinds: tuple[str, ...], **columns: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _opened(_compiled(spark, d)).where(F.col("kind").isin(*kinds))
        return rows.select(*_KEY, "target", "status", "reason", "needed", F.size("actions").cast("bigint").alias("n_actions"), F.col("a.tool").alias("tool"), *(F.expr(x).alias(n) for n, x in columns.items()))

    return run


# --- the same in SQL

_READ_ONLY = ", ".join(f"'{k}'" for k in sorted(READ_ONLY_KINDS))


def absolute_sql(path: str, cwd: str) -> str:
    return f"CASE WHEN {path} LIKE '/%' THEN {path} WHEN {cwd} LIKE '%/' THEN {cwd} || {path} ELSE {cwd} || '/' || {path} END"


def path_error_sql(path: str, cwd: str) -> str:
    return f"CASE WHEN coalesce({path}, '') = '' THEN 'INVALID_PATH' WHEN {path} NOT LIKE '/%' AND coalesce({cwd}, '') NOT LIKE '/%' THEN 'RELATIVE_PATH_REQUIRES_SOURCE_CWD' END"


#: l: lowered calls of sessions that are read; q: with directory and batch; t: the targets.
LOWERED = (
    BASE
    + f""", fine AS (
  SELECT s.k FROM s WHERE json_array_length(mj) > 0 AND json_array_length(mj) = coalesce(len(message_loss_mask), 0) AND NOT EXISTS (SELECT 1 FROM m WHERE m.k = s.k AND json_type(m.message) <> 'OBJECT')
    AND len(list_filter(message_loss_mask, lambda x: x NOT IN (0, 1))) = 0
), said AS (SELECT k, string_agg(text, chr(10) ORDER BY message_index) AS t FROM m WHERE role IN ('user', 'system') GROUP BY k),
place AS (SELECT k, t, regexp_replace(coalesce(nullif(regexp_extract(u, '<uploaded_files>\\s*(/[^\\n<]+)', 1), ''), nullif(regexp_extract(u, 'Cloned path:\\s*(/[^\\n]+)', 1), ''), CASE WHEN contains(u, '{TESTBED_MARK}') THEN '/testbed' END), '^\\s+|\\s+$', '', 'g') AS root FROM (SELECT *, replace(t, '\\n', chr(10)) AS u FROM said)),
c1 AS (
  SELECT c0.k, c0.id, c0.source_scaffold, c0.message_index, coalesce(c0.mask, 0) = 1 AS supervised, CAST(e.key AS INT) AS call_index, e.value AS call,
    CASE WHEN json_type(e.value->'$.id') = 'VARCHAR' THEN e.value->>'$.id' ELSE '' END AS call_id, CASE WHEN json_type(e.value->'$.function.name') = 'VARCHAR' THEN e.value->>'$.function.name' ELSE '' END AS tool, e.value->'$.function.arguments' AS given
  FROM c0 JOIN fine USING (k), json_each(c0.tc) e
), c2 AS (SELECT *, count(*) OVER (PARTITION BY k, call_id) AS uses, CASE json_type(given) WHEN 'VARCHAR' THEN CASE WHEN json_valid(given->>'$') THEN CAST(given->>'$' AS JSON) END ELSE given END AS args FROM c1),
c3 AS (
  SELECT c2.*, t.kind AS slot, d.name AS defined, place.root, coalesce(place.t, '') AS operating,
    CASE WHEN call_id = '' OR uses <> 1 THEN 'NONUNIQUE_CALL_ID' WHEN json_type(given) = 'VARCHAR' AND args IS NULL THEN 'ARGUMENTS_NOT_JSON' WHEN coalesce(json_type(args), 'NULL') <> 'OBJECT' THEN 'ARGUMENTS_NOT_OBJECT' WHEN d.name IS NULL THEN 'SOURCE_DEFINITION_MISSING' WHEN t.kind IS NULL THEN 'SOURCE_TOOL_UNSUPPORTED' END AS refused
  FROM c2 LEFT JOIN {DISPATCH} ON t.source_scaffold = c2.source_scaffold AND t.tool = c2.tool LEFT JOIN d ON d.k = c2.k AND d.name = c2.tool LEFT JOIN place ON place.k = c2.k
), l AS (
  SELECT *, CASE WHEN refused IS NOT NULL THEN 'unsupported' WHEN slot = 'editor' THEN CASE args->>'$.command' WHEN 'create' THEN 'write_file' WHEN 'str_replace' THEN 'replace_text' WHEN 'view' THEN 'read_file' ELSE 'editor_action' END ELSE slot END AS kind,
    coalesce(args->>'$.path', args->>'$.file_path', args->>'$.filePath') AS path, coalesce(slot = 'editor', false) AS native,
    CASE WHEN source_scaffold = 'Codex-format' THEN 'per_call' WHEN source_scaffold = 'mini-swe-agent' THEN CASE WHEN contains(operating, '{PER_ACTION_SHELL}') THEN 'per_call' ELSE 'unknown' END ELSE 'persistent' END AS scope,
    source_scaffold = 'Codex-format' AND starts_with(ltrim(args->>'$.command', ' ' || chr(9) || chr(10)), '[') AS listed
  FROM c3
), q AS (
  SELECT *, CASE WHEN coalesce(sum(CASE WHEN kind = 'run_command' AND scope = 'persistent' AND coalesce(args->>'$.is_input', 'false') <> 'true' AND coalesce(args->>'$.workdir', '') = '' THEN 1 END) OVER (PARTITION BY k ORDER BY message_index, call_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 THEN root END AS cwd,
    count(*) OVER (PARTITION BY k, message_index) AS batch, count(*) OVER (PARTITION BY k, message_index) > 1 AND count(*) FILTER (kind NOT IN ({_READ_ONLY})) OVER (PARTITION BY k, message_index) > 0 AS unordered
  FROM l
), t2 AS (SELECT * FROM (VALUES ('openhands_sdk', 'terminal', 'file_editor'), ('sweagent', 'bash', 'str_replace_editor')) AS t(target, shell, editor))"""
)

_CLAUDE_SEARCH = "CASE WHEN source_scaffold = 'Claude Code' THEN '-l' ELSE '-n' END"
_LINES = "string_split(args->>'$.patch', chr(10))"
#: Start and end of a view; -1 is the end of the file.
_START = "CASE WHEN native THEN coalesce(CAST(args->>'$.view_range[0]' AS BIGINT), 1) ELSE coalesce(CAST(args->>'$.offset' AS BIGINT), 1) END"
_LIMIT = "CASE WHEN native THEN CASE WHEN coalesce(CAST(args->>'$.view_range[1]' AS BIGINT), -1) <> -1 THEN CAST(args->>'$.view_range[1]' AS BIGINT) - CAST(args->>'$.view_range[0]' AS BIGINT) + 1 END ELSE coalesce(CAST(args->>'$.limit' AS BIGINT), CASE WHEN source_scaffold IN ('Claude Code', 'OpenCode') THEN 2000 END) END"

#: o: operations with their fields; p: plans; v: plans with their status.
PLANNED = (
    LOWERED
    + f""", o AS (
  SELECT *, {_START} AS start_line, {_LIMIT} AS line_limit, coalesce(args->>'$.old_str', args->>'$.old_string', args->>'$.oldString') AS old, coalesce(args->>'$.new_str', args->>'$.new_string', args->>'$.newString', '') AS new,
    CASE WHEN kind = 'apply_patch' THEN regexp_extract(args->>'$.patch', '\\*\\*\\* Update File: ([^\\n]*)', 1) WHEN kind IN ('search_text', 'find_files') THEN coalesce(args->>'$.path', '.') ELSE path END AS at_path,
    array_to_string(list_transform(list_filter({_LINES}, lambda x: x[1] IN ('-', ' ')), lambda x: x[2:]), chr(10)) AS patch_old, array_to_string(list_transform(list_filter({_LINES}, lambda x: x[1] IN ('+', ' ')), lambda x: x[2:]), chr(10)) AS patch_new
  FROM q
), p AS (
  SELECT o.*, t2.*, CASE
      WHEN kind = 'unsupported' THEN refused
      WHEN kind IN ('write_file', 'replace_text', 'apply_patch', 'search_text', 'find_files') THEN {path_error_sql("at_path", "cwd")}
      WHEN kind = 'read_file' THEN coalesce({path_error_sql("at_path", "cwd")}, CASE WHEN start_line < 1 THEN 'READ_OFFSET_REQUIRES_FILE_LENGTH' WHEN line_limit < 1 THEN 'INVALID_READ_LIMIT' END)
      WHEN kind = 'run_command' THEN CASE WHEN scope = 'unknown' THEN 'SOURCE_SHELL_SCOPE_UNDECLARED' WHEN scope = 'per_call' AND source_scaffold = 'Codex-format' AND NOT listed THEN 'SOURCE_LOGIN_SHELL_UNDECLARED' END
      WHEN kind = 'think' AND target = 'sweagent' THEN 'TARGET_HAS_NO_THINK_TOOL' END AS reason,
    list_concat(CASE WHEN unordered THEN ['SOURCE_BATCH_EFFECT_ORDER'] ELSE [] END, CASE
      WHEN kind = 'apply_patch' AND {path_error_sql("at_path", "cwd")} IS NULL THEN ['PATCH_FULL_PREIMAGE_AND_LINE_MATCH_EQUIVALENCE', 'NATIVE_EDITOR_TEXT_NORMALIZATION_EQUIVALENCE']
      WHEN kind = 'replace_text' AND NOT native AND {path_error_sql("at_path", "cwd")} IS NULL THEN ['NATIVE_EDITOR_TEXT_NORMALIZATION_EQUIVALENCE']
      WHEN kind = 'find_files' AND {path_error_sql("at_path", "cwd")} IS NULL THEN ['SOURCE_GLOB_DIALECT_HIDDEN_IGNORE_SYMLINK_AND_ORDER_POLICY']
      WHEN kind = 'run_command' AND scope = 'persistent' AND coalesce(args->>'$.timeout', args->>'$.timeout_ms', args->>'$.command_timeout') IS NOT NULL THEN ['SOURCE_TIMEOUT_LIFECYCLE_EQUIVALENCE'] ELSE [] END) AS requirements,
    {absolute_sql("at_path", "cwd")} AS whole_path
  FROM o, t2
), v AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN 'unsupported' WHEN len(requirements) > 0 THEN 'conditional' ELSE 'ready' END AS status, array_to_string(requirements, ',') AS needed, CAST(CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_actions,
    CASE WHEN reason IS NULL THEN CASE WHEN kind IN ('write_file', 'replace_text', 'read_file', 'apply_patch') THEN editor WHEN kind = 'think' THEN 'think' ELSE shell END END AS act,
    CASE kind WHEN 'think' THEN 'native' WHEN 'run_command' THEN 'source_shell' WHEN 'search_text' THEN 'simple_shell' WHEN 'find_files' THEN 'simple_shell' ELSE 'native' END AS how
  FROM p
) """
)


def _lowered_sql(kind: str, **columns: str) -> str:
    return LOWERED + ", o AS (SELECT *, " + f"{_START} AS start_line, {_LIMIT} AS line_limit FROM q) " + f"SELECT id, message_index, call_index, tool AS source_tool, supervised, {', '.join(f'{x} AS {n}' for n, x in columns.items())} FROM o WHERE kind = '{kind}'"


def _planned_sql(kind: str, **columns: str) -> str:
    return PLANNED + f"SELECT id, message_index, call_index, target, status, reason, needed, n_actions, act AS tool, {', '.join(f"CASE WHEN reason IS NULL THEN {x}{' ELSE 0' if n in ('first', 'last') else ''} END AS {n}" for n, x in columns.items())} FROM v WHERE kind = '{kind}'"


_BATCH = {"batch": "coalesce(c.source_batch_size, 1)", "unordered": "coalesce(c.source_batch_order_unverified, false)"}
_BATCH_SQL = {"batch": "batch", "unordered": "unordered"}
_NATIVE = {"native": "coalesce(c.native_editor_semantics, false)"}
_NATIVE_SQL = {"native": "native"}


def _both(name: str, kind: str, lowered: dict[str, str], lowered_sql: dict[str, str], planned: dict[str, str], planned_sql: dict[str, str], doc: str) -> None:
    _add(f"lowered_{name}", _lowered((kind,), **lowered, **_BATCH), _lowered_sql(kind, **lowered_sql, **_BATCH_SQL), f"{doc}: parameters and contracts of every call lowered to {kind}.")
    _add(f"planned_{name}", _planned((kind,), **planned), _planned_sql(kind, **planned_sql), f"{doc}: status, reason, requirements and action of each target.")


_both("creates", "write_file", {"path": "p.path", "content": "p.content", "mode": "p.mode"} | _NATIVE, {"path": "path", "content": "args->>'$.file_text'", "mode": "'create'"} | _NATIVE_SQL,
      {"command": "a.arguments.command", "path": "a.arguments.path", "text": "a.arguments.file_text"}, {"command": "'create'", "path": "whole_path", "text": "args->>'$.file_text'"}, "Files created by editors")
_both("edits", "replace_text", {"path": "p.path", "old": "p.old", "new": "p.new", "mode": "p.mode"} | _NATIVE, {"path": "path", "old": "coalesce(args->>'$.old_str', args->>'$.old_string', args->>'$.oldString')", "new": "coalesce(args->>'$.new_str', args->>'$.new_string', args->>'$.newString', '')", "mode": "'unique'"} | _NATIVE_SQL,
      {"command": "a.arguments.command", "path": "a.arguments.path", "old": "a.arguments.old_str", "new": "a.arguments.new_str"}, {"command": "'str_replace'", "path": "whole_path", "old": "old", "new": "new"}, "Texts replaced")
_both("reads", "read_file", {"path": "p.path", "start": "p.start", "limit": "coalesce(p.limit, -1)"} | _NATIVE, {"path": "path", "start": "start_line", "limit": "coalesce(line_limit, -1)"} | _NATIVE_SQL,
      {"command": "a.arguments.command", "path": "a.arguments.path", "first": "coalesce(a.arguments.view_range[0], 0)", "last": "coalesce(a.arguments.view_range[1], 0)"},
      {"command": "'view'", "path": "whole_path", "first": "CASE WHEN start_line <> 1 OR line_limit IS NOT NULL THEN start_line ELSE 0 END", "last": "CASE WHEN start_line = 1 AND line_limit IS NULL THEN 0 WHEN line_limit IS NULL THEN -1 ELSE start_line + line_limit - 1 END"}, "Files read")
_both("commands", "run_command", {"command": "p.command", "scope": "c.scope", "login": "c.login", "listed": "p.argv is not null"}, {"command": "CASE WHEN NOT listed THEN args->>'$.command' END", "scope": "scope", "login": "source_scaffold = 'Codex-format' AND NOT listed", "listed": "listed"},
      {"command": "a.arguments.command"}, {"command": f"CASE WHEN listed THEN '(' || chr(10) || CASE WHEN cwd IS NOT NULL THEN 'cd -- ' || {WORD.format('cwd')} || ' || exit $?' || chr(10) ELSE '' END || array_to_string(list_transform(from_json(args->>'$.command', '[\"varchar\"]'), lambda w: {WORD.format('w')}), ' ') || chr(10) || ')' ELSE args->>'$.command' END"}, "Commands run")
_both("searches", "search_text", {"pattern": "p.pattern", "path": "p.path", "dialect": "c.source_dialect"}, {"pattern": "args->>'$.pattern'", "path": "args->>'$.path'", "dialect": "source_scaffold"},
      {"command": "a.arguments.command"}, {"command": f"'rg ' || {_CLAUDE_SEARCH} || ' -- ' || {WORD.format("(args->>'$.pattern')")} || ' ' || {WORD.format('whole_path')}"}, "Texts searched")
_both("globs", "find_files", {"pattern": "p.pattern", "root": "p.root"}, {"pattern": "args->>'$.pattern'", "root": "args->>'$.path'"},
      {"command": "a.arguments.command"}, {"command": f"'rg --no-config --files --glob ' || {WORD.format("(args->>'$.pattern')")} || ' -- ' || {WORD.format('whole_path')}"}, "Files found")
_both("thoughts", "think", {"thought": "p.thought"}, {"thought": "args->>'$.thought'"}, {"thought": "a.arguments.thought"}, {"thought": "args->>'$.thought'"}, "Thoughts")
_both("patches", "apply_patch", {"patch": "p.patch"}, {"patch": "args->>'$.patch'"},
      {"command": "a.arguments.command", "path": "a.arguments.path", "old": "a.arguments.old_str", "new": "a.arguments.new_str"}, {"command": "'str_replace'", "path": "whole_path", "old": "patch_old", "new": "patch_new"}, "Patches")
_both("refusals", "unsupported", {"reason": "c.reason"}, {"reason": "refused"}, {"command": "a.arguments.command"}, {"command": "NULL::VARCHAR"}, "Calls that can't be lowered")


# --- counts over all plans


def compile_status(spark: SparkSession, d: str) -> DataFrame:
    """Calls by scaffold, kind, target and status, with distinct reasons."""
    return _compiled(spark, d, texts=False).where("kind <> 'refused'").groupBy("source_scaffold", "kind", "target", "status").agg(F.count(F.lit(1)).alias("calls"), F.sum(F.size("tools")).alias("actions"), F.count_distinct("reason").alias("reasons"))


def compile_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Unsupported reasons and unmet requirements by target; refused sessions under ``any``."""
    codes = F.when(F.col("reason").isNotNull(), F.array(F.struct(F.lit("reason").alias("what"), F.col("reason").alias("code")))).otherwise(F.transform("requirements", lambda r: F.struct(F.lit("requirement").alias("what"), r.alias("code"))))
    return _compiled(spark, d, texts=False).select(F.coalesce("target", F.lit("any")).alias("target"), F.explode(codes).alias("c")).groupBy("target", "c.what", "c.code").agg(F.count(F.lit(1)).alias("n"))


def compile_implementations(spark: SparkSession, d: str) -> DataFrame:
    """How the actions of plans are done."""
    return _compiled(spark, d, texts=False).select("target", "kind", F.explode("implementations").alias("implementation")).groupBy("target", "kind", "implementation").agg(F.count(F.lit(1)).alias("n"))


_add("compile_status", compile_status, PLANNED + "SELECT source_scaffold, kind, target, status, count(*) AS calls, CAST(sum(n_actions) AS BIGINT) AS actions, count(DISTINCT reason) AS reasons FROM v GROUP BY 1, 2, 3, 4", compile_status.__doc__)
_add("compile_reasons", compile_reasons, PLANNED + """SELECT target, what, code, count(*) AS n FROM (
  SELECT target, 'reason' AS what, reason AS code FROM v WHERE reason IS NOT NULL UNION ALL SELECT target, 'requirement', unnest(requirements) FROM v WHERE reason IS NULL
  UNION ALL SELECT 'any', 'reason', CASE WHEN json_array_length(mj) = 0 THEN 'SESSION_UNREADABLE' WHEN EXISTS (SELECT 1 FROM m WHERE m.k = s.k AND json_type(m.message) <> 'OBJECT') THEN 'MESSAGE_NOT_OBJECT' WHEN json_array_length(mj) <> coalesce(len(message_loss_mask), 0) THEN 'MASK_LENGTH_MISMATCH' ELSE 'SOURCE_MASK_INVALID' END FROM s WHERE k NOT IN (SELECT k FROM fine)
) GROUP BY 1, 2, 3""", compile_reasons.__doc__)  # fmt: skip
_add("compile_implementations", compile_implementations, PLANNED + "SELECT target, kind, how AS implementation, count(*) AS n FROM v WHERE reason IS NULL GROUP BY 1, 2, 3", compile_implementations.__doc__)


# --- staging: blocks, the binding of their answers, routes and rows

#: b: blocks with what they are; bound: the assignments of answers to calls each
#: has; why: what speaks against turns, by target; st: what becomes of each block.
STAGED = (
    PLANNED.replace("WITH s0 AS", "WITH RECURSIVE s0 AS", 1)
    + f""", g0 AS (SELECT m.*, coalesce(role = 'tool' AND last_value(CASE WHEN role IS DISTINCT FROM 'tool' THEN coalesce(role, '') END IGNORE NULLS) OVER w = 'assistant', false) AS absorbed FROM m JOIN fine USING (k) WINDOW w AS (PARTITION BY m.k ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, max(CASE WHEN NOT absorbed THEN message_index END) OVER (PARTITION BY k ORDER BY message_index) AS block,
    CASE WHEN json_type(message->'$.reasoning_content') NOT IN ('NULL', 'VARCHAR') THEN 'NON_TEXT_REASONING' WHEN json_type(content) NOT IN ('NULL', 'VARCHAR', 'ARRAY') THEN 'NON_TEXT_CONTENT'
      WHEN json_type(content) = 'ARRAY' THEN 'NON_TEXT_CONTENT_BLOCK:' || (list_filter(from_json(content, '["json"]'), lambda x: coalesce(x->>'$.type' NOT IN ('text', 'thinking'), true))[1]->>'$.type') END AS bad,
    length(coalesce(message->>'$.reasoning_content', '')) + CASE json_type(content) WHEN 'VARCHAR' THEN length(content->>'$') WHEN 'ARRAY' THEN list_sum(list_transform(from_json(content, '["json"]'), lambda x: coalesce(length(CASE WHEN x->>'$.type' = 'thinking' THEN x->>'$.thinking' ELSE x->>'$.text' END), 0))) ELSE 0 END AS chars
  FROM g0),
ids AS (SELECT k, message_index AS block, list(call_id ORDER BY call_index) AS ids, list(DISTINCT kind) AS kinds FROM l GROUP BY 1, 2),
b AS (SELECT g.k, g.id, g.block, any_value(g.role) FILTER (NOT absorbed) AS role, any_value(coalesce(mask, 0)) FILTER (NOT absorbed) AS weight, any_value(bad) FILTER (NOT absorbed) AS bad, any_value(chars) FILTER (NOT absorbed) AS chars, count(*) FILTER (absorbed) AS answers, max(message_index) = max(n_messages) - 1 AS last, count(*) AS size,
    list(bad ORDER BY message_index) FILTER (absorbed AND bad IS NOT NULL) AS bad_answers, any_value(ids) AS ids FROM g LEFT JOIN ids ON ids.k = g.k AND ids.block = g.block GROUP BY 1, 2, 3),
heard AS (SELECT k, block, row_number() OVER (PARTITION BY k, block ORDER BY message_index) AS nth, CASE WHEN message->>'$.tool_call_id' <> '' THEN list_intersect([message->>'$.tool_call_id'], ids) WHEN json_type(message->'$.possible_tool_call_ids') = 'ARRAY' THEN list_intersect(from_json(message->'$.possible_tool_call_ids', '["varchar"]'), ids) ELSE ids END AS options
  FROM g JOIN b USING (k, block) WHERE absorbed AND ids IS NOT NULL),
tried AS (SELECT k, block, 0 AS nth, []::VARCHAR[] AS used FROM b WHERE ids IS NOT NULL AND len(ids) = answers AND len(list_distinct(ids)) = len(ids)
  UNION ALL SELECT h.k, h.block, CAST(h.nth AS INT), list_append(used, o) FROM tried JOIN heard h ON h.k = tried.k AND h.block = tried.block AND h.nth = tried.nth + 1, unnest(h.options) AS t(o) WHERE NOT list_contains(used, o)),
bound AS (SELECT b.k, b.block, CASE WHEN len(list_distinct(ids)) < len(ids) OR list_contains(ids, '') THEN 'NONUNIQUE_CALL_ID' WHEN len(ids) <> answers THEN 'SOURCE_RESULT_COUNT_MISMATCH' WHEN EXISTS (SELECT 1 FROM heard h WHERE h.k = b.k AND h.block = b.block AND len(options) = 0) THEN 'SOURCE_RESULT_NO_MATCH'
    ELSE (SELECT CASE count(*) WHEN 0 THEN 'SOURCE_RESULT_NO_BIJECTION' WHEN 1 THEN NULL ELSE 'SOURCE_RESULT_AMBIGUOUS' END FROM tried t WHERE t.k = b.k AND t.block = b.block AND t.nth = b.answers) END AS fault FROM b WHERE ids IS NOT NULL),
why AS (
  SELECT k, message_index AS block, target, unnest(CASE WHEN reason IS NOT NULL THEN [reason] ELSE requirements END) AS code FROM v
  UNION ALL SELECT k, block, target, fault FROM bound, t2 WHERE fault IS NOT NULL
  UNION ALL SELECT k, block, target, coalesce(b.bad, bad_answers[1]) FROM b LEFT JOIN bound USING (k, block), t2 WHERE ids IS NOT NULL AND (b.bad IS NOT NULL OR (fault IS NULL AND bad_answers IS NOT NULL))
), planned AS (SELECT k, message_index AS block, target, count(*) AS calls, count(*) FILTER (status <> 'unsupported') AS possible FROM v GROUP BY 1, 2, 3),
st AS (
  SELECT *, CASE WHEN reasons <> '' THEN CASE WHEN possible > 0 THEN 'candidate_resolution' ELSE 'context_rewrite' END WHEN role = 'assistant' AND calls > 0 THEN 'source_observation_projection' WHEN role = 'user' THEN 'source_user' WHEN role <> 'assistant' THEN 'source_operating_context' WHEN last AND chars > 0 THEN 'source_final_text_to_target_finish' ELSE 'nonterminal_source_narration' END AS what
  FROM (SELECT b.*, target, coalesce(calls, 0) AS calls, coalesce(possible, 0) AS possible, CASE WHEN role = 'assistant' AND calls > 0 THEN coalesce((SELECT string_agg(DISTINCT code, ',' ORDER BY code) FROM why WHERE why.k = b.k AND why.block = b.block AND why.target = t2.target), '')
      WHEN role = 'assistant' AND size > 1 THEN 'TOOL_RESULT_WITHOUT_LOCAL_CALL' WHEN coalesce(role, '') NOT IN ('assistant', 'system', 'developer', 'user') OR calls > 0 THEN 'ORPHAN_SOURCE_MESSAGE' ELSE coalesce(bad, '') END AS reasons
    FROM b CROSS JOIN t2 LEFT JOIN planned USING (k, block, target))
) """
)


def _staged(spark: SparkSession, d: str, kinds: tuple[str, ...]) -> DataFrame:
    rows = S.read_sessions(spark, f"{d}/trajectories.parquet").withColumnRenamed("file_row_index", "source_row_index")
    return stage_sessions(rows, kinds=kinds, bodies=False)


def staged_blocks(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of every block: origin or route, reasons, messages and weights."""
    rows = _staged(spark, d, ("segment",)).where("seq > 0")
    return rows.select("id", "target", F.col("source_indices")[0].alias("block"), F.size("source_indices").cast("bigint").alias("size"), F.col("status").alias("what"), F.array_join("reasons", ",").alias("reasons"), F.col("counts")["messages"].alias("messages"), F.col("counts")["weight"].alias("weight"))


def staged_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Each session's status and staging counts that don't rest on reviews."""
    rows = _staged(spark, d, ("staged",)).where("status <> 'invalid_dialogue'")
    counts = {n: F.coalesce(F.col("counts")[n], F.lit(0)) for n in ("rewrite_regions", "rewrite_source_calls", "mapped_source_calls", "supervised_target_calls", "final_text_to_finish")}
    return rows.select("id", "target", "status", *(c.alias(n) for n, c in counts.items()))


def staged_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Requests by target, route and reason."""
    rows = _staged(spark, d, ("request",))
    return rows.select("target", "route", F.explode("reasons").alias("reason")).groupBy("target", "route", "reason").agg(F.count(F.lit(1)).alias("requests"))


_TURNS = "CASE WHEN what = 'source_observation_projection' THEN calls ELSE 0 END"
_add("staged_blocks", staged_blocks, STAGED + f"SELECT id, target, block, size, what, reasons, CASE WHEN reasons <> '' THEN 0 WHEN what = 'source_observation_projection' THEN 2 * calls ELSE 1 END AS messages, CASE WHEN what = 'source_final_text_to_target_finish' THEN weight ELSE weight * {_TURNS} END AS weight FROM st", staged_blocks.__doc__)
_add("staged_sessions", staged_sessions, STAGED + f""", per AS (SELECT k, id, target, count(*) FILTER (reasons <> '') AS rewrite_regions, CAST(coalesce(sum(calls) FILTER (reasons <> ''), 0) AS BIGINT) AS rewrite_source_calls, CAST(sum({_TURNS}) AS BIGINT) AS mapped_source_calls, CAST(sum(weight * {_TURNS}) AS BIGINT) AS supervised_target_calls,
  count(*) FILTER (what = 'source_final_text_to_target_finish') AS final_text_to_finish, CAST(coalesce(sum(weight) FILTER (what = 'source_final_text_to_target_finish'), 0) AS BIGINT) AS closing FROM st GROUP BY 1, 2, 3)
SELECT id, target, CASE WHEN rewrite_regions > 0 THEN 'pending_rewrites' WHEN supervised_target_calls + closing = 0 THEN 'no_supervised_messages' ELSE 'exported' END AS status, rewrite_regions, rewrite_source_calls, mapped_source_calls, supervised_target_calls, final_text_to_finish FROM per""", staged_sessions.__doc__)  # fmt: skip
_add("staged_reasons", staged_reasons, STAGED + "SELECT target, what AS route, reason, count(*) AS requests FROM (SELECT target, what, unnest(string_split(reasons, ',')) AS reason FROM st WHERE reasons <> '') GROUP BY 1, 2, 3", staged_reasons.__doc__)


# --- protocol, assembly and judgement


def _faults_of(record: dict) -> Iterator[dict]:
    messages, mask = load_list(record["messages_json"]), record["message_loss_mask"] or []
    if not messages or not all(isinstance(m, dict) and isinstance(m.get("role"), str) for m in messages):
        return
    try:
        code = "sound" if check_dialogue(messages, mask, PROFILES["sweagent"]["tools"], "sweagent") else ""
    except Refusal as e:
        code = str(e)
    yield {"id": record["id"], "fault": code}


def dialogue_faults(spark: SparkSession, d: str) -> DataFrame:
    """The first fault of each recorded dialogue, read as one of a target."""
    fields = "id string, fault string"
    rows = S.read_sessions(spark, f"{d}/trajectories.parquet").select("id", "messages_json", "message_loss_mask")
    return spread(rows).mapInArrow(_pass(fields, _faults_of), fields)


_DIALOGUE = """, whole AS (SELECT s.k, s.id, json_array_length(mj) AS n, coalesce(len(message_loss_mask), 0) AS n_mask FROM s WHERE json_array_length(mj) > 0 AND NOT EXISTS (SELECT 1 FROM m WHERE m.k = s.k AND (json_type(message) <> 'OBJECT' OR role IS NULL))),
dm AS (SELECT c0.*, CAST(json_array_length(tc) AS INT) AS n_calls, tc->0->>'$.id' AS own, tc->0->>'$.function.name' AS named, json_type(tc->0->'$.function.arguments') AS given, lag(CASE WHEN json_array_length(tc) > 0 THEN tc->0->>'$.id' END) OVER (PARTITION BY k ORDER BY message_index) AS opened FROM c0 JOIN whole USING (k, id)),
du AS (SELECT *, CASE WHEN n_calls = 1 THEN count(*) FILTER (n_calls > 0) OVER (PARTITION BY k, own ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE 0 END AS earlier FROM dm),
df AS (SELECT k, message_index, CASE WHEN mask IS NULL OR mask NOT IN (0, 1) OR (mask = 1 AND role <> 'assistant') THEN 'INVALID_SUPERVISION_ROLE' WHEN coalesce(json_type(content), 'NULL') <> 'VARCHAR' THEN 'TARGET_CONTENT_NOT_TEXT' WHEN opened IS NOT NULL AND (role <> 'tool' OR (message->>'$.tool_call_id') IS DISTINCT FROM opened) THEN 'UNPAIRED_TARGET_CALL'
    WHEN opened IS NULL AND role = 'tool' THEN 'ORPHAN_TARGET_RESULT' WHEN n_calls > 0 THEN CASE WHEN role <> 'assistant' OR n_calls <> 1 THEN 'TARGET_REQUIRES_SINGLE_CALL_MESSAGE' WHEN coalesce(own, '') = '' OR earlier > 0 OR coalesce(tc->0->>'$.type', '') <> 'function' THEN 'INVALID_TARGET_CALL_ID' WHEN coalesce(named, '') NOT IN ('bash', 'str_replace_editor', 'submit') OR given <> 'VARCHAR' THEN 'INVALID_TARGET_TOOL' END
    WHEN role = 'assistant' AND mask = 1 THEN 'SUPERVISED_PLAIN_TEXT_TERMINATION' END AS fault FROM du)
SELECT w.id, CASE WHEN n <> n_mask THEN 'MASK_LENGTH_MISMATCH' ELSE coalesce((SELECT arg_min(fault, message_index) FROM df WHERE df.k = w.k AND fault IS NOT NULL), CASE WHEN (SELECT arg_max(n_calls, message_index) FROM dm WHERE dm.k = w.k) > 0 THEN 'MISSING_TARGET_RESULT' ELSE 'sound' END) END AS fault FROM whole w"""
_add("dialogue_faults", dialogue_faults, BASE + _DIALOGUE, dialogue_faults.__doc__)


def assembled_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows of sessions that need no results: messages, weights, how they end."""
    rows = S.read_sessions(spark, f"{d}/trajectories.parquet").withColumnRenamed("file_row_index", "source_row_index")
    weight = F.aggregate("message_loss_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sources = F.flatten(F.from_json("bridge_provenance_json", "array<struct<source_indices: array<bigint>>>").getField("source_indices"))
    return export_ready(rows).select("id", "target_harness", "source_split", "split", F.size("message_loss_mask").cast("bigint").alias("messages"), weight.alias("weight"), F.col("has_target_finish").alias("ends"), "rewrite_count", F.size(sources).cast("bigint").alias("sources"))


_add("assembled_rows", assembled_rows, STAGED + f""", per AS (SELECT st.k, st.id, target, count(*) FILTER (reasons <> '') AS rewrites, CAST(1 + sum(CASE WHEN what = 'source_observation_projection' THEN 2 * calls ELSE 1 END) AS BIGINT) AS messages, CAST(sum(CASE WHEN what = 'source_final_text_to_target_finish' THEN weight ELSE weight * {_TURNS} END) AS BIGINT) AS weight,
  count(*) FILTER (what = 'source_final_text_to_target_finish') > 0 AS ends, CAST(sum(size) AS BIGINT) AS sources FROM st GROUP BY 1, 2, 3)
SELECT per.id, target AS target_harness, s.split AS source_split, 'train' AS split, messages, weight, ends, CAST(0 AS BIGINT) AS rewrite_count, sources FROM per JOIN s USING (k) WHERE rewrites = 0 AND weight > 0""", assembled_rows.__doc__)  # fmt: skip

#: What is wrong with the result made for a request, by its block's number modulo their count, and the code it is refused with.
_WRONG = ({}, {"context": "  "}, {"uncertainties": ["<tool_call>"]}, {"evidence": [{"message_index": -1, "quote": "x"}]}, {"evidence": []}, {"input_sha256": "0"}, {"quote": "\x00 never said"})
_REFUSED = ("context", "EMPTY_REWRITE", "REWRITE_CONTAINS_PROTOCOL_TAG", "REWRITE_EVIDENCE_OUTSIDE_SEGMENT", "SCHEMA:{}evidence:minItems", "REWRITE_INPUT_MISMATCH", "REWRITE_EVIDENCE_NOT_VERBATIM")


def _judged(record: dict) -> Iterator[dict]:
    request = json.loads(record["body"])
    first = request["payload"]["source_messages"][0]
    wrong = dict(_WRONG[first["message_index"] % len(_WRONG)])
    quote = {"message_index": first["message_index"], "quote": wrong.pop("quote", first["evidence_text"][:20])}
    over = {k: wrong.pop(k) for k in ("input_sha256",) if k in wrong}
    context = {"context": "It happened.", "evidence": [quote], "uncertainties": []} | wrong
    body = {"resolution": {"decision": "context", "promotions": [], "fallback": context}} if resolves(request) else {"rewrite": context}
    try:
        code = evaluate(request, {"request_id": request["request_id"], "input_sha256": request["input_sha256"], "producer": "test"} | body | over)[2]["decision"]
    except Refusal as e:
        code = str(e)
    yield {"id": record["id"], "target": record["target"], "block": first["message_index"], "code": code}


def judged_results(spark: SparkSession, d: str) -> DataFrame:
    """How results are judged that are sound or have one fault each."""
    fields = "id string, target string, block int, code string"
    rows = S.read_sessions(spark, f"{d}/trajectories.parquet").withColumnRenamed("file_row_index", "source_row_index")
    return stage_sessions(rows, kinds=("request",)).select("id", "target", "body").mapInArrow(_pass(fields, _judged), fields)


_CODES = " ".join(f"WHEN {n} THEN " + (f"'{code}'" if "{}" not in code else f"CASE what WHEN 'candidate_resolution' THEN '{code.format('$.fallback.')}' ELSE '{code.format('$.')}' END") for n, code in enumerate(_REFUSED))
_add("judged_results", judged_results, STAGED + f"SELECT id, target, block, CASE block % {len(_REFUSED)} {_CODES} END AS code FROM st WHERE reasons <> ''", judged_results.__doc__)


# --- calls of other tools, made of those there are

#: The directory such calls are in, and the tools, by name: description and properties.
_PLACE = "/srv/a b"
_TOOLS = {
    "write": ("This will overwrite the existing file.", ("filePath", "content")),
    "edit": ("Edits.", ("filePath", "oldString", "newString", "replaceAll")),
    "delete": ("Deletes.", ("file_path",)),
    "read_file": ("Reads.", ("path", "offset", "limit")),
    "finish": ("Ends.", ("message",)),
    "submit": ("Ends.", ()),
    "execute_bash": ("Runs.", ("command", "is_input", "timeout")),
    "shell": ("Runs bash -lc.", ("command", "workdir")),
    "bash": ("Runs.", ("command",)),
    "str_replace_editor": ("Edits.", ("command", "path", "insert_line", "new_str")),
}


def _other_session(case: int, source: str, tool: str, arguments: dict[str, str], system: str) -> Column:
    """A session of one call of ``tool``, its arguments made of an editor call's."""
    described, names = _TOOLS[tool]
    tools = json.dumps([{"type": "function", "function": {"name": tool, "description": described, "parameters": {"type": "object", "properties": {n: {} for n in names}}}}])
    written = F.to_json(F.struct(*(F.expr(x).alias(n) for n, x in arguments.items()))) if arguments else F.lit("{}")
    call = F.struct(F.lit("c").alias("id"), F.lit("function").alias("type"), F.struct(F.lit(tool).alias("name"), written.alias("arguments")).alias("function"))
    said = F.struct(F.lit("user").alias("role"), F.lit(f"<uploaded_files>\n{_PLACE}\n</uploaded_files>\n{system}").alias("content"), F.lit(None).cast(_CALLS).alias("tool_calls"))
    messages = F.to_json(F.array(said, F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"), F.array(call).alias("tool_calls"))))
    return F.struct(F.lit(str(case)).alias("split"), F.lit(source).alias("source_scaffold"), messages.alias("messages_json"), F.lit(tools).alias("tools_json"))


_CALLS = "array<struct<id: string, type: string, function: struct<name: string, arguments: string>>>"


def _other(name: str, of: str, cases: list[tuple], doc: str) -> None:
    """Plans of sessions made of every editor call with command ``of``.  cases:
    source, tool, arguments (Spark SQL), system text; and in SQL kind, reason,
    requirements, command, message, is_input, each for target t."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        calls = S.calls(S.messages(S.read_sessions(spark, f"{d}/trajectories.parquet"))).where("tool = 'str_replace_editor'")
        calls = calls.withColumn("args", F.from_json("arguments", "command string, path string, file_text string, old_str string, new_str string")).where((F.col("args.command") == of) & F.col("args.path").isNotNull())
        made = F.array(*(_other_session(n, source, tool, arguments, system) for n, (source, tool, arguments, system, _) in enumerate(cases)))
        rows = calls.select(F.concat_ws("#", "id", "message_index", "call_index").alias("id"), F.explode(made).alias("s")).select("id", "s.*", F.array(F.lit(0), F.lit(1)).alias("message_loss_mask"))
        plans = _opened(compile_sessions(rows))
        arguments = [F.col(f"a.arguments.{x}").alias(x) for x in ("command", "message")]
        return plans.select(F.col("split").cast("int").alias("case"), "id", "target", "kind", "status", "reason", "needed", F.col("a.tool").alias("tool"), *arguments, F.coalesce("a.arguments.is_input", F.lit(False)).alias("is_input"))

    texts = []
    for n, (_, _, _, _, sql) in enumerate(cases):
        reason, command = sql.get("reason", "NULL::VARCHAR"), sql.get("command", "NULL::VARCHAR")
        texts.append(
            f"SELECT {n} AS \"case\", e.id || '#' || message_index || '#' || call_index AS id, target, '{sql['kind']}' AS kind, CASE WHEN {reason} IS NOT NULL THEN 'unsupported' WHEN {sql.get('needed', "''")} <> '' THEN 'conditional' ELSE 'ready' END AS status, {reason} AS reason, {sql.get('needed', "''")} AS needed, "
            f"CASE WHEN {reason} IS NULL THEN {sql.get('tool', 'shell')} END AS tool, CASE WHEN {reason} IS NULL THEN {command} END AS command, CASE WHEN {reason} IS NULL THEN {sql.get('message', 'NULL::VARCHAR')} END AS message, {reason} IS NULL AND {sql.get('is_input', 'false')} AS is_input FROM e, t2 WHERE of = '{of}'"
        )
    edits = ", e AS (SELECT c.id, message_index, call_index, arguments->>'$.command' AS of, arguments->>'$.path' AS path, arguments->>'$.file_text' AS body, arguments->>'$.old_str' AS old, coalesce(arguments->>'$.new_str', '') AS new FROM c WHERE tool = 'str_replace_editor' AND json_valid(arguments) AND arguments->>'$.path' IS NOT NULL)"
    targets = ", t2 AS (SELECT * FROM (VALUES ('openhands_sdk', 'terminal', 'file_editor'), ('sweagent', 'bash', 'str_replace_editor')) AS t(target, shell, editor)) "
    _add(name, run, BASE + edits + targets + " UNION ALL ".join(texts), doc)


_P = "args.path"
_ABS = absolute_sql("path", f"'{_PLACE}'")
_AT = WORD.format(f"({_ABS})")
_IN_PLACE = f"'cd -- ' || {WORD.format(f"'{_PLACE}'")} || ' || exit $?' || chr(10)"
_WRITE = f"CASE WHEN body LIKE '%' || chr(10) THEN 'cat > ' || {_AT} || ' <<''{CONTENT_MARK}' || substr(sha256(body), 1, 16) || '''' || chr(10) || body || '{CONTENT_MARK}' || substr(sha256(body), 1, 16) ELSE 'printf ''%s'' ' || {WORD.format('body')} || ' > ' || {_AT} END"
_FIND = "replace(regexp_replace(old, '([\\\\.\\[*^$|])', '\\\\\\1', 'g'), chr(10), '\\n')"
_PUT = "replace(regexp_replace(new, '([\\\\&|])', '\\\\\\1', 'g'), chr(10), '\\n')"
_TEST, _CHANGE = WORD.format(f"('\\|' || {_FIND} || '|q0; $q1')"), WORD.format(f"('s|' || {_FIND} || '|' || {_PUT} || '|g')")
_SED = f"""'( test -f ' || {_AT} || ' && test -s ' || {_AT} || ' && LC_ALL=C sed -z -n ' || {_TEST} || ' -- ' || {_AT} || ' || exit $?; tb_replace_tmp=$(mktemp) || exit $?; trap ''rm -f -- "$tb_replace_tmp"'' EXIT; LC_ALL=C sed -z ' || {_CHANGE} || ' -- ' || {_AT} || ' > "$tb_replace_tmp" && cat -- "$tb_replace_tmp" > ' || {_AT} || ' )'"""
_LS = "concat('ls -- ', args.path)"

_other("other_writes", "create", [
    ("OpenCode", "write", {"filePath": _P, "content": "args.file_text"}, "", {"kind": "write_file", "command": _WRITE}),
], "Files overwritten with exact bytes, by here-documents or printf.")
_other("other_replacements", "str_replace", [
    ("OpenCode", "edit", {"filePath": _P, "oldString": "args.old_str", "newString": "coalesce(args.new_str, '')", "replaceAll": "true"}, "", {"kind": "replace_text", "command": _SED}),
], "All places of a text replaced by sed.")
_other("other_deletes", "view", [
    ("Codex-format", "delete", {"file_path": _P}, "", {"kind": "delete_file", "command": f"'test -f ' || {_AT} || ' && rm -- ' || {_AT}"}),
], "Files deleted.")
_other("other_reads", "view", [
    ("Codex-format", "read_file", {"path": _P, "offset": "-5"}, "", {"kind": "read_file", "reason": "'READ_OFFSET_REQUIRES_FILE_LENGTH'"}),
    ("Codex-format", "read_file", {"path": _P, "offset": "3", "limit": "0"}, "", {"kind": "read_file", "reason": "'INVALID_READ_LIMIT'"}),
    ("Codex-format", "read_file", {"path": "''"}, "", {"kind": "unsupported", "reason": "'INVALID_TEXT:path'"}),
], "Reads that refer to what isn't known.")
_other("other_finishes", "view", [
    ("OpenHands", "finish", {"message": _P}, "", {"kind": "finish", "tool": "CASE target WHEN 'sweagent' THEN 'submit' ELSE 'finish' END", "message": "CASE WHEN target <> 'sweagent' THEN path END"}),
    ("SWE-agent", "submit", {}, "", {"kind": "finish", "tool": "CASE target WHEN 'sweagent' THEN 'submit' ELSE 'finish' END", "message": "CASE WHEN target <> 'sweagent' THEN '' END"}),
], "Sessions that end by a tool.")
_other("other_editor_actions", "view", [
    ("OpenHands", "str_replace_editor", {"command": "'insert'", "path": _P, "insert_line": "2", "new_str": "'x'"}, "", {"kind": "editor_action", "tool": "editor", "command": "'insert'"}),
    ("OpenHands", "str_replace_editor", {"command": "'undo_edit'", "path": _P}, "", {"kind": "editor_action", "tool": "editor", "command": "'undo_edit'"}),
    ("OpenHands", "str_replace_editor", {"command": "'jump'", "path": _P}, "", {"kind": "unsupported", "reason": "'EDITOR_COMMAND_UNSUPPORTED'"}),
], "Editor commands of other kinds.")
_other("other_commands", "view", [
    ("OpenHands", "execute_bash", {"command": _LS, "is_input": "'true'"}, "", {"kind": "run_command", "reason": "CASE WHEN target = 'sweagent' THEN 'TARGET_HAS_NO_PROCESS_INPUT' END", "command": "'ls -- ' || path", "is_input": "true"}),
    ("OpenHands", "execute_bash", {"command": _LS, "timeout": "5"}, "", {"kind": "run_command", "needed": "'SOURCE_TIMEOUT_LIFECYCLE_EQUIVALENCE'", "command": "'ls -- ' || path"}),
    ("Codex-format", "shell", {"command": "to_json(array('ls', 'a b', args.path))", "workdir": "'/w w'"}, "", {"kind": "run_command", "command": f"'(' || chr(10) || 'cd -- ''/w w'' || exit $?' || chr(10) || 'ls ''a b'' ' || {WORD.format('path')} || chr(10) || ')'"}),
    ("Codex-format", "shell", {"command": _LS}, "", {"kind": "run_command", "command": f"'(' || chr(10) || 'IFS= read -r -d '''' {SCRIPT_NAME} <<''{SCRIPT_MARK}'' || :' || chr(10) || {_IN_PLACE} || 'ls -- ' || path || chr(10) || '{SCRIPT_MARK}' || chr(10) || 'bash -lc \"${{{SCRIPT_NAME}%?}}\"' || chr(10) || ')'"}),
    ("mini-swe-agent", "bash", {"command": _LS}, PER_ACTION_SHELL, {"kind": "run_command", "command": f"'(' || chr(10) || {_IN_PLACE} || 'ls -- ' || path || chr(10) || ')'"}),
], "Commands as process input, with a time limit, as word lists, in login shells and in shells of one action.")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
