"""DuckDB views of sessions that the SQL of the session queries builds on."""

from __future__ import annotations

from quern.plans.codes import SOURCE_TOOLS

_TEXT = """CASE json_type({0}) WHEN 'VARCHAR' THEN {0}->>'$' WHEN 'ARRAY' THEN array_to_string(list_transform(list_filter(from_json({0}, '["json"]'), lambda b: b->>'$.type' = 'text'), lambda b: coalesce(b->>'$.text', '')), chr(10)) ELSE '' END"""

#: s: delivered rows with their key k; m: messages; c: calls; d: definitions, the last of each name.
BASE = f"""
WITH s0 AS (
  SELECT row_number() OVER () AS k, *, CASE WHEN json_valid(messages_json) THEN messages_json ELSE 'null' END AS m0, CASE WHEN json_valid(tools_json) THEN tools_json ELSE 'null' END AS t0 FROM trajectories
), s1 AS (
  SELECT *, CASE WHEN json_type(m0) = 'VARCHAR' THEN m0->>'$' ELSE m0 END AS m1, CASE WHEN json_type(t0) = 'VARCHAR' THEN t0->>'$' ELSE t0 END AS t1 FROM s0
), s2 AS (
  SELECT *, CASE WHEN json_valid(m1) THEN m1 ELSE 'null' END AS m2, CASE WHEN json_valid(t1) THEN t1 ELSE 'null' END AS t2 FROM s1
), s AS (
  SELECT *, CASE WHEN json_type(m2) = 'ARRAY' THEN m2 ELSE '[]' END AS mj, CASE WHEN json_type(t2) = 'ARRAY' THEN t2 ELSE '[]' END AS tj FROM s2
), m AS (
  SELECT s.k, s.id, s.source_scaffold, CAST(json_array_length(mj) AS INT) AS n_messages, CAST(e.key AS INT) AS message_index, e.value AS message, e.value->>'$.role' AS role,
         message_loss_mask[CAST(e.key AS INT) + 1] AS mask, e.value->'$.content' AS content, {_TEXT.format("(e.value->'$.content')")} AS text
  FROM s, json_each(s.mj) e
), c0 AS (
  SELECT *, CASE WHEN json_type(message->'$.tool_calls') = 'ARRAY' THEN message->'$.tool_calls' ELSE '[]' END AS tc FROM m
), c AS (
  SELECT c0.k, c0.id, c0.source_scaffold, n_messages, message_index, role, mask, CAST(e.key AS INT) AS call_index, e.value->>'$.id' AS call_id, e.value->>'$.function.name' AS tool,
         json_type(e.value->'$.function.arguments') AS akind, e.value->>'$.function.arguments' AS arguments
  FROM c0, json_each(c0.tc) e
), d0 AS (
  SELECT s.k, s.id, s.source_scaffold, CAST(e.key AS INT) AS position, CASE WHEN json_type(e.value->'$.function') = 'OBJECT' THEN e.value->'$.function' ELSE e.value END AS own FROM s, json_each(s.tj) e
), d AS (
  SELECT k, id, source_scaffold, own->>'$.name' AS name, (list(own->>'$.description' ORDER BY position DESC))[1] AS description, max(position) AS position FROM d0 WHERE own->>'$.name' IS NOT NULL GROUP BY ALL
)
"""

_ROWS = ", ".join(f"('{s}', '{t}', '{k}')" for s, tools in SOURCE_TOOLS.items() for t, k in tools.items())
DISPATCH = f"(VALUES {_ROWS}) AS t(source_scaffold, tool, kind)"
LINES = "string_split(regexp_replace(regexp_replace({0}, '\\r\\n', chr(10), 'g'), '[\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{0085}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), chr(10))"
WORD = "CASE WHEN {0} = '' THEN '''''' WHEN regexp_full_match({0}, '[A-Za-z0-9_@%+=:,./-]+') THEN {0} ELSE '''' || replace({0}, '''', '''\"''\"''') || '''' END"
