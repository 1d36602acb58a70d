"""Queries of problem 4 over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.operators import variants
from quern.operators.session_sql import BASE


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/trajectories.parquet").select("id", "messages_json", "tools_json")


def _exported(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/training_rows.parquet").select("id", "target_harness", "bridge_provenance_json")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.all_links(_sessions(spark, d), _exported(spark, d))


def _table(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _exported(spark, d) if kind in ("span", "region", "decision", "reason", "verification") else _sessions(spark, d)
        out = variants.table(rows, kind)
        return out.unionByName(variants.table(_exported(spark, d), kind)).distinct() if kind == "item" else out

    return run


def p4_variants(spark: SparkSession, d: str) -> DataFrame:
    return variants.variants(_sessions(spark, d)).unionByName(variants.variants(_exported(spark, d)))


def p4_members(spark: SparkSession, d: str) -> DataFrame:
    return variants.members(_sessions(spark, d)).unionByName(variants.members(_exported(spark, d)))


def _plain(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    """A kind's flat table without the shape of its rows, as SQL can make it; -1
    stands for no number."""
    return lambda spark, d: _table(kind)(spark, d).drop("variant").fillna(-1).distinct()


#: Kinds whose flat tables have SQL.
_IN_SQL = ("message", "answer", "tool", "region", "span", "decision", "reason", "block")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p4_found": p4_found, "p4_variants": p4_variants, "p4_members": p4_members} | {f"p4_{kind}s": _table(kind) for kind in variants.COLUMNS} | {f"nested_{kind}s": _plain(kind) for kind in _IN_SQL}


_LINKS = (
    BASE.replace("WITH s0 AS", "WITH RECURSIVE s0 AS")
    + """, called AS (SELECT k, id, message_index, call_index, CASE WHEN ctype = 'VARCHAR' THEN call_id END AS call_id FROM (SELECT c0.k, c0.id, message_index, CAST(e.key AS INT) AS call_index, e.value->>'$.id' AS call_id, json_type(e.value->'$.id') AS ctype, json_type(e.value) AS kind FROM c0, json_each(c0.tc) e) WHERE kind = 'OBJECT'),
answers AS (SELECT k, message_index, CASE WHEN json_type(message->'$.tool_call_id') = 'VARCHAR' THEN message->>'$.tool_call_id' END AS call_id, max(CASE WHEN role IS DISTINCT FROM 'tool' THEN message_index END) OVER (PARTITION BY k ORDER BY message_index) AS opener, role FROM m),
params AS (
  SELECT k, id, position, '' AS prefix, NULL::VARCHAR AS path, CASE WHEN json_type(own->'$.parameters') = 'VARCHAR' THEN CASE WHEN json_valid(own->>'$.parameters') THEN CAST(own->>'$.parameters' AS JSON) ELSE 'null'::JSON END ELSE own->'$.parameters' END AS schema FROM d0
  UNION ALL
  SELECT k, id, position, CASE WHEN n IS NULL THEN prefix ELSE prefix || n || '.' END, CASE WHEN n IS NULL THEN NULL ELSE prefix || n END, v FROM (
    SELECT k, id, position, prefix, unnest(list_concat(
      CASE WHEN json_type(schema->'$.properties') = 'OBJECT' THEN list_transform(json_keys(schema->'$.properties'), lambda x: {'n': x, 'v': json_extract(schema->'$.properties', '$."' || x || '"')}) ELSE [] END,
      CASE WHEN json_type(schema->'$.items') = 'OBJECT' THEN [{'n': NULL::VARCHAR, 'v': schema->'$.items'}] ELSE [] END), recursive := true) FROM params WHERE json_type(schema) = 'OBJECT')
),
p0 AS (SELECT id, target_harness, CASE WHEN json_valid(bridge_provenance_json) THEN bridge_provenance_json ELSE 'null' END AS a FROM training_rows), p1 AS (SELECT id, target_harness, CASE WHEN json_type(a) = 'VARCHAR' THEN a->>'$' ELSE a END AS b FROM p0),
p2 AS (SELECT id, target_harness, CASE WHEN json_valid(b) THEN b ELSE 'null' END AS j FROM p1), regions AS (SELECT p2.id, target_harness, CAST(e.key AS BIGINT) AS pos, e.value AS region FROM p2, json_each(CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE '[]' END) e)
SELECT DISTINCT * FROM (
  SELECT id, '' AS target_harness, 'call' AS kind, CAST(message_index AS BIGINT) AS parent_pos, CAST(call_index AS VARCHAR) AS child FROM called
  UNION ALL SELECT c.id, '', 'answer', CAST(c.message_index AS BIGINT), c.call_index || ':' || a.message_index FROM called c JOIN answers a ON a.k = c.k AND a.opener = c.message_index AND a.role = 'tool' AND a.call_id = c.call_id AND c.call_id <> ''
  UNION ALL SELECT id, '', 'param', CAST(position AS BIGINT), path FROM params WHERE path IS NOT NULL
  UNION ALL SELECT r.id, target_harness, 'span', pos, CAST(e.value AS VARCHAR) FROM regions r, json_each(coalesce(region->'$.source_indices', '[]'::JSON)) e
  UNION ALL SELECT r.id, target_harness, 'reason', pos, e.value->>'$' FROM regions r, json_each(coalesce(region->'$.review_decision.rejection_reasons', '[]'::JSON)) e
)"""
)


#: Everything before the links themselves.
_NODES = _LINKS[: _LINKS.index("SELECT DISTINCT * FROM (")]
_WHOLE = "CASE WHEN json_type({0}) IN ('UBIGINT', 'BIGINT') THEN CAST({0} AS BIGINT) ELSE -1 END"
_STRING = "CASE WHEN json_type({0}) = 'VARCHAR' THEN {0}->>'$' END"
_ARE = "CASE json_type({0}) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'text' WHEN 'NULL' THEN 'absent' ELSE CASE WHEN {0} IS NULL THEN 'absent' ELSE 'scalar' END END"
_S, _W = _STRING.format, _WHOLE.format
_OBJECTS = ", om AS (SELECT * FROM m WHERE json_type(message) = 'OBJECT'), oc AS (SELECT c0.k, c0.id, message_index, CAST(e.key AS BIGINT) AS call_index, e.value AS call FROM c0, json_each(c0.tc) e WHERE json_type(e.value) = 'OBJECT'), orr AS (SELECT * FROM regions WHERE json_type(region) = 'OBJECT') "
_TABLES = {
    "message": f"SELECT DISTINCT id, '' AS target_harness, CAST(-1 AS BIGINT) AS parent_pos, CAST(message_index AS BIGINT) AS pos, {_S("(message->'$.role')")} AS role, text, {_S("(message->'$.reasoning_content')")} AS reasoning, CASE WHEN json_type(content) = 'ARRAY' THEN CAST(json_array_length(content) AS BIGINT) ELSE -1 END AS blocks, CASE WHEN json_type(message->'$.tool_calls') = 'ARRAY' THEN CAST(json_array_length(message->'$.tool_calls') AS BIGINT) ELSE 0 END AS calls, {_S("(message->'$.tool_call_id')")} AS tool_call_id FROM om",
    "answer": "SELECT DISTINCT c.id, '' AS target_harness, CAST(c.message_index AS BIGINT) AS parent_pos, CAST(a.message_index AS BIGINT) AS pos, CAST(c.call_index AS BIGINT) AS call_pos, CAST(a.message_index AS BIGINT) AS message_pos FROM called c JOIN answers a ON a.k = c.k AND a.opener = c.message_index AND a.role = 'tool' AND a.call_id = c.call_id AND c.call_id <> ''",
    "tool": f"SELECT DISTINCT id, '' AS target_harness, CAST(-1 AS BIGINT) AS parent_pos, CAST(position AS BIGINT) AS pos, {_S("(own->'$.name')")} AS name, {_S("(own->'$.description')")} AS description, {_ARE.format("(own->'$.parameters')")} AS parameters_are FROM d0 WHERE json_type(own) = 'OBJECT'",
    "region": f"SELECT DISTINCT id, target_harness, CAST(-1 AS BIGINT) AS parent_pos, pos, {_W("(region->'$.target_start')")} AS target_start, {_W("(region->'$.target_end')")} AS target_end, {_S("(region->'$.origin')")} AS origin, {_S("(region->'$.request_id')")} AS request_id FROM orr",
    "span": "SELECT DISTINCT r.id, target_harness, pos AS parent_pos, CAST(e.key AS BIGINT) AS pos, CAST(e.value AS BIGINT) AS source_index FROM orr r, json_each(coalesce(region->'$.source_indices', '[]'::JSON)) e",
    "decision": f"SELECT DISTINCT id, target_harness, pos AS parent_pos, CAST(0 AS BIGINT) AS pos, {_S("(x->'$.request_id')")} AS request_id, {_S("(x->'$.route')")} AS route, {_S("(x->'$.decision')")} AS decision, {_W("(x->'$.promoted_calls')")} AS promoted_calls FROM (SELECT *, region->'$.review_decision' AS x FROM orr) WHERE json_type(x) = 'OBJECT'",
    "reason": "SELECT DISTINCT r.id, target_harness, pos AS parent_pos, CAST(e.key AS BIGINT) AS pos, e.value->>'$' AS reason FROM orr r, json_each(coalesce(region->'$.review_decision.rejection_reasons', '[]'::JSON)) e",
    "block": f"SELECT DISTINCT m.id, '' AS target_harness, CAST(message_index AS BIGINT) AS parent_pos, CAST(e.key AS BIGINT) AS pos, {_S("(e.value->'$.type')")} AS type, {_S("(e.value->'$.text')")} AS text, {_S("(e.value->'$.thinking')")} AS thinking FROM om m, json_each(CASE WHEN json_type(content) = 'ARRAY' THEN content ELSE '[]' END) e",
}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": _LINKS} | {f"nested_{kind}s": _NODES + _OBJECTS + sql for kind, sql in _TABLES.items()}
