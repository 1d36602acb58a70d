"""DuckDB SQL for those training-data queries that SQL can express."""

from __future__ import annotations

from quern.core.labels import NO_KEY, SPELLINGS
from quern.llm.pieces import LIMIT
from quern.operators.session_sql import BASE

_QUOTED = {s: ", ".join(f"'{x}'" for x in names) for s, names in SPELLINGS.items()}
_NO_KEY = ", ".join(f"'{x}'" for x in NO_KEY)

#: Rows with their normal key and split.
LABELLED = f"""
WITH t AS (
  SELECT id, lower(regexp_replace(split, '^[\\s\\x{{00A0}}\\x{{200B}}\\x{{FEFF}}]+|[\\s\\x{{00A0}}\\x{{200B}}\\x{{FEFF}}]+$', '', 'g')) AS s,
         lower(regexp_replace(task_group_key, '^\\s+|\\s+$', '', 'g')) AS k
  FROM trajectories
), u AS (
  SELECT id, CASE WHEN s IN ({_QUOTED["train"]}) THEN 'train' WHEN s IN ({_QUOTED["validation"]}) THEN 'validation' WHEN s IN ({_QUOTED["test"]}) THEN 'test' END AS split, k,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(k, '[?].*$', ''), '@[^/#@]*$', ''), '/(issues?|pulls?|merge_requests|-)/', '/'), '[/\\s]+$', '') AS c
  FROM t
), l AS (
  SELECT id, split, CASE WHEN k NOT IN ({_NO_KEY}) AND regexp_matches(c, '(__|/)[a-z0-9._-]+[#/:!_-]+[0-9]+$') THEN
    regexp_extract(c, '([a-z0-9][a-z0-9.-]*)(__|/)([a-z0-9][a-z0-9._-]*?)([#/:!-]|__)0*([0-9]+)$', 1) || '/' ||
    regexp_extract(c, '([a-z0-9][a-z0-9.-]*)(__|/)([a-z0-9][a-z0-9._-]*?)([#/:!-]|__)0*([0-9]+)$', 3) || '#' ||
    regexp_extract(c, '([a-z0-9][a-z0-9.-]*)(__|/)([a-z0-9][a-z0-9._-]*?)([#/:!-]|__)0*([0-9]+)$', 5) END AS task
  FROM u
)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""{LABELLED}
SELECT DISTINCT id FROM l WHERE task IN (SELECT task FROM l WHERE task IS NOT NULL GROUP BY task HAVING count(DISTINCT split) > 1)""",
        "p1_tasks": f"""{LABELLED}
SELECT task, count(DISTINCT id) AS records, CAST(1 AS BIGINT) AS splits FROM l WHERE task IS NOT NULL GROUP BY 1""",
        "p5_sizes": f"""{BASE}
SELECT DISTINCT id, n AS chars, true AS within, true AS overlaps FROM (SELECT k, id, CAST(sum(length(text)) AS BIGINT) AS n FROM m GROUP BY 1, 2) WHERE n > {LIMIT}""",
        "p6_whole": "SELECT DISTINCT doc_id, true AS within, true AS whole FROM documents WHERE regexp_matches(text, '[^\\s]')",
        "p7_uses": "SELECT DISTINCT doc_id, true AS within, true AS apart FROM documents d JOIN mix_targets t ON lower(trim(d.source)) = lower(trim(t.source)) WHERE trim(text) <> ''",
        "p5_found": f"""{BASE}
SELECT DISTINCT id, CAST(-1 AS BIGINT) AS message_index FROM (SELECT k, id, sum(length(text)) AS n FROM m GROUP BY 1, 2) WHERE n > {LIMIT}
UNION SELECT DISTINCT id, CAST(message_index AS BIGINT) FROM m WHERE length(text) > {LIMIT}""",
    }
