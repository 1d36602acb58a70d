"""Queries over sessions: reading, texts, shell words, calls, joins, windows.

Each runs the engine's own functions on whole tables; the SQL beside it says
the same for DuckDB.  Delivered rows each count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators.session_sql import BASE, DISPATCH, LINES, WORD
from quern.plans.codes import CONTENT_MARK, READ_ONLY_KINDS
from quern.sources import sessions as S

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return S.read_sessions(spark, f"{d}/trajectories.parquet")


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return S.messages(_rows(spark, d))


def _calls(spark: SparkSession, d: str) -> DataFrame:
    return S.calls(_messages(spark, d))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).withColumn("text", X.content_text(F.col("message")))


def _argument(name: str) -> Column:
    """A text argument of a call."""
    return X.text_field(F.try_parse_json("arguments"), name)


def _mark(c: Column) -> list[Column]:
    """Count, length and sum of hashes of texts: any changed text shows."""
    start = F.conv(F.substring(F.sha2(c.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return [F.count(c).alias("n"), F.coalesce(F.sum(F.length(c)), F.lit(0)).cast("bigint").alias("chars"), F.coalesce(F.sum(start), F.lit(0)).cast("bigint").alias("hash_sum")]


def _mark_sql(c: str) -> str:
    return f"count({c}) AS n, CAST(coalesce(sum(length({c})), 0) AS BIGINT) AS chars, CAST(coalesce(sum(CAST('0x' || substr(sha256({c}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS hash_sum"


# --- reading


@query("SELECT source_scaffold, count(*) AS n, CAST(sum(reference_tokens) AS BIGINT) AS tokens FROM trajectories WHERE split = 'train' GROUP BY 1")
def io1_scan(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).where("split = 'train'").groupBy("source_scaffold").agg(F.count(F.lit(1)).alias("n"), F.sum("reference_tokens").alias("tokens"))


@query(BASE + """SELECT coalesce(CASE WHEN messages_json IS NULL THEN 'missing' WHEN NOT json_valid(messages_json) THEN 'unreadable' WHEN json_type(m0) = 'VARCHAR' THEN 'twice' ELSE lower(json_type(m0)) END, 'unreadable') AS state, count(*) AS n, CAST(sum(json_array_length(mj)) AS BIGINT) AS messages FROM s GROUP BY 1""")
def parse_json_columns(spark: SparkSession, d: str) -> DataFrame:
    once = F.try_parse_json("messages_json")
    kind = X.kind_of(once)
    state = F.when(F.col("messages_json").isNull(), "missing").when(kind == "missing", "unreadable").when(kind == "string", "twice").otherwise(kind)
    return _rows(spark, d).groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(X.items(X.json_value(F.col("messages_json"))))).alias("messages"))


@query(BASE + "SELECT role, CASE WHEN content IS NULL THEN 'missing' WHEN json_type(content) = 'VARCHAR' THEN 'string' WHEN json_type(content) = 'NULL' THEN 'null' ELSE lower(json_type(content)) END AS kind, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, min(sha256(text)) AS least_hash FROM m GROUP BY 1, 2")
def content_texts(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).groupBy("role", X.kind_of(X.field(F.col("message"), "content")).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.min(F.sha2(F.col("text").cast("binary"), 256)).alias("least_hash"))


_MESSAGE_TEXT = """, mt AS (
  SELECT role, CASE json_type(content) WHEN 'VARCHAR' THEN [content->>'$'] WHEN 'ARRAY' THEN list_transform(from_json(content, '["json"]'), lambda b: coalesce(CASE WHEN b->>'$.type' = 'thinking' THEN b->>'$.thinking' ELSE b->>'$.text' END, '')) ELSE [] END AS parts, coalesce(message->>'$.reasoning_content', '') AS reasoning,
         CASE WHEN json_type(message->'$.reasoning_content') NOT IN ('NULL', 'VARCHAR') THEN 'NON_TEXT_REASONING' WHEN json_type(content) NOT IN ('NULL', 'VARCHAR', 'ARRAY') THEN 'NON_TEXT_CONTENT'
              WHEN json_type(content) = 'ARRAY' THEN list_filter(from_json(content, '["json"]'), lambda b: coalesce(b->>'$.type' NOT IN ('text', 'thinking'), true))[1]->>'$.type' END AS bad
  FROM m
)"""


@query(BASE + _MESSAGE_TEXT + "SELECT role, count(*) AS messages, count(bad) AS refused, CAST(sum(CASE WHEN bad IS NULL THEN length(array_to_string(list_filter(list_prepend(reasoning, parts), lambda x: x <> ''), chr(10) || chr(10))) END) AS BIGINT) AS chars FROM mt GROUP BY 1")
def message_texts(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    return m.groupBy("role").agg(F.count(F.lit(1)).alias("messages"), F.count(X.message_text_error(F.col("message"))).alias("refused"), F.sum(F.length(X.message_text(F.col("message")))).alias("chars"))


_ROOTS = """, u AS (SELECT k, replace(string_agg(text, chr(10) ORDER BY message_index), '\\n', chr(10)) AS t FROM m WHERE role IN ('user', 'system') GROUP BY k),
r AS (SELECT k, CASE WHEN t IS NOT NULL THEN regexp_replace(coalesce(nullif(regexp_extract(t, '<uploaded_files>\\s*(/[^\\n<]+)', 1), ''), nullif(regexp_extract(t, 'Cloned path:\\s*(/[^\\n]+)', 1), ''), CASE WHEN contains(t, '- MODIFY: Regular source code files in /testbed') THEN '/testbed' END), '^\\s+|\\s+$', '', 'g') END AS root FROM u)"""


def session_roots(messages: DataFrame) -> DataFrame:
    """row_key, root: the repository path each session declares."""
    spoken = messages.where(F.col("role").isin("user", "system")).select("row_key", F.struct("message_index", X.content_text(F.col("message")).alias("text")).alias("m"))
    texts = spoken.groupBy("row_key").agg(F.array_sort(F.collect_list("m")).alias("all"))
    return texts.select("row_key", X.declared_root(F.array_join(F.transform("all", lambda x: x["text"]), "\n")).alias("root"))


@query(BASE + _ROOTS + "SELECT root, count(*) AS n FROM r GROUP BY 1")
def declared_roots(spark: SparkSession, d: str) -> DataFrame:
    return session_roots(_messages(spark, d)).groupBy("root").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + "SELECT source_scaffold, name, count(*) AS n, CAST(sum(position) AS BIGINT) AS positions, min(description) AS description FROM d GROUP BY 1, 2")
def tool_definitions(spark: SparkSession, d: str) -> DataFrame:
    return S.definitions(_rows(spark, d)).groupBy("source_scaffold", "name").agg(F.count(F.lit(1)).alias("n"), F.sum("position").alias("positions"), F.min("description").alias("description"))


_PATHS = """, p AS (SELECT c.*, coalesce(arguments->>'$.path', arguments->>'$.file_path', arguments->>'$.filePath') AS path, root FROM c LEFT JOIN r USING (k) WHERE json_valid(arguments) AND coalesce(arguments->>'$.path', arguments->>'$.file_path', arguments->>'$.filePath') IS NOT NULL)"""


def call_paths(spark: SparkSession, d: str) -> DataFrame:
    """Calls with a path argument and their session's root."""
    m = _messages(spark, d)
    path = F.coalesce(_argument("path"), _argument("file_path"), _argument("filePath"))
    return S.calls(m).withColumn("path", path).where("path is not null").join(session_roots(m), "row_key", "left")


@query(BASE + _ROOTS + _PATHS + """SELECT tool, CASE WHEN path = '' THEN 'INVALID_PATH' WHEN path LIKE '/%' OR root LIKE '/%' THEN NULL ELSE 'RELATIVE_PATH_REQUIRES_SOURCE_CWD' END AS error, count(*) AS n,
  min(CASE WHEN path LIKE '/%' THEN path WHEN path <> '' AND root LIKE '/%' THEN CASE WHEN root LIKE '%/' THEN root || path ELSE root || '/' || path END END) AS least_path FROM p GROUP BY 1, 2""")
def absolute_paths(spark: SparkSession, d: str) -> DataFrame:
    path, root = F.col("path"), F.col("root")
    return call_paths(spark, d).groupBy("tool", X.absolute_error(path, root).alias("error")).agg(F.count(F.lit(1)).alias("n"), F.min(X.absolute(path, root)).alias("least_path"))


@query(BASE + f", w AS (SELECT tool, {WORD.format('text')} AS word FROM (SELECT tool, arguments->>'$.command' AS text FROM c WHERE json_valid(arguments))) SELECT tool, {_mark_sql('word')} FROM w WHERE word IS NOT NULL GROUP BY 1")
def shell_words(spark: SparkSession, d: str) -> DataFrame:
    return _calls(spark, d).select("tool", X.shell_word(_argument("command")).alias("word")).where("word is not null").groupBy("tool").agg(*_mark(F.col("word")))


_WRITES = """, w0 AS (SELECT coalesce(arguments->>'$.path', arguments->>'$.file_path', arguments->>'$.filePath') AS path, coalesce(arguments->>'$.content', arguments->>'$.file_text') AS content FROM c WHERE json_valid(arguments))"""


def _writes(spark: SparkSession, d: str) -> DataFrame:
    content = F.coalesce(_argument("content"), _argument("file_text"))
    return _calls(spark, d).select(F.coalesce(_argument("path"), _argument("file_path"), _argument("filePath")).alias("path"), content.alias("content")).where("path is not null and content is not null")


@query(BASE + _WRITES + f""", w AS (SELECT CASE WHEN content LIKE '%' || chr(10) THEN 'cat > ' || {WORD.format('path')} || ' <<''{CONTENT_MARK}' || substr(sha256(content), 1, 16) || '''' || chr(10) || content || '{CONTENT_MARK}' || substr(sha256(content), 1, 16)
  ELSE 'printf ''%s'' ' || {WORD.format('content')} || ' > ' || {WORD.format('path')} END AS command FROM w0 WHERE path IS NOT NULL AND content IS NOT NULL) SELECT {_mark_sql('command')} FROM w""")
def write_commands(spark: SparkSession, d: str) -> DataFrame:
    return _writes(spark, d).select(X.write_command(F.col("path"), F.col("content")).alias("command")).agg(*_mark(F.col("command")))


@query(BASE + _WRITES + f""", w AS (SELECT DISTINCT 'test -f ' || {WORD.format('path')} || ' && rm -- ' || {WORD.format('path')} AS command FROM w0 WHERE path IS NOT NULL AND content IS NOT NULL) SELECT {_mark_sql('command')} FROM w""")
def delete_commands(spark: SparkSession, d: str) -> DataFrame:
    return _writes(spark, d).select(X.delete_command(F.col("path")).alias("command")).distinct().agg(*_mark(F.col("command")))


@query(BASE + f""", b AS (SELECT arguments->>'$.command' AS body FROM c WHERE json_valid(arguments) AND arguments->>'$.command' IS NOT NULL),
w AS (SELECT '(' || chr(10) || body || CASE WHEN len(list_filter({LINES.format('body')}, lambda x: trim(x, ' ' || chr(9)) <> '' AND NOT starts_with(trim(x, ' ' || chr(9)), '#'))) > 0 THEN '' ELSE chr(10) || ':' END || chr(10) || ')' AS command FROM b) SELECT {_mark_sql('command')} FROM w""")
def subshell_commands(spark: SparkSession, d: str) -> DataFrame:
    return _calls(spark, d).select(X.subshell(_argument("command")).alias("command")).agg(*_mark(F.col("command")))


_EDITS = """, e AS (SELECT source_scaffold, coalesce(arguments->>'$.old_string', arguments->>'$.oldString', arguments->>'$.old_str') AS old, coalesce(arguments->>'$.new_string', arguments->>'$.newString', arguments->>'$.new_str') AS new FROM c WHERE json_valid(arguments)),
e1 AS (SELECT * FROM e WHERE old <> '' AND new IS NOT NULL)"""
_SED = "replace(regexp_replace({0}, '([\\\\.\\[*^$|])', '\\\\\\1', 'g'), chr(10), '\\n')"


def _edits(spark: SparkSession, d: str) -> DataFrame:
    old, new = F.coalesce(*map(_argument, ("old_string", "oldString", "old_str"))), F.coalesce(*map(_argument, ("new_string", "newString", "new_str")))
    return _calls(spark, d).select("source_scaffold", old.alias("old"), new.alias("new")).where("old <> '' and new is not null")


@query(BASE + _EDITS + f", w AS (SELECT source_scaffold, {_SED.format('old')} AS sed FROM e1) SELECT source_scaffold, {_mark_sql('sed')} FROM w GROUP BY 1")
def sed_texts(spark: SparkSession, d: str) -> DataFrame:
    return _edits(spark, d).select("source_scaffold", X.sed_text(F.col("old")).alias("sed")).groupBy("source_scaffold").agg(*_mark(F.col("sed")))


@query(BASE + _EDITS + """, x AS (SELECT target, source_scaffold, old || 'a' || new AS before, old, new FROM e1, (VALUES ('openhands_sdk'), ('sweagent')) AS t(target))
SELECT target, source_scaffold, count(*) AS n, count(*) FILTER (old <> new AND (length(before) - length(replace(before, old, ''))) // length(old) = 1 AND NOT contains(before, chr(13)) AND (target <> 'sweagent' OR NOT contains(before, chr(9)))) AS exact FROM x GROUP BY 1, 2""")
def exact_replacements(spark: SparkSession, d: str) -> DataFrame:
    pairs = _edits(spark, d).join(F.broadcast(S.targets(spark).select("target")))  # two targets
    before = F.concat("old", F.lit("a"), "new")
    return pairs.groupBy("target", "source_scaffold").agg(F.count(F.lit(1)).alias("n"), F.count_if(X.replaces_exactly(F.col("target"), before, F.col("old"), F.col("new"))).alias("exact"))


@query(BASE + f", q AS (SELECT role, substr(list_filter(list_transform({LINES.format('text')}, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')[1], 1, 120) AS quote FROM m WHERE json_type(content) = 'VARCHAR') SELECT role, count(quote) AS n, CAST(sum(length(quote)) AS BIGINT) AS chars, min(quote) AS least_quote FROM q GROUP BY 1")
def quote_lines(spark: SparkSession, d: str) -> DataFrame:
    m = _texts(spark, d).where(X.kind_of(X.field(F.col("message"), "content")) == "string").withColumn("quote", X.first_line(F.col("text")))
    return m.groupBy("role").agg(F.count("quote").alias("n"), F.sum(F.length("quote")).alias("chars"), F.min("quote").alias("least_quote"))


@query(BASE + """SELECT tool, array_to_string(list_sort(list_filter(json_keys(arguments), lambda x: x NOT IN ('command', 'description', 'timeout', 'timeout_ms', 'command_timeout', 'workdir', 'mode', 'is_input', 'run_in_background', 'dangerouslyDisableSandbox'))), ',') AS extra, count(*) AS n
FROM c WHERE tool IN ('bash', 'Bash', 'shell', 'execute_bash') AND json_valid(arguments) AND json_type(arguments) = 'OBJECT' GROUP BY 1, 2""")
def unexpected_arguments(spark: SparkSession, d: str) -> DataFrame:
    allowed = "command description timeout timeout_ms command_timeout workdir mode is_input run_in_background dangerouslyDisableSandbox".split()
    c = _calls(spark, d).where(F.col("tool").isin("bash", "Bash", "shell", "execute_bash") & (X.kind_of(F.try_parse_json("arguments")) == "object"))
    return c.groupBy("tool", F.array_join(X.unexpected_keys(F.col("arguments"), allowed), ",").alias("extra")).agg(F.count(F.lit(1)).alias("n"))


# --- joins


@query(BASE + f"SELECT c.source_scaffold, c.tool, coalesce(t.kind, 'unsupported') AS kind, count(*) AS n FROM c LEFT JOIN {DISPATCH} USING (source_scaffold, tool) GROUP BY 1, 2, 3")
def dispatch_kinds(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.broadcast(S.dispatch(spark))  # the fixed table
    return _calls(spark, d).join(kinds, ["source_scaffold", "tool"], "left").groupBy("source_scaffold", "tool", F.coalesce("kind", F.lit("unsupported")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(BASE + "SELECT c.source_scaffold, c.tool, count(*) AS n, count(d.name) AS defined, CAST(sum(d.position) AS BIGINT) AS positions FROM c LEFT JOIN d ON c.k = d.k AND c.tool = d.name GROUP BY 1, 2")
def call_definitions(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    known = S.definitions(rows).select("row_key", F.col("name").alias("tool"), "position")
    return S.calls(S.messages(rows)).join(known, ["row_key", "tool"], "left").groupBy("source_scaffold", "tool").agg(F.count(F.lit(1)).alias("n"), F.count("position").alias("defined"), F.sum("position").alias("positions"))


def observations(calls: DataFrame, messages: DataFrame) -> DataFrame:
    """Calls with the sorted indices of all tool messages naming their id."""
    named = messages.where("role = 'tool'").select("row_key", X.text_field(F.col("message"), "tool_call_id").alias("call_id"), "message_index").where("call_id <> ''")
    found = named.groupBy("row_key", "call_id").agg(F.array_sort(F.collect_list("message_index")).alias("observations"))
    return calls.join(found, ["row_key", "call_id"], "left").withColumn("observations", F.coalesce("observations", F.array().cast("array<int>")))


@query(BASE + """, o AS (SELECT k, message->>'$.tool_call_id' AS call_id, list(message_index ORDER BY message_index) AS obs FROM m WHERE role = 'tool' AND message->>'$.tool_call_id' <> '' GROUP BY 1, 2)
SELECT c.source_scaffold, len(coalesce(obs, [])) AS observations, count(*) AS n, CAST(sum(coalesce(obs[1] - message_index, 0)) AS BIGINT) AS distance FROM c LEFT JOIN o ON c.k = o.k AND c.call_id = o.call_id GROUP BY 1, 2""")
def call_observations(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    bound = observations(S.calls(m), m)
    return bound.groupBy("source_scaffold", F.size("observations").cast("bigint").alias("observations")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.try_element_at("observations", F.lit(1)) - F.col("message_index"), F.lit(0))).alias("distance"))


@query(BASE + "SELECT target, source_scaffold, count(*) AS n FROM c, (VALUES ('openhands_sdk'), ('sweagent')) AS t(target) GROUP BY 1, 2")
def calls_by_target(spark: SparkSession, d: str) -> DataFrame:
    return _calls(spark, d).join(F.broadcast(S.targets(spark).select("target"))).groupBy("target", "source_scaffold").agg(F.count(F.lit(1)).alias("n"))  # two targets


_ACK = """, o AS (SELECT k, message->>'$.tool_call_id' AS call_id, count(*) AS n_obs, min(message_index) AS obs_at FROM m WHERE role = 'tool' AND message->>'$.tool_call_id' <> '' GROUP BY 1, 2),
a AS (SELECT c.source_scaffold, c.tool, coalesce(n_obs = 1 AND obs_at > c.message_index AND CASE c.tool
   WHEN 'write' THEN x.text = 'Wrote file successfully.' OR starts_with(x.text, 'Wrote file successfully.' || chr(10)) WHEN 'edit' THEN x.text = 'Edit applied successfully.' OR starts_with(x.text, 'Edit applied successfully.' || chr(10))
   WHEN 'Write' THEN starts_with(x.text, 'File created successfully at: ' || (arguments->>'$.file_path')) OR starts_with(x.text, 'The file ' || (arguments->>'$.file_path') || ' has been updated')
   ELSE starts_with(x.text, 'The file ' || (arguments->>'$.file_path') || ' has been updated') OR starts_with(x.text, 'The file ' || (arguments->>'$.file_path') || ' has been edited') END, false) AS acknowledged
 FROM c LEFT JOIN o ON c.k = o.k AND c.call_id = o.call_id LEFT JOIN m x ON x.k = c.k AND x.message_index = o.obs_at
 WHERE c.source_scaffold IN ('OpenCode', 'Claude Code') AND c.tool IN ('write', 'edit', 'Write', 'Edit') AND json_valid(arguments))"""


def acknowledged(bound: DataFrame, messages: DataFrame) -> DataFrame:
    """Writes and edits with whether their one later observation confirms them."""
    texts = messages.select("row_key", F.col("message_index").alias("at"), X.content_text(F.col("message")).alias("answer"))
    rows = bound.where(F.col("tool").isin("write", "edit", "Write", "Edit") & F.col("source_scaffold").isin("OpenCode", "Claude Code")).withColumn("at", F.when(F.size("observations") == 1, F.col("observations")[0])).join(texts, ["row_key", "at"], "left")
    answer, path = F.col("answer"), _argument("file_path")
    plain = F.when(F.col("tool") == "write", "Wrote file successfully.").when(F.col("tool") == "edit", "Edit applied successfully.")
    updated = answer.startswith(F.concat(F.lit("The file "), path, F.lit(" has been updated")))
    other = F.when(F.col("tool") == "Write", answer.startswith(F.concat(F.lit("File created successfully at: "), path))).otherwise(answer.startswith(F.concat(F.lit("The file "), path, F.lit(" has been edited"))))
    said = F.when(plain.isNotNull(), (answer == plain) | answer.startswith(F.concat(plain, F.lit("\n")))).otherwise(updated | other)
    return rows.withColumn("acknowledged", F.coalesce((F.col("at") > F.col("message_index")) & said, F.lit(False)))


@query(BASE + _ACK + "SELECT source_scaffold, tool, count(*) AS n, count(*) FILTER (acknowledged) AS acknowledged FROM a GROUP BY 1, 2")
def acknowledged_writes(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    done = acknowledged(observations(S.calls(m).where(F.try_parse_json("arguments").isNotNull()), m), m)
    return done.groupBy("source_scaffold", "tool").agg(F.count(F.lit(1)).alias("n"), F.count_if("acknowledged").alias("acknowledged"))


@query(BASE + """, v AS (SELECT k, message_index, call_index, arguments->>'$.path' AS path, arguments->>'$.file_text' AS body, arguments->>'$.command' AS command FROM c WHERE tool = 'str_replace_editor' AND json_valid(arguments)),
f AS (SELECT *, last_value(CASE WHEN command = 'create' THEN message_index END IGNORE NULLS) OVER (PARTITION BY k, path ORDER BY message_index, call_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM v WHERE path IS NOT NULL)
SELECT command, count(*) AS n, count(seen) AS known, CAST(sum(message_index - seen) AS BIGINT) AS age FROM f GROUP BY 1""")
def snapshot_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The latest earlier creation of the file a call touches."""
    v = _calls(spark, d).where("tool = 'str_replace_editor'").select("row_key", "message_index", "call_index", _argument("path").alias("path"), _argument("command").alias("command")).where("path is not null")
    before = Window.partitionBy("row_key", "path").orderBy("message_index", "call_index").rowsBetween(Window.unboundedPreceding, -1)
    f = v.withColumn("seen", F.last(F.when(F.col("command") == "create", F.col("message_index")), ignorenulls=True).over(before))
    return f.groupBy("command").agg(F.count(F.lit(1)).alias("n"), F.count("seen").alias("known"), F.sum(F.col("message_index") - F.col("seen")).alias("age"))


# --- windows


def segments(messages: DataFrame) -> DataFrame:
    """Messages with ``absorbed`` (a tool message in its assistant's block) and
    the number of their segment, from 0."""
    in_order = Window.partitionBy("row_key").orderBy("message_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tool = F.coalesce(F.col("role") == "tool", F.lit(False))
    opener = F.last(F.when(~tool, F.coalesce("role", F.lit(""))), ignorenulls=True).over(in_order)
    out = messages.withColumn("absorbed", F.coalesce(tool & (opener == "assistant"), F.lit(False)))
    return out.withColumn("segment", F.sum(F.when(F.col("absorbed"), 0).otherwise(1)).over(in_order) - 1)


_SEGMENTS = """, g0 AS (SELECT *, coalesce(role = 'tool' AND last_value(CASE WHEN role IS DISTINCT FROM 'tool' THEN coalesce(role, '') END IGNORE NULLS) OVER w = 'assistant', false) AS absorbed FROM m WINDOW w AS (PARTITION BY k ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, sum(CASE WHEN absorbed THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY message_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS segment FROM g0)"""


@query(BASE + _SEGMENTS + "SELECT source_scaffold, role, absorbed, count(*) AS n, CAST(sum(segment) AS BIGINT) AS segments, CAST(max(segment) AS BIGINT) AS last_segment FROM g GROUP BY 1, 2, 3")
def message_segments(spark: SparkSession, d: str) -> DataFrame:
    return segments(_messages(spark, d)).groupBy("source_scaffold", "role", "absorbed").agg(F.count(F.lit(1)).alias("n"), F.sum("segment").alias("segments"), F.max("segment").alias("last_segment"))


@query(BASE + _SEGMENTS + """, h AS (SELECT k, source_scaffold, segment, list(message_index ORDER BY message_index) AS idx, min(role) FILTER (NOT absorbed) AS opener FROM g GROUP BY 1, 2, 3),
v AS (SELECT k, source_scaffold, flatten(list(idx ORDER BY segment)) AS cover, count(*) AS segments FROM h GROUP BY 1, 2)
SELECT source_scaffold, count(*) AS sessions, CAST(sum(segments) AS BIGINT) AS segments, count(*) FILTER (cover = range(0, len(cover))) AS covered FROM v GROUP BY 1""")
def segment_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Sessions whose segments cover every message once, in order."""
    per = segments(_messages(spark, d)).groupBy("row_key", "source_scaffold", "segment").agg(F.array_sort(F.collect_list("message_index")).alias("idx"))
    cover = per.groupBy("row_key", "source_scaffold").agg(F.array_sort(F.collect_list(F.struct("segment", "idx"))).alias("all"), F.count(F.lit(1)).alias("segments"))
    cover = cover.withColumn("cover", F.flatten(F.transform("all", lambda x: x["idx"])))
    full = F.col("cover") == F.sequence(F.lit(0), F.size("cover") - 1)
    return cover.groupBy("source_scaffold").agg(F.count(F.lit(1)).alias("sessions"), F.sum("segments").alias("segments"), F.count_if(full).alias("covered"))


def shell_state(calls: DataFrame) -> DataFrame:
    """Calls with whether the working directory is still the session's root: it
    is lost after a command in a shell that lasts, unless that names its own
    directory or feeds a process."""
    parsed = F.try_parse_json("arguments")
    to_process = F.coalesce(X.field(parsed, "is_input", "string") == "true", F.lit(False))
    command = F.col("tool").isin("bash", "Bash", "execute_bash") & F.col("source_scaffold").isin("SWE-agent", "OpenHands", "Claude Code", "OpenCode")
    clears = command & ~to_process & F.coalesce(X.field(parsed, "workdir", "string") == "", F.lit(True))
    before = Window.partitionBy("row_key").orderBy("message_index", "call_index").rowsBetween(Window.unboundedPreceding, -1)
    return calls.withColumn("clears", clears.cast("int")).withColumn("cwd_lost", F.coalesce(F.max("clears").over(before), F.lit(0)))


@query(BASE + """, x AS (SELECT *, CASE WHEN tool IN ('bash', 'Bash', 'execute_bash') AND source_scaffold IN ('SWE-agent', 'OpenHands', 'Claude Code', 'OpenCode') AND coalesce(CASE WHEN json_valid(arguments) THEN arguments->>'$.is_input' END, 'false') <> 'true'
   AND coalesce(CASE WHEN json_valid(arguments) THEN arguments->>'$.workdir' END, '') = '' THEN 1 ELSE 0 END AS clears FROM c),
y AS (SELECT *, coalesce(max(clears) OVER (PARTITION BY k ORDER BY message_index, call_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cwd_lost FROM x)
SELECT source_scaffold, cwd_lost, count(*) AS n, CAST(sum(clears) AS BIGINT) AS clears FROM y GROUP BY 1, 2""")
def working_directory(spark: SparkSession, d: str) -> DataFrame:
    return shell_state(_calls(spark, d)).groupBy("source_scaffold", "cwd_lost").agg(F.count(F.lit(1)).alias("n"), F.sum("clears").alias("clears"))


@query(BASE + """, t AS (SELECT m.*, max(CASE WHEN role = 'assistant' THEN message_index END) OVER (PARTITION BY k) AS last FROM m)
SELECT c.source_scaffold, c.tool, count(*) AS n, count(*) FILTER (t.last > c.message_index) AS nonterminal FROM c JOIN t ON c.k = t.k AND c.message_index = t.message_index GROUP BY 1, 2""")
def later_assistants(spark: SparkSession, d: str) -> DataFrame:
    """Calls by tool, and those that an assistant message comes after."""
    m = _messages(spark, d).withColumn("last", F.max(F.when(F.col("role") == "assistant", F.col("message_index"))).over(Window.partitionBy("row_key")))
    ends = S.calls(m).join(m.select("row_key", "message_index", "last"), ["row_key", "message_index"])
    return ends.groupBy("source_scaffold", "tool").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("last") > F.col("message_index")).alias("nonterminal"))


_READ_ONLY = ", ".join(f"'{k}'" for k in sorted(READ_ONLY_KINDS))


@query(BASE + f""", x AS (SELECT c.*, count(*) OVER w AS batch, min(CASE WHEN kind IN ({_READ_ONLY}) THEN 1 ELSE 0 END) OVER w AS read_only FROM c LEFT JOIN {DISPATCH} USING (source_scaffold, tool) WINDOW w AS (PARTITION BY k, message_index))
SELECT source_scaffold, batch, read_only, count(*) AS n FROM x GROUP BY 1, 2, 3""")
def call_batches(spark: SparkSession, d: str) -> DataFrame:
    """Calls by the size of their message's batch and whether all of it only reads."""
    w = Window.partitionBy("row_key", "message_index")
    kinds = F.broadcast(S.dispatch(spark))
    x = _calls(spark, d).join(kinds, ["source_scaffold", "tool"], "left").withColumns({"batch": F.count(F.lit(1)).over(w), "read_only": F.min(F.when(F.col("kind").isin(*READ_ONLY_KINDS), 1).otherwise(0)).over(w)})
    return x.groupBy("source_scaffold", "batch", "read_only").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + "SELECT role, before1, before2, count(*) AS n FROM (SELECT role, lag(role, 1) OVER w AS before1, lag(role, 2) OVER w AS before2 FROM m WINDOW w AS (PARTITION BY k ORDER BY message_index)) GROUP BY 1, 2, 3")
def preceding_roles(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("row_key").orderBy("message_index")
    return _messages(spark, d).select("role", F.lag("role", 1).over(w).alias("before1"), F.lag("role", 2).over(w).alias("before2")).groupBy("role", "before1", "before2").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + _SEGMENTS + """, b AS (SELECT k, source_scaffold, segment, list(json_array_length(CASE WHEN json_type(message->'$.tool_calls') = 'ARRAY' THEN message->'$.tool_calls' ELSE '[]' END)) FILTER (NOT absorbed) AS calls, count(*) FILTER (absorbed) AS answers, count(*) FILTER (absorbed AND message->>'$.tool_call_id' <> '') AS named, min(role) FILTER (NOT absorbed) AS opener FROM g GROUP BY 1, 2, 3)
SELECT source_scaffold, CAST(calls[1] AS BIGINT) AS calls, answers, named, count(*) AS n FROM b WHERE opener = 'assistant' GROUP BY 1, 2, 3, 4""")
def block_answers(spark: SparkSession, d: str) -> DataFrame:
    """Assistant blocks by their calls, answers, and answers that name a call."""
    g = segments(_messages(spark, d))
    own, named = F.size(X.items(X.field(F.col("message"), "tool_calls"))), X.text_field(F.col("message"), "tool_call_id")
    b = g.groupBy("row_key", "source_scaffold", "segment").agg(F.max(F.when(~F.col("absorbed"), own)).cast("bigint").alias("calls"), F.count_if("absorbed").alias("answers"), F.count_if(F.col("absorbed") & F.coalesce(named != "", F.lit(False))).alias("named"), F.min(F.when(~F.col("absorbed"), F.col("role"))).alias("opener"))
    return b.where("opener = 'assistant'").groupBy("source_scaffold", "calls", "answers", "named").agg(F.count(F.lit(1)).alias("n"))


# --- aggregates, sets, limits


@query(BASE + "SELECT (SELECT count(*) FROM s) AS delivered, (SELECT count(*) FROM m) AS messages, (SELECT count(*) FROM c) AS calls")
def totals(spark: SparkSession, d: str) -> DataFrame:
    per = _rows(spark, d).select(X.items(X.json_value(F.col("messages_json"))).alias("all"))
    calls = F.aggregate(F.transform("all", lambda m: F.size(X.items(X.field(m, "tool_calls")))), F.lit(0), lambda a, x: a + x)
    return per.agg(F.count(F.lit(1)).alias("delivered"), F.sum(F.size("all")).alias("messages"), F.sum(calls).alias("calls"))


@query(BASE + "SELECT source_scaffold, times, count(*) AS ids FROM (SELECT k, source_scaffold, call_id, count(*) AS times FROM c GROUP BY 1, 2, 3) GROUP BY 1, 2")
def call_id_frequency(spark: SparkSession, d: str) -> DataFrame:
    return _calls(spark, d).groupBy("row_key", "source_scaffold", "call_id").agg(F.count(F.lit(1)).alias("times")).groupBy("source_scaffold", "times").agg(F.count(F.lit(1)).alias("ids"))


@query("SELECT id, count(*) AS times, count(DISTINCT task_group_key) AS keys FROM trajectories GROUP BY 1 HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("times"), F.count_distinct("task_group_key").alias("keys")).where("times > 1")


@query(BASE + "SELECT name, count(DISTINCT description) AS texts, min(sha256(description)) AS least_hash FROM d GROUP BY 1")
def distinct_definitions(spark: SparkSession, d: str) -> DataFrame:
    known = S.definitions(_rows(spark, d)).select("name", F.sha2(F.col("description").cast("binary"), 256).alias("hash")).distinct()
    return known.groupBy("name").agg(F.count("hash").alias("texts"), F.min("hash").alias("least_hash"))


@query("SELECT source_scaffold, count(*) AS n, CAST(sum(list_sum(message_loss_mask)) AS BIGINT) AS weight, count(*) FILTER (list_contains(message_loss_mask, 1)) AS supervised, CAST(max(len(message_loss_mask)) AS BIGINT) AS longest FROM trajectories GROUP BY 1")
def mask_sums(spark: SparkSession, d: str) -> DataFrame:
    total = F.aggregate("message_loss_mask", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return _rows(spark, d).groupBy("source_scaffold").agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("weight"), F.count_if(F.array_contains("message_loss_mask", F.lit(1).cast("bigint"))).alias("supervised"), F.max(F.size("message_loss_mask")).cast("bigint").alias("longest"))


@query(BASE + "SELECT CASE WHEN message_loss_mask IS NULL THEN 'missing' WHEN len(message_loss_mask) = json_array_length(mj) THEN 'same' WHEN len(message_loss_mask) < json_array_length(mj) THEN 'shorter' ELSE 'longer' END AS mask, count(*) AS n FROM s GROUP BY 1")
def mask_lengths(spark: SparkSession, d: str) -> DataFrame:
    n, mask = F.size(X.items(X.json_value(F.col("messages_json")))), F.size("message_loss_mask")
    state = F.when(F.col("message_loss_mask").isNull(), "missing").when(mask == n, "same").when(mask < n, "shorter").otherwise("longer")
    return _rows(spark, d).groupBy(state.alias("mask")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source_scaffold, source_dataset, teacher, grouping(source_dataset) AS g1, grouping(teacher) AS g2, count(*) AS n FROM trajectories GROUP BY GROUPING SETS ((source_scaffold, source_dataset), (source_scaffold, source_dataset, teacher))")
def grouped_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d).groupingSets([[F.col("source_scaffold"), F.col("source_dataset")], [F.col("source_scaffold"), F.col("source_dataset"), F.col("teacher")]], "source_scaffold", "source_dataset", "teacher")
    return rows.agg(F.grouping("source_dataset").cast("bigint").alias("g1"), F.grouping("teacher").cast("bigint").alias("g2"), F.count(F.lit(1)).alias("n"))


@query("SELECT id, source_scaffold, CAST(file_row_number AS BIGINT) AS source_row_index FROM (SELECT row_number() OVER () - 1 AS file_row_number, id, source_scaffold FROM trajectories) WHERE file_row_number < 100")
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The limit operator: the first hundred rows in stored order."""
    return S.dense_row_index(_rows(spark, d)).where("source_row_index < 100").select("id", "source_scaffold", "source_row_index")


@query(BASE + """, k2 AS (SELECT source_scaffold, list_sort(list_distinct(list(tool))) AS used FROM c WHERE tool IS NOT NULL GROUP BY 1), n2 AS (SELECT source_scaffold, list_sort(list_distinct(list(name))) AS declared FROM d GROUP BY 1)
SELECT source_scaffold, array_to_string(used, ',') AS used, array_to_string(list_sort(list_filter(declared, lambda x: NOT list_contains(used, x))), ',') AS unused, array_to_string(list_sort(list_intersect(declared, used)), ',') AS both, len(list_filter(used, lambda x: NOT list_contains(declared, x))) = 0 AS all_declared FROM k2 JOIN n2 USING (source_scaffold)""")
def tool_sets(spark: SparkSession, d: str) -> DataFrame:
    """Set difference, intersection and subset of used and declared tools."""
    rows = _rows(spark, d)
    used = S.calls(S.messages(rows)).where("tool is not null").groupBy("source_scaffold").agg(F.array_sort(F.collect_set("tool")).alias("used"))
    declared = S.definitions(rows).groupBy("source_scaffold").agg(F.array_sort(F.collect_set("name")).alias("declared"))
    both = used.join(declared, "source_scaffold")
    return both.select("source_scaffold", F.array_join("used", ",").alias("used"), F.array_join(F.array_sort(F.array_except("declared", "used")), ",").alias("unused"), F.array_join(F.array_sort(F.array_intersect("declared", "used")), ",").alias("both"), (F.size(F.array_except("used", "declared")) == 0).alias("all_declared"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
