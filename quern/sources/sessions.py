"""Reading sessions, and their messages, calls and definitions as native tables.

``row_key`` tells delivered rows apart, also of one id: the file's whole path
and the row's place in it, so that a row keeps its key when a lost task is run
again and files of one name in several folders are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.core.shared import materialize, spread
from quern.functions import text as X
from quern.plans.codes import SOURCE_TOOLS, TARGETS

SESSION_SCHEMA = (
    "id string, source_scaffold string, split string, messages_json string, tools_json string, message_loss_mask array<bigint>, task_group_key string, "
    "source_dataset string, source_revision string, teacher string, acceptance_basis string, reference_tokens bigint"
)


#: Most rows of one a file, or one a repeated id, that are sent to all executors.
SENT_ROWS = 200_000


def row_key() -> Column:
    return F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def sent(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` for a join: sent to all executors if they are ``SENT_ROWS`` or
    fewer; more are shuffled."""
    return F.broadcast(rows) if n <= SENT_ROWS else rows


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Sessions with ``row_key`` and the row's index in its file."""
    rows = spark.read.schema(SESSION_SCHEMA).parquet(path)
    return rows.select("*", row_key().alias("row_key"), F.col("_metadata.row_index").alias("file_row_index"), F.col("_metadata.file_path").alias("file_path"))


def dense_row_index(rows: DataFrame) -> DataFrame:
    """``rows`` with ``source_row_index``: dense over all files in order of path,
    by the number of rows before each file.  The files are as many as the driver
    lists anyway; up to ``SENT_ROWS`` of them are joined without a shuffle."""
    sizes = rows.groupBy("file_path").agg((F.max("file_row_index") + 1).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("file_path")) - F.col("n")).select("file_path", "before")
    return rows.join(sent(before, len(rows.inputFiles())), "file_path").withColumn("source_row_index", F.col("before") + F.col("file_row_index")).drop("before")


def first_of_each_id(rows: DataFrame, index: str = "file_row_index") -> DataFrame:
    """The first delivered row of each id.  Only keys are grouped.  Up to
    ``SENT_ROWS`` repeated ids are sent to where the rows lie; with more, whole
    rows are shuffled by id."""
    order = F.struct("file_path", index)
    repeated = materialize(rows.groupBy("id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    return rows.join(sent(repeated, repeated.count()), "id", "left").where(F.col("first").isNull() | (order == F.col("first"))).drop("first")


def messages(rows: DataFrame) -> DataFrame:
    """A row for each message object: row_key, id, source_scaffold,
    message_index, role, message (variant), mask value and the session's length."""
    parsed = spread(rows.select("row_key", "id", "source_scaffold", "message_loss_mask", "messages_json")).select("row_key", "id", "source_scaffold", "message_loss_mask", X.items(X.json_value(F.col("messages_json"))).alias("all"))
    out = parsed.select("row_key", "id", "source_scaffold", "message_loss_mask", F.size("all").alias("n_messages"), F.posexplode("all").alias("message_index", "message"))
    out = out.where(X.kind_of(F.col("message")) == "object")
    return out.select("row_key", "id", "source_scaffold", "n_messages", "message_index", X.text_field(F.col("message"), "role").alias("role"), F.try_element_at("message_loss_mask", F.col("message_index") + 1).alias("mask"), "message")


def calls(messages_: DataFrame) -> DataFrame:
    """A row for each call object of a message; arguments as JSON text."""
    out = messages_.select("row_key", "id", "source_scaffold", "n_messages", "message_index", "role", "mask", F.posexplode(X.items(X.field(F.col("message"), "tool_calls"))).alias("call_index", "call"))
    function = X.field(F.col("call"), "function")
    arguments = X.field(function, "arguments")
    as_text = F.when(X.kind_of(arguments) == "string", F.try_variant_get(arguments, "$", "string")).when(X.kind_of(arguments) == "object", F.to_json(arguments))
    return out.where(X.kind_of(F.col("call")) == "object").select("row_key", "id", "source_scaffold", "n_messages", "message_index", "call_index", "role", "mask", X.text_field(F.col("call"), "id").alias("call_id"), X.text_field(function, "name").alias("tool"), X.kind_of(arguments).alias("arguments_kind"), as_text.alias("arguments"))


def definitions(rows: DataFrame) -> DataFrame:
    """Tool definitions: the last of each name in a session."""
    tools = rows.select("row_key", "id", "source_scaffold", F.posexplode(X.items(X.json_value(F.col("tools_json")))).alias("position", "tool"))
    own = F.when(X.kind_of(X.field(F.col("tool"), "function")) == "object", X.field(F.col("tool"), "function")).otherwise(F.col("tool"))
    flat = tools.select("row_key", "id", "source_scaffold", "position", X.text_field(own, "name").alias("name"), X.text_field(own, "description").alias("description")).where("name is not null")
    return flat.groupBy("row_key", "id", "source_scaffold", "name").agg(F.max_by("description", "position").alias("description"), F.max("position").alias("position"))


def dispatch(spark: SparkSession) -> DataFrame:
    """scaffold, tool, kind: the fixed table calls are lowered by."""
    return spark.createDataFrame([(s, t, k) for s, tools in SOURCE_TOOLS.items() for t, k in tools.items()], "source_scaffold string, tool string, kind string")


def targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t.name, t.shell, t.editor, t.finish, t.input_to_process, t.thinks) for t in TARGETS.values()], "target string, shell string, editor string, finish string, process_input boolean, thinks boolean")
