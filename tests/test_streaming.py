import json

from conftest import session_row
from pyspark.sql import functions as F

from quern.plans.sessions import compile_sessions
from quern.sources.sessions import SESSION_SCHEMA
from quern.streaming import sessions as S


def drain(query):
    query.awaitTermination(120)
    assert not query.isActive


def test_compiled_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([session_row(), session_row(id="s2")], SESSION_SCHEMA)
    rows.write.parquet(str(tmp_path / "in"))
    stream = S.compiled_stream(S.session_stream(spark, str(tmp_path / "in")))
    drain(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    key = ["id", "target", "message_index", "status", "actions_json"]
    assert sorted(spark.read.parquet(str(tmp_path / "out")).select(*key).collect()) == sorted(compile_sessions(rows).select(*key).collect())


def test_attempt_windows(spark, tmp_path):
    data = [(1, "2024-01-01 00:10:00", 200, None, 1.0), (1, "2024-01-01 00:10:00", 200, None, 1.0), (2, "2024-01-01 00:20:00", 500, "e", 2.0), (3, "2024-01-01 01:20:00", 200, None, 3.0)]
    spark.createDataFrame(data, "id bigint, started string, status bigint, error string, seconds double").withColumn("started", F.to_timestamp("started")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint, started timestamp, status bigint, error string, seconds double").parquet(str(tmp_path / "in"))
    drain(S.attempts_by_window(stream).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    got = [(r["attempts"], r["failures"], r["seconds"]) for r in spark.table("windows").orderBy("window.start").collect()]
    assert got == [(2, 1, 3.0), (1, 0, 3.0)]


def test_waiting_rows(spark, tmp_path):
    fields = "id string, target string, kind string, pending array<string>, request_id string, result string"
    events = [("a", "t", "result", None, "r1", "x"), ("a", "t", "staged", ["r1", "r2"], None, None), ("a", "t", "result", None, "r2", "y"), ("b", "t", "staged", ["r9"], None, None)]
    spark.createDataFrame(events, fields).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(fields).parquet(str(tmp_path / "in"))
    query = S.waiting_rows(stream).writeStream.format("memory").queryName("waiting").option("checkpointLocation", str(tmp_path / "c")).start()
    for _ in range(60):
        if query.awaitTermination(1) or spark.table("waiting").count():
            break
    query.stop()
    rows = spark.table("waiting").collect()
    assert [(r["id"], r["state"], json.loads(r["results"])) for r in rows] == [("a", "complete", {"r1": "x", "r2": "y"})]
