"""The pipeline from files to training rows, with a client made for the test."""

import json
import sys

import pytest
from conftest import session_row
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quern.core.jsonio import canonical
from quern.plans import pipeline as L
from quern.plans import sessions as P
from quern.plans.codes import Refusal
from quern.plans.reuse import donors, reuse
from quern.sources.files import content_hashes, read_json_lines, write_json_lines
from quern.sources.sessions import SESSION_SCHEMA

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests


def client():
    """Answers with a context that quotes the first suggestion."""

    def answer(messages, budget):
        body = json.loads(messages[1]["content"])
        quote = body["exact_quote_suggestions"][0]
        context = {"context": "It happened.", "evidence": [quote], "uncertainties": []}
        whole = {"decision": "context", "promotions": [], "fallback": context} if "review" in body else context
        return L.Answer(200, json.dumps(whole), usage={"total_tokens": 3})

    return answer


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("pipe"))
    rows = [session_row(), session_row(id="s2", messages=[{"role": "user", "content": "hi"}, {"role": "assistant", "content": "bye"}]), session_row(id="s3", messages_json="[{")]
    spark.createDataFrame(rows, SESSION_SCHEMA).coalesce(1).write.parquet(f"{base}/source")
    source = L.load(spark, f"{base}/source")
    compiled = L.compile_to(source, f"{base}/source", f"{base}/compiled")
    prepared = L.prepare_to(source, f"{base}/source", f"{base}/compiled", f"{base}/stage")
    results = L.run_queue(spark.read.parquet(f"{base}/stage/stage"), f"{base}/journal", client)
    final = L.finalize_to(f"{base}/stage", results, f"{base}/final")
    return base, source, compiled, prepared, results, final


def test_counts(done):
    _, _, compiled, prepared, _, final = done
    assert compiled["by_source"]["Claude Code/write_file"] == 1 and compiled["refused"] == {"SESSION_UNREADABLE": 1}
    assert prepared["rows"] == {"openhands_sdk/exported": 1, "openhands_sdk/pending_rewrites": 1, "sweagent/exported": 1, "sweagent/pending_rewrites": 1}
    assert final["rows"] == {"openhands_sdk/exported": 2, "sweagent/exported": 2}


def test_audit_is_empty(done):
    base, source, *_ = done
    assert L.audit(source, f"{base}/stage", f"{base}/final").collect() == []


def test_final_audit_sees_changes(spark, done):
    from quern.plans.audit import audit_final

    base = done[0]
    stage, judged = spark.read.parquet(f"{base}/stage/stage"), spark.read.parquet(f"{base}/final/decisions")
    rows = spark.read.parquet(f"{base}/final/rows")
    bad = rows.withColumn("source_split", F.lit("x")).withColumn("bridge_provenance_json", F.lit("[]"))
    codes = {r["violation"] for r in audit_final(stage, judged, bad).collect()}
    assert {"FINAL_SPLIT_MISMATCH", "FINAL_PROVENANCE_COVERAGE"} <= codes
    assert {r["violation"] for r in audit_final(stage, judged, rows.limit(0)).collect()} == {"FINAL_SOURCE_ROW_COVERAGE"}


def test_resume_asks_nothing_again(spark, done):
    base, _, _, _, results, _ = done

    def refuse():
        raise AssertionError("asked again")

    again = L.run_queue(spark.read.parquet(f"{base}/stage/stage"), f"{base}/journal", lambda: (lambda m, b: refuse()))
    assert again.count() == results.count() > 0


def test_errors(spark, done, tmp_path):
    base, source, *_, results, _ = done
    stranger = spark.createDataFrame([("x", "{}", "p")], "request_id string, result string, producer string")
    with pytest.raises(Refusal, match="UNKNOWN_REWRITE_RESULTS"):
        L.finalize_to(f"{base}/stage", results.unionByName(stranger), str(tmp_path / "a"))
    with pytest.raises(Refusal, match="TARGET_SELECTION"):
        L.finalize_to(f"{base}/stage", results, str(tmp_path / "b"), ("nope",))
    with pytest.raises(Refusal, match="CONFLICTING"):
        L.unite(results, results.withColumn("result", F.lit("{}")))
    assert L.unite(results, results).count() == results.count()
    spark.createDataFrame([session_row(), session_row()], SESSION_SCHEMA).write.parquet(str(tmp_path / "twice"))
    with pytest.raises(Refusal, match="DUPLICATE_TRAJECTORY_ID"):
        L.load(spark, str(tmp_path / "twice"))
    assert L.load_first(spark, str(tmp_path / "twice")).count() == 1
    with pytest.raises(Refusal, match="SOURCE_HASH"):
        L.prepare_to(source, str(tmp_path / "twice"), f"{base}/compiled", str(tmp_path / "c"))


def test_pending_without_results(spark, done, tmp_path):
    base, *_, results, _ = done
    none = L.finalize_to(f"{base}/stage", results.limit(0), str(tmp_path / "f"))
    assert none["rows"]["openhands_sdk/pending_rewrites"] == 1


def test_client_rules(done, spark):
    request = json.loads(spark.read.parquet(f"{done[0]}/stage/stage").where("kind = 'request'").first()["body"])
    seen, naps = [], []

    def script(*answers):
        left = list(answers)

        def ask(messages, budget):
            seen.append((len(messages), budget))
            return left.pop(0)

        return ask

    good = client()(L.client_messages(request), 0)
    result, journal, state = L.ask(request, script(L.Answer(500), L.Answer(200, "{}"), L.Answer(200, "x", "length"), good), sleep=naps.append)
    assert state == "done" and [j["status"] for j in journal] == [500, 200, 200, 200] and [n for n, _ in seen] == [2, 2, 3, 3] and seen[-1][1] == 2 * seen[0][1]
    assert len(naps) == 3 and 4 <= naps[2] < 5
    assert L.ask(request, script(L.Answer(401)), sleep=naps.append)[2] == "pending"
    assert L.ask(request, script(L.Answer(400)), sleep=naps.append)[2] == "failed"
    assert L.ask(request, script(*[L.Answer(503)] * 2), attempts=2, sleep=naps.append)[2] == "failed"


def test_reuse(spark, done):
    base = done[0]
    stage, journal = spark.read.parquet(f"{base}/stage/stage").where("kind = 'request'"), spark.read.parquet(f"{base}/journal")
    given = donors(stage, journal)
    reused = reuse(stage, given)
    assert reused.count() == stage.where("not eligible").count()
    if (r := reused.first()) is not None:
        assert json.loads(r["result"])["reuse"]["donor_request_id"] == r["donor_id"]
    twice = stage.where("not eligible").limit(1)
    later = twice.withColumns({"seq": F.lit(99), "request_id": F.lit("0")})
    told = journal.where("attempts = 1").limit(1).withColumns({"producer": F.lit("llm_segment_context_v2"), "attempts": F.lit(1).cast("bigint")})
    if twice.count():
        both = told.withColumn("request_id", F.lit("0")).unionByName(told.withColumn("request_id", F.lit(twice.first()["request_id"])))
        assert donors(twice.unionByName(later), both).first()["donor_id"] == twice.first()["request_id"]
    with pytest.raises(Refusal, match="INCOMPLETE"):
        donors(stage, journal.withColumn("state", F.lit("failed")))


def test_prompts_and_lines(spark, done, tmp_path):
    base = done[0]
    L.export_prompts(spark.read.parquet(f"{base}/stage/stage"), str(tmp_path / "p"), limit=1)
    back = read_json_lines(spark, str(tmp_path / "p"), "request_id string, route string, messages string")
    assert back.count() == 1 and json.loads(back.first()["messages"])[0]["role"] == "system"
    rows = spark.createDataFrame([("b", None, [1])], "z string, a string, n array<int>")
    write_json_lines(rows, str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).first()[0] == canonical({"z": "b", "a": None, "n": [1]})
    with pytest.raises(Exception, match="(?i)exists"):
        write_json_lines(rows, str(tmp_path / "l"))
    assert content_hashes(spark, str(tmp_path / "l")).count() >= 1


def test_same_at_any_partitioning(spark, done):
    source = done[1]
    one = P.compile_sessions(source.repartition(1)).orderBy("id", "target", "message_index").drop("source_row_index").collect()
    many = P.compile_sessions(source.repartition(7)).orderBy("id", "target", "message_index").drop("source_row_index").collect()
    assert one == many


def test_queue_stops_commits_and_resumes(spark, done, tmp_path):
    base, journal = done[0], str(tmp_path / "journal")
    stage = spark.read.parquet(f"{base}/stage/stage")
    total = stage.where("kind = 'request'").select("request_id").distinct().count()
    assert total >= 2
    refused = L.run_queue(stage, journal, lambda: (lambda m, b: L.Answer(401)), committed=1, settings={"model": "m"})
    assert refused.count() == 0 and {r["state"] for r in spark.read.parquet(journal).select("state").collect()} == {"pending"}
    with pytest.raises(Refusal, match="RESUME_SETTINGS_CHANGED:model"):
        L.run_queue(stage, journal, client, settings={"model": "other"})
    assert L.run_queue(stage, journal, client, committed=1, settings={"model": "m"}).count() == total
    ordered = L.in_order(spark.read.parquet(journal).where("state = 'done'"), stage).select("id", "target", "seq").collect()
    assert ordered == sorted(ordered) and len(ordered) == total
    from quern.sources.files import exists, write_document

    assert not exists(spark, journal + ".lock")
    write_document(spark, journal + ".lock", {})
    with pytest.raises(Refusal, match="JOURNAL_IN_USE"):
        L.run_queue(stage, journal, client, settings={"model": "m"})


def test_requests_of_a_task_are_asked_at_once(spark, done):
    stage = spark.read.parquet(f"{done[0]}/stage/stage").where("kind = 'request'").select("request_id", "body").limit(1)
    many = stage.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(16)))).select(F.concat("request_id", "n").alias("request_id"), "body").coalesce(1)

    def slow():
        import time

        def answer(messages, budget):
            time.sleep(0.5)
            return L.Answer(400)

        return answer

    import time

    began = time.time()
    assert {r["state"] for r in L.ask_all(many, slow).collect()} == {"failed"} and time.time() - began < 6
    stopped = L.ask_all(many, lambda: (lambda m, b: L.Answer(401)), concurrent=1).collect()
    assert {r["state"] for r in stopped} == {"pending"} and sum(r["attempts"] for r in stopped) == 1  # no more were sent


def test_errors_hold_no_keys():
    from quern.plans.clients import error_label, redacted

    assert "abc123" not in error_label(OSError("401 for Authorization: Bearer abc123")) and "sk-12345678" not in redacted("key sk-12345678 given")
    assert redacted("api_key='zzz' and text") == "api_key='[REDACTED]' and text"


def test_http_client(monkeypatch):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from quern.plans.http_client import http_client

    seen = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            self.send_response(200 if len(seen) == 1 else 403)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": "hi"}, "finish_reason": "length"}], "usage": {"total_tokens": 1}}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("TEST_KEY", "k")
    ask = http_client(f"http://127.0.0.1:{server.server_port}", "m", "TEST_KEY", temperature=0)()
    assert ask([{"role": "user", "content": "x"}], 7) == L.Answer(200, "hi", "length", {"total_tokens": 1}) and ask([], 1).status == 403
    assert seen[0] == ("Bearer k", {"model": "m", "messages": [{"role": "user", "content": "x"}], "max_tokens": 7, "temperature": 0})
    server.shutdown()


def test_command_lines(spark, tmp_path, capsys):
    from quern.__main__ import main

    at = {n: str(tmp_path / n) for n in ("source", "compiled", "stage", "prompts", "journal", "final", "audit", "reused")}

    def run(*words):
        code = main([*words])
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert run("demo", at["source"]) == (0, {"sessions": 6})
    assert run("compile", at["source"], at["compiled"])[1]["refused"] == {}
    assert run("prepare", at["source"], at["compiled"], at["stage"])[1]["phase"] == "prepare"
    assert run("prompts", at["stage"], at["prompts"], "--limit", "2")[0] == 0
    L.run_queue(spark.read.parquet(at["stage"] + "/stage"), at["journal"], client)
    assert run("reuse", at["stage"], at["stage"], at["journal"], at["reused"])[0] == 0
    done = run("finalize", at["stage"], at["final"], "--results", at["journal"])[1]
    assert sum(n for k, n in done["rows"].items() if k.endswith("/exported")) > 0
    assert run("audit", at["source"], at["stage"], at["audit"], "--final", at["final"]) == (0, {})
