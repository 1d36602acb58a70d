"""Command lines: ``python -m quern COMMAND``, each a step of the pipeline."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from quern.core.shared import ship
from quern.plans import pipeline as L
from quern.plans.codes import TARGETS
from quern.plans.http_client import http_client
from quern.plans.reuse import donors, reuse
from quern.sources.demo import demo_sessions
from quern.sources.files import write_parquet


def _compile(spark: SparkSession, a: argparse.Namespace) -> object:
    return L.compile_to(L.load(spark, a.source, a.limit), a.source, a.out, a.targets)


def _prepare(spark: SparkSession, a: argparse.Namespace) -> object:
    return L.prepare_to(L.load(spark, a.source), a.source, a.compiled, a.out, a.targets)


def _prompts(spark: SparkSession, a: argparse.Namespace) -> object:
    L.export_prompts(spark.read.parquet(f"{a.stage}/stage"), a.out, a.limit)
    return {"prompts": a.out}


def _ask(spark: SparkSession, a: argparse.Namespace) -> object:
    stage = spark.read.parquet(f"{a.stage}/stage")
    done = L.run_queue(stage, a.journal, http_client(a.url, a.model, a.key), a.limit, a.attempts, a.concurrent, retry_failed=not a.keep_failed, settings={"model": a.model, "url": a.url})
    return {"finished": done.count()}


def _reuse(spark: SparkSession, a: argparse.Namespace) -> object:
    requests, given = (spark.read.parquet(f"{p}/stage").where("kind = 'request'") for p in (a.stage, a.donor_stage))
    write_parquet(reuse(requests, donors(given, spark.read.parquet(a.journal))), a.out)
    return {"reused": spark.read.parquet(a.out).count()}


def _finalize(spark: SparkSession, a: argparse.Namespace) -> object:
    results = [spark.read.parquet(p) for p in a.results]
    results = [r.where("state = 'done'") if "state" in r.columns else r for r in results]
    return L.finalize_to(a.stage, L.unite(*results), a.out, a.targets)


def _audit(spark: SparkSession, a: argparse.Namespace) -> object:
    found = L.audit(L.load(spark, a.source), a.stage, a.final)
    write_parquet(found, a.out)
    return {r["violation"]: r["count"] for r in spark.read.parquet(a.out).groupBy("violation").count().collect()}


def _demo(spark: SparkSession, a: argparse.Namespace) -> object:
    write_parquet(demo_sessions(spark), a.out)
    return {"sessions": spark.read.parquet(a.out).count()}


_LIMIT = ("--limit", {"type": int, "default": 0})
_TARGETS = ("--targets", {"nargs": "+", "choices": [*TARGETS]})
#: What each command takes; a name without dashes is required.
COMMANDS = {
    "demo": (_demo, ["out"], []),
    "compile": (_compile, ["source", "out"], [_LIMIT, _TARGETS]),
    "prepare": (_prepare, ["source", "compiled", "out"], [_TARGETS]),
    "prompts": (_prompts, ["stage", "out"], [_LIMIT]),
    "ask": (_ask, ["stage", "journal", "url", "model"], [_LIMIT, ("--key", {"default": "", "help": "environment variable of the key"}), ("--attempts", {"type": int, "default": 6}), ("--concurrent", {"type": int, "default": L.CONCURRENT}), ("--keep-failed", {"action": "store_true"})]),
    "reuse": (_reuse, ["stage", "donor_stage", "journal", "out"], []),
    "finalize": (_finalize, ["stage", "out"], [("--results", {"nargs": "+", "required": True}), _TARGETS]),
    "audit": (_audit, ["source", "stage", "out"], [("--final", {})]),
}


def main(words: list[str] | None = None) -> int:
    """Runs a command, prints its report as JSON; an audit with violations ends with 1."""
    parser = argparse.ArgumentParser(prog="quern", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, needed, options) in COMMANDS.items():
        own = commands.add_parser(name)
        for n in needed:
            own.add_argument(n)
        for n, more in options:
            own.add_argument(n, **more)
    a = parser.parse_args(words)
    if hasattr(a, "targets"):
        a.targets = tuple(a.targets) if a.targets else (None if a.command == "finalize" else tuple(TARGETS))
    spark = SparkSession.builder.appName("quern " + a.command).getOrCreate()
    ship(spark)
    report = COMMANDS[a.command][0](spark, a)
    print(json.dumps(report, ensure_ascii=False, sort_keys=True, default=str))
    return int(a.command == "audit" and bool(report))


if __name__ == "__main__":
    sys.exit(main())
