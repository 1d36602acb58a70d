"""Sessions as a stream: compilation of arriving rows, and late results.

Compilation holds no state, so the batch passes run unchanged on a stream.
Rows waiting for results are keyed by session and target; a row leaves with the
last result it waits for, and results that come after its time go astray.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.plans.sessions import compile_sessions, records
from quern.sources.sessions import SESSION_SCHEMA


def session_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SESSION_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def compiled_stream(sessions: DataFrame) -> DataFrame:
    """Plans of every arriving session."""
    return compile_sessions(records(sessions))


def attempts_by_window(attempts: DataFrame, width: str = "1 hour", late: str = "2 days") -> DataFrame:
    """Attempts, failures and seconds by window of their start; repeated rows
    within the watermark count once, later ones are dropped."""
    rows = attempts.withColumn("started", F.col("started").cast("timestamp")).withWatermark("started", late).dropDuplicatesWithinWatermark(["id"])
    return rows.groupBy(F.window("started", width)).agg(F.count(F.lit(1)).alias("attempts"), F.count_if((F.col("status") != 200) | F.col("error").isNotNull()).alias("failures"), F.round(F.sum("seconds"), 6).alias("seconds"))


WAIT_FIELDS = "id string, target string, state string, missing int, results string"
_STATE = "pending array<string>, results map<string,string>"


def _wait(timeout_ms: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pending, results = (list(state.get[0]) if state.exists and state.get[0] is not None else None, dict(state.get[1] or {}) if state.exists else {})

        def out(kind: str, missing: int) -> pd.DataFrame:
            return pd.DataFrame([{"id": key[0], "target": key[1], "state": kind, "missing": missing, "results": json.dumps(results, sort_keys=True)}])

        if state.hasTimedOut:
            state.remove()
            yield out("expired", len(set(pending or []) - results.keys()))
            return
        for frame in frames:
            for row in frame.itertuples():
                if row.kind == "staged":
                    pending = list(row.pending)
                else:
                    results[row.request_id] = row.result
        missing = set(pending) - results.keys() if pending is not None else None
        if missing is not None and not missing:
            yield out("complete", 0)
            if state.exists:
                state.remove()
        else:
            state.update((pending, results))
            state.setTimeoutDuration(timeout_ms)

    return step


def waiting_rows(events: DataFrame, timeout_ms: int = 7 * 24 * 3600 * 1000) -> DataFrame:
    """One row for each session and target when all its results are there
    (complete) or its time is over (expired).  events: id, target, kind (staged,
    result), pending array, request_id, result."""
    return events.groupBy("id", "target").applyInPandasWithState(_wait(timeout_ms), WAIT_FIELDS, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
