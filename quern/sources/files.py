"""Readers and sinks of session pipelines."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON-lines file, gzipped or not; blank lines are passed
    over, a line that is no JSON is an error when it is read."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def write_json_lines(rows: DataFrame, path: str) -> None:
    """One document a line, members sorted, nulls kept, gzipped; an existing
    path is an error and nothing shows before the job commits."""
    line = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    rows.select(line.alias("value")).write.mode("errorifexists").option("compression", "gzip").text(path)


def write_parquet(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Zstandard Parquet in a new directory."""
    rows.write.mode("errorifexists").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def write_document(spark: SparkSession, path: str, value: dict, overwrite: bool = False) -> None:
    """A small JSON document on the file system of ``path``."""
    files, where, _ = _file(spark, path)
    out = files.create(where, overwrite)
    out.write(bytearray((json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode()))
    out.close()


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.sparkContext.wholeTextFiles(path, 1).values().first())


def exists(spark: SparkSession, path: str) -> bool:
    files, where, _ = _file(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    files, where, _ = _file(spark, path)
    files.delete(where, False)


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """name and SHA-256 of every data file below a directory, hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.sha2("content", 256).alias("sha256"))
