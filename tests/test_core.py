import json

import pytest
from pyspark.sql import functions as F

from quern.core.jsonio import canonical, digest, load_list, loads
from quern.core.labels import split_name, task_key
from quern.core.shared import discard, materialize, shared_folder


def test_json():
    assert loads(None) is loads(" ") is loads("[1") is loads("null") is None
    assert loads(json.dumps(json.dumps([1]))) == [1] and load_list("{}") == []
    often = json.dumps([1])
    for _ in range(6):
        often = json.dumps(often)
    assert loads(often) == [1] and loads(json.dumps(json.dumps("text"))) is None
    assert canonical({"b": "é", "a": [1, None]}) == '{"a":[1,null],"b":"é"}'
    assert digest({"x": "\ud83d"}) == digest({"x": "\ud83d"})


@pytest.mark.parametrize(("text", "want"), [("train", "train"), (" TRAIN ", "train"), ("Dev", "validation"), ("val", "validation"), ("testing", "test"), ("", None), (None, None), ("other", None)])
def test_splits(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(split_name(F.col("s"))).first()[0] == want


KEYS = ["Own-er__Re.po-2-007", "own-er/re.po-2#7", "OWN-ER/re.po-2/7/", "https://forge.example/own-er/re.po-2/issues/7", "https://forge.example/own-er/re.po-2/pull/7", "forge:own-er/re.po-2/issues/7?ref=x", "own-er__re.po-2-7@1a2b3c4", "\town-er__re.po-2-7 \n", "https://forge.example/own-er/re.po-2/issues/7#c1"]


def test_task_keys(spark):
    rows = spark.createDataFrame([(k,) for k in KEYS[:-1]], "k string")
    assert {r[0] for r in rows.select(task_key(F.col("k"))).collect()} == {"own-er/re.po-2#7"}
    none = spark.createDataFrame([(k,) for k in ("", "  ", None, "unknown", "TBD", "n/a", "-", "owner/repo", "17", "a__b-c")], "k string")
    assert {r[0] for r in none.select(task_key(F.col("k"))).collect()} == {None}
    assert spark.createDataFrame([("a__b-000",)], "k string").select(task_key(F.col("k"))).first()[0] == "a/b#0"


def test_materialize_uses_the_shared_folder(spark):
    df = materialize(spark.range(5).withColumn("x", F.rand()), "t")
    assert df.collect() == df.collect() and shared_folder(spark).startswith("file:")
    assert any(shared_folder(spark).removeprefix("file://") in f.removeprefix("file://") for f in df.inputFiles())


def test_discarded_tables_are_gone(spark):
    import os

    df = materialize(spark.range(5), "t")
    path = df.written_to.removeprefix("file://")
    assert os.path.isdir(path)
    discard(df)
    assert not os.path.exists(path)


def test_row_keys_of_partitioned_tables(spark, tmp_path):
    from quern.sources.sessions import dense_row_index, first_of_each_id, read_sessions

    for part in ("a", "b", "c"):  # one file of one name in each folder
        made = str(tmp_path / f"made-{part}")
        spark.range(41).select(F.concat(F.lit("s"), "id").alias("id"), F.lit(part).alias("source_scaffold")).coalesce(1).write.parquet(made)
        (tmp_path / "t" / f"p={part}").mkdir(parents=True)
        next((tmp_path / f"made-{part}").glob("*.parquet")).rename(tmp_path / "t" / f"p={part}" / "part-0.parquet")
    rows = read_sessions(spark, str(tmp_path / "t"))
    assert rows.count() == 123 and rows.select("row_key").distinct().count() == 123
    assert {r[0] for r in dense_row_index(rows).select("source_row_index").collect()} == set(range(123))
    assert sorted((r[0], r[1]) for r in first_of_each_id(rows).select("id", "source_scaffold").collect()) == sorted((f"s{k}", "a") for k in range(41))


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    context = SimpleNamespace(master="spark://x:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))))
    with pytest.raises(RuntimeError):
        shared_folder(SimpleNamespace(conf={}, sparkContext=context))
