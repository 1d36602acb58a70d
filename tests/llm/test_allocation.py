import pytest

from quern.llm import splits


def test_flow_covers_large_components():
    bundles = [(2, 2, 1, 1), (2, 2, 0, 1)]
    assert splits.allocate(bundles, {"a": 0.5, "b": 0.5}) == [[0, 1], [1, 0]]


def test_too_many_splits_are_an_error(spark):
    rows = spark.createDataFrame([("i", "o__r-1", "train")], "id string, task_group_key string, split string")
    targets = spark.createDataFrame([(f"s{k}", 1.0) for k in range(65)], "split string, share double")
    with pytest.raises(ValueError):
        splits.assign_splits(rows, targets)


def test_every_key_of_an_id_joins_its_task(spark):
    data = [("m", k, "train") for k in ("a/r#1", "b/r#2", "c/r#3", "d/r#4")] + [(f"i{k}", f"{k}/r#{n}", s) for n, (k, s) in enumerate(zip("abcd", ["train", "test", "dev", "train"]), 1)] + [(f"x{k}", f"x/r#{k}", "train") for k in range(20)]
    df = spark.createDataFrame(data, "id string, task_group_key string, split string")
    targets = spark.createDataFrame([("train", 0.5), ("test", 0.5)], "split string, share double")
    done = {r["id"]: r for r in splits.assign_splits(df, targets).collect()}
    joined = [done[i] for i in ("m", "ia", "ib", "ic", "id")]
    assert len(done) == 25 and len({r["component"] for r in joined}) == len({r["split"] for r in joined}) == 1
    assert {r["id"] for r in splits.leaking_ids(df).collect()} == {"m", "ib", "ic"}  # each task for itself
    assert {r["id"] for r in splits.leaking_ids(df.where("id <> 'm'")).collect()} == set()


@pytest.mark.parametrize("most", [1, 40, 513])
def test_rounded_bundles_keep_totals(spark, monkeypatch, most):
    monkeypatch.setattr(splits, "MAX_BUNDLES", most)
    data = [(f"i{k}", f"o/r#{int(k**0.7)}", ("train", "dev", "test", None)[k * 7 % 4]) for k in range(3000)]
    df = spark.createDataFrame(data, "id string, task_group_key string, split string")
    targets = spark.createDataFrame([("train", 0.7), ("validation", 0.1), ("test", 0.2)], "split string, share double")
    done = splits.assign_splits(df, targets).collect()
    assert len({r["id"] for r in done}) == len(done) == 3000
    assert len({(r["component"], r["split"]) for r in done}) == len({r["component"] for r in done})
    assert abs(sum(r["split"] == "test" for r in done) / 3000 - 0.2) < 0.02


def test_result_is_the_same_at_any_limit(spark, monkeypatch):
    """The limits choose how the plan is joined and members are ranked, never who goes where."""
    data = [(f"i{k}", f"o/r#{int(k**0.8)}", ("train", "dev", "test", None)[k * k * 7 % 11 % 4]) for k in range(3000)]
    data += [(f"s{k}", None, ("train", "dev")[k % 2]) for k in range(500)]  # bundles with hundreds of members
    df = spark.createDataFrame(data, "id string, task_group_key string, split string")
    targets = spark.createDataFrame([("train", 0.7), ("validation", 0.1), ("test", 0.2)], "split string, share double")
    whole = sorted(splits.assign_splits(df, targets).collect())
    assert len(whole) == 3500
    for limits in ({"MAX_BUNDLES": 1}, {"MAX_BUNDLES": 20}, {"RANK_ROWS": 7}, {"RANK_ROWS": 100}, {"HOT_PARTS": 5}, {"MAX_BUNDLES": 1, "RANK_ROWS": 7, "HOT_PARTS": 5}):
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(splits, name, value)
            assert sorted(splits.assign_splits(df, targets).collect()) == whole, limits
