import json
import random

import numpy as np
import pytest

from quern.llm import pieces, splits
from quern.llm.pieces import PENALTY, best_cuts, boundaries, cut_texts

SHARES = {"train": 0.8, "validation": 0.08, "test": 0.12}


def targets(spark, shares=SHARES):
    return spark.createDataFrame(list(shares.items()), "split string, share double")


def rows(spark, data):
    return spark.createDataFrame(data, "id string, task_group_key string, split string, component string")


def test_groups_stay_together_near_the_shares(spark):
    rng = random.Random(3)
    data = []
    for k in range(3000):
        task = 1 if k % 3 == 0 else rng.randrange(2, 400)  # one task holds a third of all
        data.append((f"i{k}", rng.choice([f"o__r-{task}", f"O/R#{task:04d}"]), rng.choice(["train"] * 8 + ["dev", "test", ""]), "clash"))
    df = rows(spark, data)
    done = splits.assign_splits(df, targets(spark)).collect()
    assert len(done) == 3000 and len({r["id"] for r in done}) == 3000
    of = {}
    for r in done:
        assert of.setdefault(r["component"], r["split"]) == r["split"]
    share = {s: sum(r["split"] == s for r in done) / 3000 for s in SHARES}
    assert all(abs(share[s] - SHARES[s]) < 0.005 for s in SHARES), share
    again = splits.assign_splits(df.repartition(3), targets(spark)).collect()
    assert sorted(again) == sorted(done)
    report = {r["split"]: r for r in splits.split_report(df, targets(spark)).collect()}
    assert sum(r["records"] for r in report.values()) == 3000 and report["train"]["target_share"] == 0.8


def test_dirt(spark):
    data = [("a", None, "train", None), ("a", None, "train", None), ("b", "", None, None), ("c", "x__y-1", "test", None), ("d", "X/y#01", "train", None), ("e", "p__q-2", "dev", None), ("e", "x/y#1", "dev", None), (None, "x__y-1", "test", None)]
    done = {r["id"]: r for r in splits.assign_splits(rows(spark, data), targets(spark)).collect()}
    assert set(done) == set("abcde") and done["c"]["split"] == done["d"]["split"] == done["e"]["split"]
    assert {r["id"] for r in splits.leaking_ids(rows(spark, data)).collect()} == {"c", "d", "e"}
    assert splits.assign_splits(rows(spark, data).limit(0), targets(spark)).count() == 0


def test_rank_buckets_and_coarse_profiles(spark, monkeypatch):
    monkeypatch.setattr(splits, "RANK_ROWS", 10)
    monkeypatch.setattr(splits, "MAX_BUNDLES", 4)
    monkeypatch.setattr(splits, "HOT_PARTS", 5)
    data = [(f"i{k}", f"o__r-{k // (1 + k % 4)}", ["train", "dev", "test"][k % 3], None) for k in range(500)]
    done = splits.assign_splits(rows(spark, data), targets(spark)).collect()
    assert len({r["id"] for r in done}) == len(done) == 500
    assert abs(sum(r["split"] == "train" for r in done) / 500 - 0.8) < 0.03


def test_transport_is_optimal():
    """Against all integral assignments of a small network."""
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(20):
        supply, quota = rng.integers(1, 4, 3), np.array([3.0, 2.0, 2.0])
        cost = rng.random((3, 3)).round(2)
        flow = splits.transport(supply.astype(float), cost, quota)
        assert np.allclose(flow.sum(axis=1), supply)
        price = (flow * cost).sum() + splits.DEVIATION * np.maximum(0, flow.sum(axis=0) - quota).sum()
        units = [b for b in range(3) for _ in range(supply[b])]
        best = min(sum(cost[b, s] for b, s in zip(units, to)) + splits.DEVIATION * np.maximum(0, np.bincount(to, minlength=3) - quota).sum() for to in itertools.product(range(3), repeat=len(units)))
        assert price == pytest.approx(best, abs=1e-6)


def test_quotas():
    assert splits.quotas(10, {"a": 0.5, "b": 0.25, "c": 0.25}) == {"a": 5, "b": 3, "c": 2} and sum(splits.quotas(7, SHARES).values()) == 7
    assert splits.quotas(0, SHARES) == dict.fromkeys(SHARES, 0)


# --- pieces


def whole(texts, parts):
    """The text that the parts' fresh characters give."""
    return "".join(texts[k][a + r : b] for _, k, a, b, r in parts)


@pytest.mark.parametrize("overlap", [0, 7])
def test_pieces_round_trip(overlap):
    rng = random.Random(5)
    for _ in range(60):
        texts = ["".join(rng.choice(["word ", "x. ", "\n", "\n\n", "looong", "é🙂", "\r\n", "！"]) for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(1, 6))]
        parts = cut_texts(texts, 50, overlap)
        assert whole(texts, parts) == "".join(texts)
        sizes, order = {}, []
        for piece, k, a, b, r in parts:
            sizes[piece] = sizes.get(piece, 0) + b - a
            order.append((piece, k))
        assert order == sorted(order) and all(n <= 50 for n in sizes.values())
        repeated = {}
        for piece, _, _, _, r in parts:
            repeated[piece] = repeated.get(piece, 0) + r
        assert all(n == (overlap if p else 0) for p, n in repeated.items())
        assert {k for _, k, *_ in parts} == set(range(len(texts))) or not "".join(texts)


def test_cuts_are_least_cost():
    rng = random.Random(8)
    for _ in range(30):
        at = np.array([0, *sorted(rng.sample(range(1, 60), 9)), 60])
        penalty = np.array([rng.choice([0.0, 1.0, 3.0]) for _ in at])
        if max(np.diff(at)) > 20:
            continue

        def cost(cuts, limit=25, overlap=5):
            ideal = 60 / max(1, -(-(60 - overlap) // (limit - overlap)))
            total, begin = 0.0, 0
            for c in cuts:
                if c - begin > (limit if begin == 0 else limit - overlap):
                    return float("inf")
                total += pieces.IMBALANCE * ((c - begin) / ideal - 1) ** 2 + penalty[list(at).index(c)]
                begin = c
            return total

        inner = [int(x) for x in at[1:-1]]
        best = min(cost([c for k, c in enumerate(inner) if m >> k & 1] + [60]) for m in range(1 << len(inner)))
        assert cost(best_cuts(at, penalty, 25, 5)) == pytest.approx(best)


def test_natural_boundaries_first():
    texts = ["a" * 30, "b" * 30]
    assert [(p, k) for p, k, *_ in cut_texts(texts, 40, 0)] == [(0, 0), (1, 1)]
    at, penalty = boundaries(["one. two\n\nthree\nfour"], 100)
    assert dict(zip(at.tolist(), penalty.tolist())) == {0: 0.0, 5: PENALTY["sentence"], 9: PENALTY["line"], 10: PENALTY["paragraph"], 16: PENALTY["line"], 20: PENALTY["message"]}
    assert max(np.diff(boundaries(["x" * 1000], 30)[0])) <= 30
    with pytest.raises(ValueError, match="overlap"):
        cut_texts(["x"], 5, 5)


def session(i, *texts, mask=None):
    return (i, json.dumps([{"role": "user", "content": t} for t in texts]), mask, "clash", 1)


def test_sessions(spark):
    data = [session("short", "x" * 8000), session("one", "x" * 8001, mask=[1]), session("many", "y" * 5000, "z" * 5000, mask=[0]), session("many", "y" * 5000, "z" * 5000, mask=[0]), ("cut", "[{", None, "", 1), ("null", None, None, "", 1), session("empty"), (None, session("x", "x" * 9000)[1], None, "", 1)]
    df = spark.createDataFrame(data, "id string, messages_json string, message_loss_mask array<bigint>, text string, piece int")
    assert sorted(tuple(r) for r in pieces.oversized(df).collect()) == [("many", -1), ("one", -1), ("one", 0)]
    parts = pieces.cut_sessions(df).orderBy("id", "piece", "part").collect()
    assert [(r["id"], r["piece"], r["message_index"], r["loss_mask"]) for r in parts] == [("many", 0, 0, 0), ("many", 1, 0, 0), ("many", 1, 1, None), ("one", 0, 0, 1), ("one", 1, 0, 1)]
    assert all(r["text"] == ("x" if r["id"] == "one" else "yz"[r["message_index"]]) * (r["end"] - r["start"]) for r in parts)
    assert pieces.cut_sessions(df.limit(0)).count() == 0


def test_very_long_text():
    text = "line of words. \n" * 100_000
    parts = cut_texts([text], 8000, 400)
    assert whole([text], parts) == text and max(b - a for *_, a, b, _ in parts) <= 8000
