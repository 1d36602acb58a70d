"""The similarity join against brute force, at block sizes that force every path."""

import json
import random

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quern.llm import neardup, overlap, setjoin
from quern.llm.components import connected_components
from quern.llm.overlap import session_text
from quern.llm.runs import run_sets
from quern.llm.trie import join_sets


def runs(text, width=3):
    import re

    words = re.findall("[a-z0-9]+", text.lower())
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def messages(text, **extra):
    return json.dumps([{"role": "system", "content": "left out " + text[:5]}, {"role": "user", "content": text, **extra}])


def corpus(n=120, seed=4, families=12, hot=0):
    """Random texts, families of edited copies, exact copies and odd rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(n):
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 30, 60, 120]))))
    for k in range(families):
        base = texts[rng.randrange(n)].split()
        for _ in range(4):
            edited = [w for w in base]
            for _ in range(max(1, len(edited) // rng.choice([8, 20, 40]))):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            texts.append(" ".join(edited))
    texts += [texts[0]] * 3 + [texts[3].upper() + "!!"] + [texts[5]] * hot
    return [(f"i{k:04d}", t) for k, t in enumerate(texts)]


def truth_links(rows, threshold=0.5):
    sets = [(i, runs(t)) for i, t in rows]
    out = set()
    for x, (a, s) in enumerate(sets):
        for b, u in sets[x + 1 :]:
            if s and u and len(s & u) >= threshold * len(s | u):
                out.add((a, b))
    return out


def truth_groups(rows, links):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    groups = {}
    for i, _ in rows:
        groups.setdefault(find(i), []).append(i)
    return {(a, b) for g in groups.values() for a in g for b in g if a < b}


@pytest.fixture
def small_limits(monkeypatch):
    """Many blocks and shards, groups tied to hubs, routes cut in blocks."""
    for name, value in {"BLOCK_RECORDS": 7, "SHARD_RUNS": 300, "CLASS_RUNS": 40, "ROUTE_RUNS": 200, "GROUP": 3, "PASS_PAIRS": 20, "BROADCAST_ROWS": 0}.items():
        monkeypatch.setattr(setjoin, name, value)
    cloudpickle.register_pickle_by_value(setjoin)  # so that workers see the limits
    yield
    cloudpickle.unregister_pickle_by_value(setjoin)


def found(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("hot", [0, 60])
def test_groups_equal_brute_force(spark, hot):
    rows = corpus(hot=hot)
    df = spark.createDataFrame([(i, messages(t)) for i, t in rows], "id string, messages_json string").repartition(3)
    assert found(neardup.duplicate_pairs(df)) == truth_groups(rows, truth_links(rows))


def test_groups_with_small_limits(spark, small_limits):
    rows = corpus(seed=9, hot=20)
    df = spark.createDataFrame([(i, messages(t)) for i, t in rows], "id string, messages_json string").repartition(5)
    assert found(neardup.duplicate_pairs(df)) == truth_groups(rows, truth_links(rows))


@pytest.mark.parametrize("threshold", [0.3, 0.8])
def test_links_at_other_thresholds(spark, small_limits, threshold):
    rows = corpus(n=60, seed=2)
    records = spark.createDataFrame([(i, 0, messages(t)) for i, t in rows], "node string, side int, text string")
    members, links = setjoin.similarity_join(records, session_text, 3, threshold)
    of = {r["node"]: r["class"] for r in members.collect()}
    want = {tuple(sorted((of[a], of[b]))) for a, b in truth_links(rows, threshold)}
    assert {tuple(sorted((r["a"], r["b"]))) for r in links.collect()} == {p for p in want if p[0] != p[1]}


def test_two_sides(spark, small_limits):
    rows = corpus(seed=5)
    split = {i: ("Train ", "dev", "test", None)[k % 4] for k, (i, _) in enumerate(rows)}
    df = spark.createDataFrame([(i, split[i], messages(t), "d") for i, t in rows], "id string, source_split string, messages_json string, source_dataset string").repartition(3)
    words = {i: t.lower().replace("!", "").split() for i, t in rows}
    same = {(a, b) for a in words for b in words if a < b and words[a] == words[b]}
    want = {(a, b) for a, b in truth_links(rows) | same if split[a] and split[b] and (split[a] == "Train ") != (split[b] == "Train ")}
    assert found(overlap.overlap_pairs(df)) == want
    report = overlap.overlap_report(df).collect()
    side = {x for p in want for x in p if split[x] != "Train "}
    copies = {x for p in same & want for x in p if split[x] != "Train "}
    assert sum(r["same"] for r in report) == len(copies) > 0
    assert sum(r["alike"] for r in report) == len(side) and sum(r["records"] for r in report) == sum(s in ("dev", "test") for s in split.values())


def test_copies_without_runs_are_the_same(spark):
    said = {"a": "fix it", "b": "Fix,  it!", "c": "请修复这个错误。", "d": "请修复这个错误", "e": "fix that", "f": " ?! ", "g": "...", "h": "ＦＩＸ it"}
    split = {"a": "train", "c": "train", "f": "train", "e": "train"}
    df = spark.createDataFrame([(i, split.get(i, "test"), messages(t), "s") for i, t in said.items()] + [("a", "test", messages("fix it"), "s"), ("n", "train", None, "s"), ("o", "test", None, "s")], "id string, source_split string, messages_json string, source_dataset string")
    assert found(overlap.overlap_pairs(df)) == {("a", "b"), ("c", "d"), ("a", "h")}
    report = overlap.overlap_report(df).collect()
    assert [(r["records"], r["same"], r["alike"]) for r in report] == [(6, 3, 3)]
    assert overlap.overlap_pairs(df.limit(0)).count() == 0


def test_dirt_and_empty(spark):
    text = "one two three four five six"
    rows = [("a", messages(text)), ("b", json.dumps(messages(text))), ("c", messages(text)[:-4]), ("d", None), ("e", " "), (None, messages(text)), ("f", messages("one two")), ("g", messages("one two")), ("a", messages(text, more=1)), ("h", json.dumps([{"role": "user", "content": [{"type": "text", "text": "one two three"}, {"type": "text", "text": "four five six"}]}]))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, messages_json string, `group` int")
    assert found(neardup.duplicate_pairs(df)) == {("a", "b"), ("a", "h"), ("b", "h")}
    groups = {r["id"]: r["group"] for r in neardup.duplicate_groups(df).collect()}
    assert groups == {"a": "a", "b": "a", "h": "a", "c": "c", "d": "d", "e": "e", "f": "f", "g": "g"}
    assert neardup.duplicate_pairs(df.limit(0)).count() == 0


def test_an_id_in_two_groups_joins_them(spark):
    one, two = "a b c d e f g h", "q r s t u v w x"
    df = spark.createDataFrame([("x", messages(one)), ("y", messages(one)), ("y", messages(two)), ("z", messages(two))], "id string, messages_json string")
    assert found(neardup.duplicate_pairs(df)) == {("x", "y"), ("x", "z"), ("y", "z")}


def test_run_hashes():
    texts = ["A b-c  D", "a B c d!", "a b", "", "é" * 50 + " a b c", "x " * 5000, "İ a b K c"]
    got = run_sets(texts, 3)
    assert [len(g) for g in got] == [len(runs(t)) for t in texts]
    assert set(got[0]) == set(got[1])
    sets = run_sets([" ".join(f"{k}" for k in range(1000))], 2)
    assert len(sets[0]) == 999


def test_trie_equals_pairs():
    rng = random.Random(1)
    rows = [{"class": f"c{k}", "side": k % 2, "mine": k % 3, "runs": sorted(rng.sample(range(40), rng.randrange(1, 25)))} for k in range(60)]
    for two_sides, across in ((False, False), (True, False), (False, True)):
        want = set()
        for x, r in enumerate(rows):
            for s in rows[x + 1 :]:
                a, b = set(r["runs"]), set(s["runs"])
                if len(a & b) >= 0.5 * len(a | b) and not (two_sides and r["side"] == s["side"]) and not (across and r["mine"] == s["mine"]):
                    want.add((frozenset((r["class"], s["class"])), len(a & b)))
        assert {(frozenset((a, b)), n) for a, b, n in join_sets(rows, 0.5, two_sides, across)} == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 360)] + [(500, k) for k in range(501, 580)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a int, b int")).select(F.count("node")).first()[0] == 0
