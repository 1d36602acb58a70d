"""Packing, mixing and the classifier."""

import random

import numpy as np
import pytest

from quern.llm import abuse, gru, mixing, packing
from quern.llm.tokens import VOCABULARY, encode, encoding, with_tokens

pytestmark = pytest.mark.skipif(not __import__("os").path.exists(VOCABULARY), reason="no vocabulary")


def documents(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, source string, text string, tokens int")


def test_tokens(spark):
    assert encoding().decode(encode("Hello  wörld's 123\n")) == "Hello  wörld's 123\n"
    df = with_tokens(documents(spark, [(1, "s", "hello world", 9), (2, "s", None, 9), (3, "s", "  ", 9)]).select("doc_id", "text"))
    assert {r["doc_id"]: r["tokens"] for r in df.collect()} == {1: 2, 2: 0, 3: 0}


def naive(sizes, capacity):
    """Sum-of-squares packing by trying every choice."""
    gaps, out, free, left = [], {}, 0, sum(sizes)
    for item in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        s = sizes[item]

        def score(change):
            counts = {}
            for g in change:
                if 0 < g < capacity:
                    counts[g] = counts.get(g, 0) + 1
            return sum(n * n for n in counts.values())

        options = [(score(gaps[:k] + [g - s] + gaps[k + 1 :]), g, k) for k, g in enumerate(gaps) if g >= s]
        new = score([*gaps, capacity - s])
        if options and (min(options)[0] <= new or free >= left):
            k = min(options)[2]
            gaps[k] -= s
        else:
            k = len(gaps)
            gaps.append(capacity - s)
            free += capacity
        out[item] = k
        free -= s
        left -= s
    return gaps


def test_packing_is_sum_of_squares():
    rng = random.Random(2)
    for _ in range(25):
        sizes = [rng.randrange(1, 31) for _ in range(60)]
        bins = packing.sum_of_squares(np.array(sizes), 30)
        room = 30 - np.bincount(bins, weights=sizes)
        assert room.min() >= 0 and sorted(room.astype(int).tolist()) == sorted(naive(sizes, 30))


def test_packing_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 40)
    rng = random.Random(1)
    data = [(k, "s", "word " * rng.randrange(0, 60), 1) for k in range(150)] + [(900, "s", "long text " * 200, 1), (900, "s", "long text " * 200, 1), (901, "s", None, 1), (None, "s", "x", 1)]
    df = documents(spark, data)
    placed = packing.pack_documents(df, 64).collect()
    size = {k: len(encode(t)) for k, _, t, _ in data if k is not None and t and t.strip()}
    got, full = {}, {}
    for r in placed:
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["tokens"]))
        full[r["container"]] = full.get(r["container"], 0) + r["tokens"]
    assert {k: sum(n for *_, n in v) for k, v in got.items()} == size and max(full.values()) <= 64
    assert all(len(v) == -(-size[k] // 64) and [s for _, s, _ in sorted(v)] == [64 * p for p, *_ in sorted(v)] for k, v in got.items())
    report = packing.fill_report(df, 64).first()
    assert report["containers"] == len(full) and report["tokens"] == sum(size.values()) and report["fill"] > 0.9
    assert packing.fill_report(df.limit(0), 64).first()["containers"] == 0
    with pytest.raises(ValueError, match="capacity"):
        packing.pack_documents(df, 0)


def test_splitting_tree():
    rng = np.random.default_rng(0)
    counts = np.array([17, 0, 301, 5])
    split = mixing.splitting_tree(counts, 7, rng)
    assert (split.sum(axis=0) == counts).all() and set(split.sum(axis=1)) <= {46, 47} and (split >= 0).all()
    draws = np.array([mixing.splitting_tree(np.array([30, 70]), 4, rng)[0, 0] for _ in range(300)])
    assert abs(draws.mean() - 7.5) < 0.5 and draws.std() > 0.5


def test_mixing(spark):
    rng = random.Random(3)
    data = [(k, rng.choice(["A", "a ", "b", "c", "other", None]), "word " * rng.randrange(1, 40), 1) for k in range(1500)] + [(5000, "b", None, 1), (0, "A", "x", 1)]
    df = documents(spark, data[:-1])
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("empty", 0.1, 2)], "source string, target_share double, max_repeats bigint")
    total = 30_000
    drawn, facts = mixing.draw(df, targets, total_tokens=total, shards=4)
    rows = drawn.collect()
    uses = {}
    for r in rows:
        uses[r["doc_id"]] = uses.get(r["doc_id"], 0) + 1
    limit = {"a": 1, "b": 3, "c": 2}
    assert all(uses[r["doc_id"]] <= limit[r["source"]] for r in rows) and len({(r["doc_id"], r["pass"]) for r in rows}) == len(rows)
    tokens = {s: sum(r["tokens"] for r in rows if r["source"] == s) for s in limit}
    for s in limit:
        want = min(facts[s][4], limit[s] * facts[s][3])
        assert want - 45 <= tokens[s] <= want, (s, tokens[s], want)
    assert sorted((r["shard"], r["place"]) for r in rows) == [(s, p + 1) for s in range(4) for p in range(sum(r["shard"] == s for r in rows))]
    assert sorted(rows) == sorted(mixing.drawn_documents(df.repartition(5), targets, total_tokens=total, shards=4).collect())
    report = {r["source"]: r for r in mixing.share_report(df, targets, total_tokens=total, shards=4).collect()}
    assert not report["empty"]["met"] and report["empty"]["drawn_tokens"] == 0 and report["a"]["most_uses"] == 1
    assert sum(r["reached_share"] for r in report.values()) == pytest.approx(1, abs=1e-4)
    assert mixing.drawn_documents(df.limit(0), targets).count() == 0
    assert report["a"]["met"] == (abs(report["a"]["reached_share"] - 0.5) <= 0.005)


def test_mixing_meets_every_share_where_it_can(spark, monkeypatch):
    rng = random.Random(5)
    data = [(k, rng.choice(["a"] * 9 + ["b"] * 3 + ["c"]), "word " * rng.randrange(1, 30), 1) for k in range(4000)]
    df = documents(spark, data)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats bigint")
    for fill in (mixing.FILL_ROWS, 7):
        monkeypatch.setattr(mixing, "FILL_ROWS", fill)
        monkeypatch.setattr(mixing, "MAX_PLAN", 120 if fill == 7 else mixing.MAX_PLAN)
        report = {r["source"]: r for r in mixing.share_report(df, targets).collect()}
        assert all(r["met"] and r["most_uses"] <= r["max_repeats"] for r in report.values()), report
        assert report["c"]["drawn_tokens"] == 3 * report["c"]["available_tokens"]  # the scarcest source sets the total
    beyond = {r["source"]: r for r in mixing.share_report(df, targets, total_tokens=10**7).collect()}
    assert not beyond["a"]["met"] and all(r["drawn_tokens"] == r["max_repeats"] * r["available_tokens"] for r in beyond.values())


def test_shards_grow_with_the_total(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 1000)
    df = documents(spark, [(k, "a", "word " * (1 + k % 9), 1) for k in range(3000)])
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats bigint")
    rows = mixing.drawn_documents(df, targets).collect()
    per = {}
    for r in rows:
        per[r["shard"]] = per.get(r["shard"], 0) + 1
    assert len(rows) == 3000 and len(per) > 8 and max(per.values()) < 2 * min(per.values())


# --- the classifier


def test_words_undo_disguise():
    said = ["you m.o.r.o.n", "you mor​on", "you mоrоn", "YOU MORON!!", "y0u m0r0n", "yooou mooooron", "yöu morön", "y@u m$ron"]
    assert [[gru.plain(w) for w in gru.words(t)] for t in said[:7]] == [["you", "moron"]] * 7
    assert gru.words("") == [] and gru.plain("1234") == "#"


def test_gradients():
    rng = np.random.default_rng(3)
    net = gru.Network({"a": 1, "b": 2}, 3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows, gram = np.array([1, 2, 0]), np.full((3, gru.GRAMS), -1)
    gram[:, :3] = rng.integers(0, gru.CHAR_BUCKETS, (3, 3))
    ids, mask, target = rng.integers(0, 3, (5, 4)), np.ones((5, 4)), np.array([0, 1, 2, 1])
    mask[3:, 1] = 0
    _, g = net.gradients(rows, gram, ids, mask, target)
    for name in ("out", "outb", "att", "attv", "wf", "uf", "cf", "wb", "ub", "cb", "word"):
        where = tuple(rng.integers(0, n) for n in net.p[name].shape) if name != "word" else (1, 2)
        kept, step = net.p[name][where], 1e-5
        net.p[name][where] = kept + step
        high = net.gradients(rows, gram, ids, mask, target)[0]
        net.p[name][where] = kept - step
        low = net.gradients(rows, gram, ids, mask, target)[0]
        net.p[name][where] = kept
        assert g[name][where] == pytest.approx((high - low) / (2 * step), abs=2e-4), name


BAD = {1: ["you are a {} moron", "shut up {} idiot nobody wants you"], 3: ["send me {} nudes sexy", "i want {} sex with you tonight"]}
GOOD = ["the {} server returns an error", "kill the {} process first", "please check the {} parser again", "run the {} tests before you commit"]


def sample(rng, n):
    out = []
    for _ in range(n):
        label = rng.choice([0, 0, 0, 1, 3])
        filler = [rng.choice(GOOD).format(f"n{rng.randrange(999)}") for _ in range(rng.randrange(0, 8))]
        if label:
            filler.insert(rng.randrange(len(filler) + 1), rng.choice(BAD[label]).format(f"n{rng.randrange(999)}"))
        text = ". ".join(filler) or "fine"
        out.append((text, label if rng.random() > 0.05 else 0))
    return out


def test_held_out_accuracy():
    rng = random.Random(6)
    net = gru.fit(*zip(*[(gru.words(t), c) for t, c in sample(rng, 500)]), classes=4, steps=(60, 80, 80))
    held = [(t, c) for t, c in sample(rng, 300)]
    prob, of, _ = gru.Scorer(net).windows([gru.words(t) for t, _ in held])
    score = np.zeros(len(held))
    np.maximum.at(score, of, 1 - prob[:, 0])
    truth = np.array([any(w in t for w in ("moron", "idiot", "nudes", "sex ")) for t, _ in held])
    assert 0.8 <= net.case <= 0.98 and ((score >= net.case) == truth).mean() > 0.95


def test_long_and_unspaced_words_are_read_whole():
    for before in ("q" * 45, "z" * 400, "她在昨天晚上说了很多话" * 6):
        text = gru.words(before + "youmoron")
        assert text != gru.words(before + "youmaron") and "moron" in "".join(text)[-24:] and all(len(gru.grams(gru.plain(w))) <= gru.GRAMS for w in text)
    said = "这是一个很长的句子里面没有空格但是在最后有一个词"
    pieces = gru.words(said)
    assert {said[k : k + 2] for k in range(len(said) - 1)} <= {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}


def test_two_texts_train_a_network():
    for labels in ([1, 0], [1, 1, 0], [1, 0, 0]):
        net = gru.fit([["bad", "word"], ["good"], ["fine", "one"]][: len(labels)], labels, 4, steps=(2, 2, 2))
        assert 0 < net.case < 1


def test_windows_cover_all_words():
    for n in (0, 1, gru.WINDOW, gru.WINDOW + 1, 100, 777):
        starts = gru.window_starts(n)
        assert {i for s in starts for i in range(s, min(n, s + gru.WINDOW))} == set(range(n))


def test_scoring_documents(spark):
    rng = random.Random(4)
    rows = [(k, "S ", t, 0) for k, (t, _) in enumerate(sample(rng, 120))] + [(500, None, None, 0), (501, "s", "", 0), (502, "s", "word " * 60_000 + "you are a moron", 0), (3, "s", "repeated", 0), (None, "s", "x", 0)]
    df = documents(spark, rows)
    net = gru.fit(*zip(*[(gru.words(t), c) for t, c in sample(rng, 300)]), classes=4, steps=(60, 80, 80))
    scored = {r["doc_id"]: r for r in abuse.score_documents(df, net).collect()}
    assert len(scored) == 123 and scored[500]["score"] == scored[501]["score"] == 0 and scored[502]["score"] > net.case and scored[502]["kind"] != "ok"


def test_labels_vote(spark):
    docs = documents(spark, [(1, "s", "a", 0), (2, "s", "b", 0), (3, "s", "c", 0), (4, "s", None, 0)])
    reviews = spark.createDataFrame([(1, "ok"), (1, "ok "), (1, "abusive"), (2, "sexual"), (2, "hateful"), (3, None), (3, "hateful"), (4, "ok"), (None, "ok")], "doc_id bigint, verdict string").withColumn("annotator", __import__("pyspark.sql.functions", fromlist=["x"]).monotonically_increasing_id())
    assert abuse.labelled_sample(docs, reviews) == [("a", 0, True), ("c", 2, False)]
    assert abuse.labelled_sample(docs, reviews, max_chars=0) == []


def test_without_labels_nothing_is_found(spark):
    docs = documents(spark, [(1, "s", "you moron", 0)])
    none = spark.createDataFrame([], "doc_id bigint, verdict string")
    assert abuse.abusive_documents(docs, none).count() == 0
