"""Exact set-similarity join of whole texts for tables too large for pairs.

A record is the set of distinct word runs of its text.  Two records are linked
when their Jaccard similarity reaches ``threshold``.  No step sees more than a
bounded block of records at once, and no link is lost:

1. Blocks.  One scan parses and hashes each text.  A block of records sends
   each run hash to the shard of its hash range, packed as sorted arrays.  A
   hash that repeats within the block is sent once with its count, so a hash
   held by a third of all records costs a shard one entry per block; equal sets
   of a block are sent once.
2. Order.  A shard counts its hashes over the whole collection and replies to
   the blocks with the live ones, held by two records (joining two sides: by a
   record of either side).  Live runs are globally ordered, rarest first.
3. Prefixes.  Linked records share at least threshold * size runs, hence at
   least ``e`` of them within the first live - threshold * size + e.  Records
   with fewer live runs are done.
4. Candidates.  Prefix runs are hashed to ``CLASSES`` classes; a linked pair
   shares at least e / CLASSES prefix runs in one class, counted there for runs
   with up to ``GROUP`` holders.  Holders of a more frequent prefix run are
   tied to one of them instead of to each other, so no group is squared.
5. Prefix-tree join.  Tied records form routes (connected components).  The
   sets of each route's classes are made again from the texts, once each, and
   joined in a trie (see ``trie``).  A route beyond ``ROUTE_RUNS`` runs is cut
   in blocks and every two blocks are joined.

Nulls, blank and cut-off JSON, and texts of fewer than ``width`` words have no
runs and link to nothing, but have the key of the whole record where two sides
are joined.  Repeated rows and rows of equal sets are one class.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.core.shared import materialize
from quern.llm.components import connected_components
from quern.llm.runs import mix, run_sets
from quern.llm.trie import join_sets

#: Records and runs of one block, runs of one shard, prefix runs of one class
#: task, runs of one routed task.
BLOCK_RECORDS, BLOCK_RUNS, SHARD_RUNS, CLASS_RUNS, ROUTE_RUNS = 8192, 1 << 20, 1 << 20, 1 << 22, 1 << 20
#: Characters of JSON that make about one run, to set the number of shards.
CHARS_PER_RUN = 10
#: Classes of prefix runs, most shared runs asked for in one, largest group counted in pairs.
CLASSES, SHARED, GROUP = 8, 5, 32
#: Pairs counted at once in a class task; more are counted in several passes.
PASS_PAIRS = 1 << 23
#: Most classes of candidates joined to the texts by broadcast (about 60 bytes each).
BROADCAST_ROWS = 100_000

#: What isn't a letter or digit of ASCII is a blank; words of other texts.
_APART = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(256))
_LETTERS = re.compile(r"[^\W_]+")

_SINGLE, _MULTI, _RECORDS, _LOCAL, _PREFIX = range(5)
_FIELDS = ["part", "block", "side", "kind", "a", "b", "c"]
_MAIL = "part bigint, block bigint, side int, kind int, a binary, b binary, c binary"


def _hashes(runs: np.ndarray) -> tuple[int, int]:
    """128 bits of a set that don't depend on its order."""
    return int(runs.sum(dtype=np.uint64)), int(mix(runs ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64))


def _class_name(h1: int, h2: int, size: int, side: int, two_sides: bool) -> str:
    return f"{h1:016X}{h2:016X}:{size}" + (f":{side}" if two_sides else "")


def _cuts(where: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of each stretch of equal values."""
    at = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else np.empty(0, dtype=np.int64)
    for i, j in zip(at, np.r_[at[1:], len(where)]):
        yield int(where[i]), int(i), int(j)


def record_key(text: str) -> tuple[int, int]:
    """128 bits of a whole record's text, whatever its case, punctuation and
    white space; zeros if it has no letter or digit."""
    if text.isascii():
        words = text.lower().encode().translate(_APART).split()
    else:
        words = [w.encode("utf-8", "replace") for w in _LETTERS.findall(unicodedata.normalize("NFKC", text).casefold())]
    if not words:
        return 0, 0
    h = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(h[:8], "little"), int.from_bytes(h[8:], "little")


def _pack(block: int, side: int, names: list[str], sets: list[np.ndarray], keys: list[tuple[int, int]], shards: int) -> list[tuple]:
    """The mail of one block."""
    sizes = np.array([len(s) for s in sets], dtype=np.int32)
    h = [_hashes(s) + k for s, k in zip(sets, keys)]
    first_of: dict[tuple, int] = {}
    sent = [k for k, x in enumerate(h) if len(sets[k]) and first_of.setdefault(x[:2], k) == k]
    record = (block % shards, block, side, _RECORDS, json.dumps(names).encode(), sizes.tobytes(), np.array(h, dtype=np.uint64).tobytes())
    if not sent:
        return [record]
    run, owner = np.concatenate([sets[k] for k in sent]), np.repeat(np.array(sent, dtype=np.uint16), sizes[sent])
    order = np.argsort(run, kind="stable")
    run, owner = run[order], owner[order]
    shard = ((run >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    count = np.diff(np.r_[first, len(run)])
    many = np.repeat(count > 1, count)
    low = run.astype(np.uint32)
    mail = [
        record,
        (block % shards, block, side, _LOCAL, ((shard[many] << np.uint64(32)) | low[many]).tobytes(), owner[many].tobytes(), None),
    ]
    for kind, where, token, extra in ((_SINGLE, shard[~many], low[~many], owner[~many]), (_MULTI, shard[first][count > 1], low[first][count > 1], count[count > 1].astype(np.uint32))):
        mail += [(part, block, side, kind, token[i:j].tobytes(), extra[i:j].tobytes(), None) for part, i, j in _cuts(where)]
    return mail


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(x), type=t) for x, t in zip(zip(*rows), kinds)], names=_FIELDS)


def _sender(text_of: Callable[[str | None], str], width: int, shards: int, whole: bool):
    """Mail of all blocks; ``whole``: with the key of each whole record, so that
    records without runs are sent, too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 20, 0
        held: dict[int, list] = {}

        def flush(side: int) -> pa.RecordBatch:
            nonlocal made
            names, sets, keys, _ = held.pop(side)
            made += 1
            return _batch(_pack(base + made, side, names, sets, keys, shards))

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names, sides = part.column(0).to_pylist(), part.column(1).to_pylist()
                texts = [text_of(x) for x in part.column(2).to_pylist()]
                for name, side, text, runs in zip(names, sides, texts, run_sets(texts, width)):
                    key = record_key(text) if whole else (0, 0)
                    if name is None or not (len(runs) or key[0]):
                        continue
                    mine = held.setdefault(side, [[], [], [], 0])
                    mine[0].append(name)
                    mine[1].append(runs)
                    mine[2].append(key)
                    mine[3] += len(runs)
                    if len(mine[0]) >= BLOCK_RECORDS or mine[3] >= BLOCK_RUNS:
                        yield flush(side)
        for side in [*held]:
            yield flush(side)

    return send


def _counter(two_sides: bool):
    def count(shard: pa.Table) -> pa.Table:
        rows = shard.to_pylist()
        out = [tuple(r[k] for k in _FIELDS) for r in rows if r["kind"] in (_RECORDS, _LOCAL)]
        mail = [r for r in rows if r["kind"] in (_SINGLE, _MULTI)]
        if mail:
            part = mail[0]["part"]
            tokens = [np.frombuffer(r["a"], dtype=np.uint32) for r in mail]
            owner = np.concatenate([np.frombuffer(r["b"], dtype=np.uint16) if r["kind"] == _SINGLE else np.zeros(len(t), dtype=np.uint16) for r, t in zip(mail, tokens)])
            weight = np.concatenate([np.ones(len(t), dtype=np.int64) if r["kind"] == _SINGLE else np.frombuffer(r["b"], dtype=np.uint32).astype(np.int64) for r, t in zip(mail, tokens)])
            source = np.repeat(np.arange(len(mail)), [len(t) for t in tokens])
            token = np.concatenate(tokens)
            order = np.argsort(token, kind="stable")
            token, owner, weight, source = token[order], owner[order], weight[order], source[order]
            first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            held_by = np.diff(np.r_[first, len(token)])
            total = np.add.reduceat(weight, first)
            live = total > 1
            if two_sides:
                ones = np.add.reduceat(weight * np.array([r["side"] for r in mail])[source], first)
                live = (ones > 0) & (ones < total)
            live, total = np.repeat(live, held_by), np.repeat(np.minimum(total, 65535).astype(np.uint16), held_by)
            token, owner, source, total = token[live], owner[live], source[live], total[live]
            order = np.argsort(source, kind="stable")
            token, owner, source, total = token[order], owner[order], source[order], total[order]
            for k, i, j in _cuts(source):
                out.append((part, mail[k]["block"], mail[k]["side"], mail[k]["kind"], token[i:j].tobytes(), owner[i:j].tobytes() if mail[k]["kind"] == _SINGLE else None, total[i:j].tobytes()))
        return pa.Table.from_batches([_batch(out)]) if out else pa.Table.from_batches([], schema=shard.schema)

    return count


def _settler(threshold: float, subs: int):
    def settle(block: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        by = {kind: [r for r in rows if r["kind"] == kind] for kind in (_SINGLE, _MULTI, _RECORDS, _LOCAL)}
        record = by[_RECORDS][0]
        sizes = np.frombuffer(record["b"], dtype=np.int32)

        def joined(kind: int, field: str, dtype: type) -> np.ndarray:
            return np.concatenate([np.empty(0, dtype=dtype), *(np.frombuffer(r[field], dtype=dtype) for r in by[kind])])

        def tokens(kind: int) -> np.ndarray:
            part = np.repeat(np.array([r["part"] for r in by[kind]], dtype=np.uint64), [len(r["a"]) // 4 for r in by[kind]])
            return (part << np.uint64(32)) | joined(kind, "a", np.uint32).astype(np.uint64)

        run, owner, total = tokens(_SINGLE), joined(_SINGLE, "b", np.uint16), joined(_SINGLE, "c", np.uint16)
        known, weight = tokens(_MULTI), joined(_MULTI, "c", np.uint16)
        if len(known):
            order = np.argsort(known)
            known, weight = known[order], weight[order]
            local, mine = joined(_LOCAL, "a", np.uint64), joined(_LOCAL, "b", np.uint16)
            at = np.minimum(np.searchsorted(known, local), len(known) - 1)
            hit = known[at] == local
            run, owner, total = np.r_[run, local[hit]], np.r_[owner, mine[hit]], np.r_[total, weight[at[hit]]]
        run = mix(run)
        order = np.lexsort((run, total, owner))
        run, owner = run[order], owner[order]
        first = np.searchsorted(owner, np.arange(len(sizes) + 1))
        least = np.ceil(threshold * sizes - 1e-9).astype(np.int64)
        extra = np.minimum(CLASSES * (SHARED - 1) + 1, np.maximum(least, 1))
        length = np.minimum(np.diff(first) - least + extra, np.diff(first))
        length[np.diff(first) < least] = 0
        keep = (np.arange(len(run)) - first[owner]) < length[owner]
        run, owner = run[keep], owner[keep]
        need = np.ceil(extra / CLASSES).astype(np.uint8)
        part = (run & np.uint64(CLASSES - 1)) * np.uint64(subs) + (run >> np.uint64(3)) % np.uint64(subs)
        order = np.argsort(part, kind="stable")
        run, owner, part = (run[order] >> np.uint64(32)).astype(np.uint32), owner[order], part[order]
        out = [(-1, record["block"], record["side"], _RECORDS, record["a"], record["b"], record["c"])]
        out += [(p, record["block"], record["side"], _PREFIX, run[i:j].tobytes(), owner[i:j].tobytes(), need[owner[i:j]].tobytes()) for p, i, j in _cuts(part)]
        return pa.Table.from_batches([_batch(out)])

    return settle


_TIES = "part bigint, a bigint, b bigint, shared int, need int"


def _tier(two_sides: bool, subs: int):
    """Ties of the records of one class task; need 0 for those to a hub."""

    def tie(task: pa.Table) -> pa.Table:
        rows = task.to_pylist()
        lengths = [len(r["a"]) // 4 for r in rows]
        token = np.concatenate([np.frombuffer(r["a"], dtype=np.uint32) for r in rows])
        uid = np.concatenate([np.frombuffer(r["b"], dtype=np.uint16).astype(np.int64) for r in rows])
        uid |= np.repeat(np.array([r["block"] for r in rows], dtype=np.int64) << 16, lengths)
        asked = np.concatenate([np.frombuffer(r["c"], dtype=np.uint8) for r in rows])
        sides = np.repeat(np.array([r["side"] for r in rows], dtype=np.int8), lengths)
        order = np.argsort(token, kind="stable")
        token, uid, asked, sides = token[order], uid[order], asked[order], sides[order]
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        count = np.diff(np.r_[first, len(token)])
        if two_sides:
            ones = np.add.reduceat(sides.astype(np.int64), first)
            useful = (ones > 0) & (ones < count)
        else:
            useful = count > 1
        first, count = first[useful], count[useful]
        names, local = np.unique(uid, return_inverse=True)
        need, side_of = np.zeros(len(names), dtype=np.int32), np.zeros(len(names), dtype=np.int8)
        need[local], side_of[local] = asked, sides
        ties = [[np.empty(0, dtype=np.int64)] for _ in range(4)]

        def add(a: np.ndarray, b: np.ndarray, shared: np.ndarray, asked: np.ndarray) -> None:
            for column, values in zip(ties, (names[a], names[b], shared, asked)):
                column.append(values)

        large = count > GROUP
        if large.any():
            members = np.concatenate([np.arange(i, i + n) for i, n in zip(first[large], count[large])])
            hub = np.repeat(np.minimum.reduceat(local[members], np.r_[0, np.cumsum(count[large])[:-1]]), count[large])
            pairs = np.unique(np.stack([local[members], hub]), axis=1)
            pairs = pairs[:, pairs[0] != pairs[1]]
            add(pairs[0], pairs[1], np.full(pairs.shape[1], SHARED), np.zeros(pairs.shape[1], dtype=np.int64))
        first, count = first[~large], count[~large]
        passes = max(1, math.ceil(int((count * (count - 1) // 2).sum()) / PASS_PAIRS))
        for turn in range(passes):
            keys = []
            for n in np.unique(count):
                group = local[first[count == n][:, None] + np.arange(n)]
                for i in range(n - 1):
                    a, b = np.repeat(group[:, i], n - 1 - i), group[:, i + 1 :].ravel()
                    low, high = np.minimum(a, b), np.maximum(a, b)
                    ok = low != high
                    if two_sides:
                        ok &= side_of[low] != side_of[high]
                    if passes > 1:
                        ok &= (low + high) % passes == turn
                    keys.append((low[ok].astype(np.int64) << 32) | high[ok])
            pair, shared = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
            a, b = pair >> 32, pair & 0xFFFFFFFF
            asked_of = np.minimum(need[a], need[b])
            ok = (shared >= asked_of) if subs == 1 else shared > 0
            add(a[ok], b[ok], shared[ok], asked_of[ok])
        a, b, shared, asked_of = (np.concatenate(c) for c in ties)
        part = np.full(len(a), rows[0]["part"] // subs)
        return pa.table([pa.array(part, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(shared, pa.int32()), pa.array(asked_of, pa.int32())], names=["part", "a", "b", "shared", "need"])

    return tie


_PROFILE = "uid bigint, node string, side int, size int, class string, same string"


def _profiler(two_sides: bool):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                names, sizes = json.loads(r["a"]), np.frombuffer(r["b"], dtype=np.int32)
                h = np.frombuffer(r["c"], dtype=np.uint64).reshape(-1, 4).tolist()
                classes = [_class_name(x, y, n, r["side"], two_sides) for (x, y, _, _), n in zip(h, sizes.tolist())]
                same = [f"{x:016X}{y:016X}" if x else None for _, _, x, y in h]
                yield pa.RecordBatch.from_arrays([pa.array((r["block"] << 16) + np.arange(len(names))), pa.array(names, pa.string()), pa.array([r["side"]] * len(names), pa.int32()), pa.array(sizes), pa.array(classes), pa.array(same, pa.string())], names=["uid", "node", "side", "size", "class", "same"])

    return profile


def _setter(text_of: Callable[[str | None], str], width: int, two_sides: bool):
    """Adds the runs of each row whose text has the set its class names."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sides, classes = part.column("side").to_pylist(), part.column("class").to_pylist()
                sets = run_sets([text_of(x) for x in part.column("text").to_pylist()], width)
                keep = [k for k, s in enumerate(sets) if _class_name(*_hashes(s), len(s), sides[k], two_sides) == classes[k]]
                if keep:
                    part = part.take(pa.array(keep))
                    columns = [part.column(c) for c in ("route", "cuts", "class", "side")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([sets[k].view(np.int64) for k in keep], pa.list_(pa.int64()))], names=["route", "cuts", "class", "side", "runs"])

    return make


def _joiner(threshold: float, two_sides: bool):
    def join(task: pa.Table) -> pa.Table:
        out: list[tuple[str, str, int]] = []
        routes: dict[tuple, dict[str, dict]] = {}
        for r in task.to_pylist():
            routes.setdefault((r["route"], r["left"], r["right"]), {})[r["class"]] = r
        for (_, left, right), rows in routes.items():
            out += join_sets([*rows.values()], threshold, two_sides, left != right)
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.string(), pa.string(), pa.int32()))], names=["a", "b", "shared"])

    return join


def _total(df: DataFrame, what: Column) -> int:
    return df.agg(F.sum(what).alias("n")).first()[0] or 0


def similarity_join(records: DataFrame, text_of: Callable[[str | None], str], width: int, threshold: float, two_sides: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, links) of ``records`` (node string, side int, text string),
    which must be read from files (or written first), so that a block made
    again after a loss is the same block.

    members: node, side, class, same - every node with runs, under the key of its
    set; with ``two_sides`` also nodes without runs, and ``same`` is the key of
    the whole record (see ``record_key``), null for one without letters.
    links: a, b, shared - linked classes of different sets, each once; with
    ``two_sides`` a is of side 0 and b of side 1, the classes of the two sides
    are kept apart and equal sets on both sides are linked too.
    """
    runs = _total(records, F.length("text").cast("bigint")) / CHARS_PER_RUN
    shards, subs = max(8, int(runs / SHARD_RUNS) + 1), max(1, math.ceil(0.4 * runs / CLASSES / CLASS_RUNS))
    mail = records.select("node", "side", "text").mapInArrow(_sender(text_of, width, shards, two_sides), _MAIL)
    replies = mail.groupBy("part").applyInArrow(_counter(two_sides), _MAIL)
    settled = materialize(replies.groupBy("block").applyInArrow(_settler(threshold, subs), _MAIL), "prefixes")
    profiles = settled.where(F.col("kind") == _RECORDS).mapInArrow(_profiler(two_sides), _PROFILE)
    members = profiles.select("node", "side", "class", "same").distinct()

    ties = settled.where(F.col("kind") == _PREFIX).groupBy("part").applyInArrow(_tier(two_sides, subs), _TIES)
    if subs > 1:
        ties = ties.groupBy("part", "a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).where("shared >= need")
    routes = connected_components(ties.select("a", "b")).withColumnsRenamed({"node": "uid", "component": "route"})
    classes = profiles.join(routes, "uid").groupBy("class").agg(*(F.min(c).alias(c) for c in ("node", "side", "size", "route")))
    load = classes.groupBy("route").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    classes = materialize(classes.join(load.select("route", "load", F.ceil(F.col("load") / ROUTE_RUNS).cast("int").alias("cuts")), "route"), "classes")

    few = classes.count() <= BROADCAST_ROWS
    wanted = classes.select("node", "side", "class", "route", "cuts")
    sets = records.join(F.broadcast(wanted) if few else wanted, ["node", "side"]).mapInArrow(_setter(text_of, width, two_sides), "route bigint, cuts int, class string, side int, runs array<bigint>")
    tasks = max(1, int(_total(classes.where("cuts = 1"), F.col("size")) / ROUTE_RUNS))
    sets = sets.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("cuts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    sets = sets.withColumns({"left": F.least("mine", "other"), "right": F.greatest("mine", "other")}).drop("other")
    sets = sets.withColumn("task", F.when(F.col("cuts") == 1, F.pmod(F.xxhash64("route"), F.lit(tasks))).otherwise(F.xxhash64("route", "left", "right")))
    links = sets.groupBy("task").applyInArrow(_joiner(threshold, two_sides), "a string, b string, shared int")
    return members, materialize(links, "links")
