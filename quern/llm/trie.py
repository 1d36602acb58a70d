"""Prefix-tree join of globally ordered sets.

Sets, their runs in one order for all, are stored in a compressed trie, whose
edges hold arrays of runs.  A probing set walks the trie once: what it shares with a path
is counted for all sets below it together, and a subtree is left as soon as the
runs still to come, in the probing set or in the longest set below, cannot
reach the overlap the threshold asks for.
"""

from __future__ import annotations

import numpy as np


class _Edge:
    __slots__ = ("runs", "children", "ends", "longest", "smallest")

    def __init__(self, runs: np.ndarray):
        self.runs = runs
        self.children: dict[int, _Edge] = {}
        self.ends: list[int] = []
        self.longest = 0  # runs of the longest set below, this edge included
        self.smallest = 1 << 62  # least size of a set below


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    return int(differs[0]) if len(differs) else n


class Trie:
    def __init__(self) -> None:
        self.root = _Edge(np.empty(0, dtype=np.int64))

    def add(self, ranks: np.ndarray, size: int, label: int) -> None:
        edge, rest = self.root, ranks
        while True:
            edge.longest, edge.smallest = max(edge.longest, len(rest) + len(edge.runs)), min(edge.smallest, size)
            if not len(rest):
                edge.ends.append(label)
                return
            child = edge.children.get(int(rest[0]))
            if child is None:
                leaf = edge.children[int(rest[0])] = _Edge(rest)
                leaf.longest, leaf.smallest = len(rest), size
                leaf.ends.append(label)
                return
            k = _common(child.runs, rest)
            if k < len(child.runs):
                upper = _Edge(child.runs[:k])
                upper.longest, upper.smallest = child.longest, child.smallest
                child.runs, child.longest = child.runs[k:], child.longest - k
                upper.children[int(child.runs[0])] = child
                edge.children[int(rest[0])] = child = upper
            edge, rest = child, rest[k:]

    def probe(self, holds: np.ndarray, after: np.ndarray, size: int, threshold: float) -> list[tuple[int, int]]:
        """(label, shared) of the stored sets that may reach the threshold with
        a set of ``size`` runs.  holds: by rank, whether the set has it; after:
        by rank, how many of the set's ranks are greater or equal."""
        found = []
        stack = [(self.root, 0)]
        share = threshold / (1 + threshold)
        while stack:
            edge, shared = stack.pop()
            below = edge.longest - len(edge.runs)
            least = max(threshold * size, share * (size + edge.smallest)) - 1e-9
            if len(edge.runs):
                if shared + min(edge.longest, int(after[edge.runs[0]])) < least:
                    continue
                shared += int(np.count_nonzero(holds[edge.runs]))
                if shared + min(below, int(after[edge.runs[-1] + 1])) < least:
                    continue
            found += [(label, shared) for label in edge.ends]
            stack += [(child, shared) for child in edge.children.values()]
        return found


def join_sets(rows: list[dict], threshold: float, two_sides: bool, across: bool) -> list[tuple[str, str, int]]:
    """Linked pairs of ``rows`` (class, side, runs, mine).  With ``two_sides``
    only pairs of different sides; with ``across`` only pairs whose ``mine``
    differ.  Runs held by more of the sets come first, so that sets share paths;
    any order common to all gives the same pairs."""
    rows = sorted(rows, key=lambda r: (len(r["runs"]), r["class"]))
    runs = [np.asarray(r["runs"], dtype=np.int64) for r in rows]
    known, back, count = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
    rank = np.empty(len(known), dtype=np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(known))
    ranks = np.split(rank[back], np.cumsum([len(r) for r in runs])[:-1])
    # A set probes the tries it may match: of the other side, the other block, or all before it.
    tries: dict[tuple, Trie] = {}
    out = []
    holds, steps = np.zeros(len(known), dtype=bool), np.zeros(len(known) + 1, dtype=np.int64)
    for i, row in enumerate(rows):
        mine = np.sort(ranks[i])
        label = (row["side"] if two_sides else 0, row["mine"] if across else 0)
        partners = [t for at, t in tries.items() if not (two_sides and at[0] == label[0]) and not (across and at[1] == label[1])]
        if partners:
            holds[mine] = True
            steps[:-1] = holds
            after = np.cumsum(steps[::-1])[::-1]
            for trie in partners:
                for j, shared in trie.probe(holds, after, len(mine), threshold):
                    if shared >= threshold * (len(mine) + len(runs[j]) - shared) - 1e-9:
                        a, b = sorted((row, rows[j]), key=lambda r: (r["side"], r["class"]))
                        out.append((a["class"], b["class"], shared))
            holds[mine] = False
        tries.setdefault(label, Trie()).add(mine, len(mine), i)
    return out
