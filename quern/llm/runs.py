"""Word-run hashing of whole texts, vectorised over many texts at a time.

Words are runs of a-z and 0-9 in the lower-case text; a run is ``width``
consecutive words.  Words are hashed by differences of a prefix sum over
per-byte random values, so that no Python step is done per word.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(97, 123)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}
#: Bytes hashed by one vectorised call; longer texts get a call of their own.
CALL_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(max(n, CALL_BYTES + 4096), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_call(parts: list[bytes], width: int) -> list[np.ndarray]:
    ends = np.cumsum([len(p) + 1 for p in parts])
    raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    inside = _IS_WORD[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return [np.empty(0, dtype=np.uint64) for _ in parts]
    up, down = _powers(len(raw))
    total = np.cumsum(_BYTE[raw] * up, dtype=np.uint64)
    before = np.where(start > 0, total[start - 1], np.uint64(0))
    word = mix((total[stop - 1] - before) * down[start] + (stop - start).astype(np.uint64))
    text_of = np.searchsorted(ends, start, side="right")
    count = len(word) - width + 1
    if count < 1:
        return [np.empty(0, dtype=np.uint64) for _ in parts]
    run = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        run = mix(run + word[k : k + count] + np.uint64(k + 1))
    whole = text_of[:count] == text_of[width - 1 :]
    run, owner = run[whole], text_of[:count][whole]
    cut = np.searchsorted(owner, np.arange(len(parts) + 1))
    return [np.unique(run[cut[i] : cut[i + 1]]) for i in range(len(parts))]


def run_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct run hashes (uint64) of each text."""
    out: list[np.ndarray] = []
    call: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.lower().encode("utf-8", "replace")
        if call and size + len(raw) > CALL_BYTES:
            out += _hash_call(call, width)
            call, size = [], 0
        call.append(raw)
        size += len(raw) + 1
    return out + (_hash_call(call, width) if call else [])
