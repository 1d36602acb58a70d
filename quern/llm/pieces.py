"""Problem 5: cutting oversized sessions at natural boundaries.

Method: dynamic programming over boundary positions.  A session's text is its
messages' texts, one after another; boundaries are message ends, paragraph
ends, line ends and sentence ends, at rising penalties, and words or any
characters only where no natural boundary leaves a piece short enough.  The
least sum of penalties and of squared deviations from equal sizes is chosen,
no piece being longer than the limit.  Each piece but the first begins with the
last ``overlap`` characters of the one before.

Sizes are Unicode characters.  Sessions within the limit, and null, blank and
cut-off JSON, give no pieces.  Every part of a piece carries its message's
value of message_loss_mask, null where the mask is shorter.  Repeated rows
count once; rows of one id with different messages or masks are told apart by
``variant``.  An overlap of the limit or more is an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.jsonio import content_text, load_list
from quern.core.shared import spread

LIMIT, OVERLAP = 8000, 400
#: Penalty of a cut after each kind of boundary; a piece twice or zero times the
#: ideal length costs IMBALANCE.
PENALTY = {"message": 0.0, "paragraph": 1.0, "line": 2.0, "sentence": 3.0, "word": 8.0, "character": 20.0}
IMBALANCE = 4.0
_NATURAL = (("paragraph", re.compile(r"\n[ \t\r]*\n\s*")), ("line", re.compile(r"\r\n|[\n\r\x0b\x0c\u0085  ]")), ("sentence", re.compile(r"[.!?…。！？]+[\"')\]»”]*(?:\s+|(?<=[。！？]))")))
_WORD = re.compile(r"\s+")


def boundaries(texts: list[str], room: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (0 and the end included) and penalties of possible cuts, no two
    neighbours more than ``room`` apart."""
    best: dict[int, float] = {}
    start = 0
    for text in texts:
        for kind, pattern in _NATURAL:
            for m in pattern.finditer(text):
                if 0 < m.end() < len(text):
                    best.setdefault(start + m.end(), PENALTY[kind])
        start += len(text)
        best[start] = PENALTY["message"]
    best[0] = 0.0
    whole = "".join(texts)
    for step in ("word", "character"):
        at = sorted(best)
        for a, b in zip(at, at[1:]):
            if b - a <= room:
                continue
            if step == "word":
                for m in _WORD.finditer(whole, a, b):
                    best.setdefault(m.end(), PENALTY[step])
            else:
                for k in range(a + room // 2 or a + 1, b, max(1, room // 2)):
                    best.setdefault(k, PENALTY[step])
    at = np.array(sorted(best), dtype=np.int64)
    return at, np.array([best[int(p)] for p in at])


def best_cuts(at: np.ndarray, penalty: np.ndarray, limit: int, overlap: int) -> list[int]:
    """Ends of the pieces, by dynamic programming.  at[0] is 0."""
    total = int(at[-1])
    room = limit - overlap
    pieces = max(1, -(-(total - overlap) // room))
    ideal = total / pieces
    cost, came = np.full(len(at), np.inf), np.zeros(len(at), dtype=np.int64)
    cost[0] = 0.0
    # A piece from cut i takes overlap more characters, except the first.
    since = np.searchsorted(at, at - room)
    for j in range(1, len(at)):
        i = int(since[j])
        took = cost[i:j] + IMBALANCE * ((at[j] - at[i:j]) / ideal - 1.0) ** 2
        k = int(np.argmin(took))
        cost[j], came[j] = took[k] + penalty[j], i + k
        if at[j] <= limit:
            first = IMBALANCE * (at[j] / ideal - 1.0) ** 2 + penalty[j]
            if first <= cost[j]:
                cost[j], came[j] = first, 0
    cuts, j = [], len(at) - 1
    while j > 0:
        cuts.append(int(at[j]))
        j = int(came[j])
    return cuts[::-1]


def cut_texts(texts: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int, int]]:
    """(piece, message, from, to, repeated) of each part of each piece: a range
    of one message's text, of which ``repeated`` characters are overlap.
    Messages without text are parts of the piece that ends where they stand."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    lengths = [len(t) for t in texts]
    starts = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    if not starts[-1]:
        return []
    cuts = best_cuts(*boundaries(texts, limit - overlap), limit, overlap)
    out, begin = [], 0
    for piece, end in enumerate(cuts):
        low = max(0, begin - overlap) if piece else 0
        first = max(0, int(np.searchsorted(starts, low, side="right")) - 1)
        for k in range(first, len(texts)):
            a, b = max(low, int(starts[k])), min(end, int(starts[k + 1]))
            if starts[k] > end or (starts[k] == end and lengths[k]):
                break
            if a < b or (not lengths[k] and (begin < starts[k] <= end or (piece == 0 and starts[k] == 0))):
                out.append((piece, k, a - int(starts[k]), max(a, b) - int(starts[k]), max(0, min(begin, b) - a)))
        begin = end
    return out


_PIECES = "id string, variant string, total_chars bigint, piece int, part int, message_index bigint, message_chars bigint, start bigint, end bigint, repeated bigint, role string, loss_mask bigint, text string"
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]


def _cutter(limit: int, overlap: int, with_text: bool):
    names = [x.split()[0] for x in _PIECES.split(", ")]

    def rows(own: str, raw: str | None, mask: list | None) -> Iterator[tuple]:
        if raw is None or len(raw) <= limit:  # JSON is never shorter than its texts
            return
        messages = load_list(raw)
        texts = [content_text(m.get("content")) if isinstance(m, dict) else "" for m in messages]
        total = sum(map(len, texts))
        if total <= limit:
            return
        variant = hashlib.sha256(repr((texts, mask)).encode("utf-8", "replace")).hexdigest()[:16]
        mask = mask or []
        last, part = -1, 0
        for piece, k, a, b, repeated in cut_texts(texts, limit, overlap):
            part = part + 1 if piece == last else 0
            last = piece
            role = messages[k].get("role") if isinstance(messages[k], dict) else None
            text = texts[k][a:b].encode("utf-8", "replace").decode() if with_text else None
            yield own, variant, total, piece, part, k, len(texts[k]), a, b, repeated, role if isinstance(role, str) else None, mask[k] if k < len(mask) else None, text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [r for own, raw, mask in zip(*(part.column(k).to_pylist() for k in range(3))) if own is not None for r in rows(own, raw, mask)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _TYPES)], names=names)

    return cut


def _parts(rows: DataFrame, limit: int, overlap: int, with_text: bool) -> DataFrame:
    mask = F.col("message_loss_mask").cast("array<bigint>")
    return spread(rows.select(F.col("id").cast("string"), "messages_json", mask.alias("message_loss_mask"))).mapInArrow(_cutter(limit, overlap, with_text), _PIECES)


def cut_sessions(rows: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Parts of pieces of every session over ``limit`` characters.  rows: id,
    messages_json, message_loss_mask.  start, end: the range in the message;
    repeated: how many of its characters the piece before has too."""
    return _parts(rows, limit, overlap, with_text).dropDuplicates(["id", "variant", "piece", "part"])


def oversized(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """id, message_index: -1 for each session that is cut, and each message that
    is over the limit alone."""
    parts = _parts(rows, limit, OVERLAP if limit > OVERLAP else 0, False)
    found = F.array(F.lit(-1).cast("bigint"), F.when(F.col("message_chars") > limit, F.col("message_index")))
    return parts.select("id", F.explode(found).alias("message_index")).where("message_index is not null").distinct()
