"""Sizes of texts in tokens of a public tokenizer.

The vocabulary is a ranks file (base64 token, rank) at a path given as a
parameter; every executor must be able to read it.  Nothing is trained.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.core.shared import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's published splitting pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def encoding(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("quern", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str = VOCABULARY) -> list[int]:
    return encoding(path).encode_ordinary(text.encode("utf-8", "replace").decode())


def _sizer(path: str):
    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            counts = [len(encode(t, path)) if t and t.strip() else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*batch.schema.names[:-1], "tokens"])

    return size


def with_tokens(rows: DataFrame, path: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``rows`` with its text column replaced by ``tokens``; null and blank
    texts have none."""
    others = [c for c in rows.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*others).schema) + ", tokens bigint"
    return spread(rows.select(*others, F.col(text).cast("string"))).mapInArrow(_sizer(path), schema)
