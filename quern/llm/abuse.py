"""Problem 8: abusive, hateful and sexual language.

Method: a bidirectional gated recurrent network with attention pooling over
word and character inputs, trained in numpy, scores all overlapping windows of
every text (``gru``).  A document's score is its highest window's; from which
score on it is a case is told by labelled texts that a network has not seen.

Training uses at most ``max_labelled`` reviewed documents of each label, those
first by hash, and of these at most ``max_chars`` characters; scoring covers
every document, whole.  Null and blank texts score 0.  A reviewed document's
label is its most frequent verdict; without one it is not used.  Repeated rows
of a doc_id count once, with the highest score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.core.labels import source_name
from quern.core.shared import materialize, spread
from quern.llm.gru import Network, Scorer, fit, words

LABELS = ("ok", "abusive", "hateful", "sexual")
#: Bounds of the training sample for each label: documents, and characters of their texts.
MAX_LABELLED, MAX_CHARS = 4000, 16_000_000


def labelled_sample(documents: DataFrame, reviews: DataFrame, max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS) -> list[tuple[str, int, bool]]:
    """(text, label, whether two reviewers agree on it) of at most
    ``max_labelled`` reviewed documents of each label, in order of their hash as
    long as their texts have ``max_chars`` characters or fewer together."""
    verdict = F.lower(F.trim("verdict"))
    votes = reviews.distinct().where(verdict.isin(*LABELS)).groupBy("doc_id").agg(*(F.count_if(verdict == v).alias(v) for v in LABELS))
    most = F.greatest(*LABELS)
    agreed = votes.withColumn("label", F.coalesce(*(F.when(F.col(v) == most, F.lit(k)) for k, v in enumerate(LABELS)))).where(" + ".join(f"cast({v} = greatest({', '.join(LABELS)}) as int)" for v in LABELS) + " = 1")
    agreed = materialize(agreed.where("doc_id is not null").select("doc_id", "label", (most > 1).alias("agreed")), "labels")
    parts = [agreed.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled) for k in range(len(LABELS))]
    sample = reduce(DataFrame.unionByName, parts)  # at most max_labelled rows a label
    rows = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "label", "agreed").agg(F.min("text").alias("text"))
    before = F.sum(F.length("text")).over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))  # max_labelled rows
    rows = rows.withColumn("chars", before).where(F.col("chars") <= max_chars).collect()
    return [(r["text"], r["label"], r["agreed"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def train(documents: DataFrame, reviews: DataFrame, max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS) -> Network:
    sample = labelled_sample(documents, reviews, max_labelled, max_chars)
    return fit([words(t) for t, _, _ in sample], [c for _, c, _ in sample], len(LABELS), [a for _, _, a in sample])


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                prob, of, _ = scorer.windows([words(t) if t else [] for t in part.column(1).to_pylist()])
                best = np.zeros((part.num_rows, len(LABELS)), dtype=np.float64)
                np.maximum.at(best, of, prob)
                case = np.zeros(part.num_rows)
                np.maximum.at(case, of, 1.0 - prob[:, 0])
                kind = best[:, 1:].argmax(axis=1) + 1
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.round(case, 6)), pa.array([LABELS[k] if s >= shared.value.case else "ok" for k, s in zip(kind, case)])], names=["doc_id", "score", "kind"])

    return score


def score_documents(documents: DataFrame, network: Network) -> DataFrame:
    """doc_id, score, kind of every document (doc_id, text)."""
    shared = documents.sparkSession.sparkContext.broadcast(network)  # bounded by the sample
    rows = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = spread(rows).mapInArrow(_scorer(shared), "doc_id bigint, score double, kind string")
    return scored.groupBy("doc_id").agg(F.max("score").alias("score"), F.max_by("kind", "score").alias("kind"))


def abusive_documents(documents: DataFrame, reviews: DataFrame) -> DataFrame:
    """doc_id of every case."""
    return score_documents(documents, train(documents, reviews)).where("kind <> 'ok'").select("doc_id")


def rate_report(documents: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per source ('' if it has none): documents, cases of each kind, rate."""
    scored = score_documents(documents, train(documents, reviews))
    sources = documents.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(F.coalesce(source_name(F.col("source")), F.lit(""))).alias("source"))
    counts = [F.count(F.lit(1)).alias("documents"), F.count_if(F.col("kind") != "ok").alias("cases"), *(F.count_if(F.col("kind") == k).alias(k) for k in LABELS[1:])]
    return sources.join(scored, "doc_id").groupBy("source").agg(*counts).withColumn("rate", F.round(F.col("cases") / F.col("documents"), 6))
