"""Quality by Bradley-Terry ranking: scores learned from preference pairs, cut at a quantile of the scores.

A document of label 1 is preferred to one of label 0. The score of a document is linear in its features
and is fitted by the logistic loss of the score differences of pairs. The threshold is the quantile of
the scores of all labelled training rows that leaves the share of label 0 below it.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from bazaarlens.llm.features import STYLE, gram_counts, style
from bazaarlens.llm.rows import bounded, free_name, text_bytes

SIZES, BITS = (1, 2), 9


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float  # raw score at the quantile
    spread: float  # raw scores per unit of log odds


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = [np.concatenate([style(t), np.sqrt(gram_counts(t, BITS, SIZES, lower=False))])
            for t in (data[a:b] for a, b in zip(offsets[:-1], offsets[1:]))]
    return np.stack(rows) if rows else np.empty((0, STYLE + (1 << BITS)), np.float32)


def _raw(data: np.ndarray, offsets: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores before the threshold; each row's sum is its own, so that a text scores the same in any batch."""
    return (((_features(data, offsets) - mean) / scale) * weights).sum(axis=1, dtype=np.float64)


def fit_ranking(docs: DataFrame, labels: DataFrame, per_label: int = 3000, pairs_each: int = 12, rounds: int = 300,
                seed: int = 11) -> Ranking | None:
    """Fit on a sample of ``docs`` (doc_id, text): up to ``per_label`` ids of each label, the smallest by a hash.

    ``labels`` has _id and _label, one row an id. Of a sampled id that repeats, the text with the smallest MD5
    is learned from. The quantile is taken over the scores of all labelled rows; texts are scored where they lie and
    only ids and scores meet the labels. NULL labels, ids and texts teach nothing; None without rows of both labels.
    """
    usable = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text")
    told = labels.filter(F.col("_label").isin(0, 1))
    named = usable.select("doc_id").join(told, F.col("doc_id") == F.col("_id"))
    ids = named.groupBy(F.col("_label").cast("int").alias("y"), "doc_id").agg(F.count("*").alias("n"))
    ranked = F.row_number().over(W.Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id"))
    counts = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if len(counts) < 2:
        return None
    picked = ids.withColumn("place", ranked).filter(F.col("place") <= per_label).select("y", "doc_id")
    chosen = (usable.join(F.broadcast(picked), "doc_id")  # at most 2 * per_label ids are broadcast
              .groupBy("y", "doc_id").agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            x = _features(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary())], ["y", "x"])

    sample = sorted((r["y"], bytes(r["x"])) for r in chosen.select("y", "text").mapInArrow(read, "y int, x binary").collect())
    x = np.stack([np.frombuffer(v, np.float32) for _, v in sample])
    y = np.array([k for k, _ in sample])
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    draw = np.random.default_rng(seed)
    n = pairs_each * max(len(good), len(bad))
    win, lose = draw.choice(good, n), draw.choice(bad, n)
    w, seen = np.zeros(z.shape[1], np.float32), np.zeros(z.shape[1], np.float32)
    speed = 2.0 / np.percentile((z * z).sum(axis=1), 90)
    for _ in range(rounds):  # gradient descent with momentum on log(1 + exp(-(s_win - s_lose)))
        s = z @ w
        pull = 1 / (1 + np.exp(np.clip(s[win] - s[lose], -30, 30))) / n
        each = np.bincount(lose, pull, len(z)) - np.bincount(win, pull, len(z))
        seen = 0.9 * seen + (z.T @ each.astype(np.float32)) + 1e-3 * w
        w = w - speed * seen
    s = z @ w

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_raw(*text_bytes(batch.column("text")), mean, scale, w))], ["doc_id", "s"])

    scores = usable.mapInArrow(rated, T.StructType([usable.schema["doc_id"], T.StructField("s", T.DoubleType())]))
    at = (counts[0] + 0.5) / (counts[0] + counts[1])  # the first score with all of label 0's number below it
    threshold = (scores.join(told, F.col("doc_id") == F.col("_id")).agg(F.percentile_approx("s", at, 100_000)).first())[0]
    return Ranking(mean, scale, w, threshold, float(max(np.std(s) / 3, 1e-6)))


def score_quality(docs: DataFrame, model: Ranking | None, cut: float = 0.3, text_column: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``cut`` on), named with underscores added where taken.

    The quantile threshold maps to ``cut``. A NULL text counts as empty and is scored like any other;
    without a model every score is ``cut``.
    """
    names = [free_name(docs, n) for n in ("score", "predicted")]
    at_cut = float(np.log(cut / (1 - cut)))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text_column, 1 << 20):
            if model is None:
                score = np.full(batch.num_rows, cut)
            else:
                raw = _raw(*text_bytes(batch.column(text_column)), model.mean, model.scale, model.weights)
                score = 1 / (1 + np.exp(-np.clip((raw - model.threshold) / model.spread + at_cut, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score.astype(np.float64)), pa.array((score >= cut).astype(np.int32))],
                                             [*batch.schema.names, *names])

    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    return docs.mapInArrow(rate, T.StructType([*docs.schema.fields, *added]))
