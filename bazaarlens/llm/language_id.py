"""Language ID by error-correcting output codes over byte n-grams.

Each language has a codeword of +1 and -1. One binary classifier per place of the code learns which
languages have +1 there. A text gets the language whose codeword loses least, the loss being the sum
of the logistic losses of all places; a text whose two best codewords are close is flagged.
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

from bazaarlens.llm.features import gram_counts
from bazaarlens.llm.rows import bounded, free_name, text_bytes

SIZES, BITS = (1, 2, 3), 12
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x places, +1 or -1
    weights: np.ndarray  # grams x places
    bias: np.ndarray


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A code for ``n`` languages: all splits into two sets for up to 6, else the best of random ones by least distance."""
    if n <= 6:
        places = [[1] + [1 if m >> k & 1 else -1 for k in range(n - 1)] for m in range(2 ** (n - 1) - 1)]
        return np.array(places or [[1] * n], np.float32).T
    draw = np.random.default_rng(seed)
    places = 6 * int(np.ceil(np.log2(n)))
    tries = [draw.choice(np.array([-1, 1], np.float32), (n, places)) for _ in range(200)]
    return max(tries, key=lambda c: (c @ c.T + -2 * places * np.eye(n)).max() * -1)


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.stack([gram_counts(data[a:b], BITS, SIZES) for a, b in zip(offsets[:-1], offsets[1:])]) * 10


def fit_languages(docs: DataFrame, lang_column: str = "lang", per_language: int = 300, most_documents: int = 12_000,
                  rounds: int = 150) -> LanguageModel:
    """Fit on up to ``per_language`` documents (doc_id, text, lang) of every language, the smallest by a hash of the id.

    NULL languages, NULL texts and ids teach nothing; of rows with one id and language one text counts. The sample is the only
    part of the corpus that the driver sees, ``most_documents`` in all: with many languages each has fewer. A corpus
    with more languages than that is refused, as no language is left out in silence.
    """
    usable = docs.filter(F.col(lang_column).isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.filter(F.rlike("text", F.lit(r"\p{L}")))
    named = usable.groupBy(F.col(lang_column).alias("_lang"), F.col("doc_id").alias("_id")).agg(F.xxhash64("doc_id").alias("_h"))
    n_languages = usable.select(lang_column).distinct().count()
    if not n_languages:
        return LanguageModel((), np.empty((0, 0)), np.empty((1 << BITS, 0)), np.empty(0))
    if n_languages > most_documents:
        raise ValueError(f"{n_languages} languages: more than a sample of {most_documents} documents can teach")
    most = min(per_language, most_documents // n_languages)
    rank = F.row_number().over(W.Window.partitionBy("_lang").orderBy("_h", "_id"))
    chosen = named.withColumn("_rank", rank).filter(F.col("_rank") <= most)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            x = _features(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("_lang"), pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary())], ["lang", "x"])

    picked = F.broadcast(chosen.select("_lang", "_id"))  # most_documents ids at most
    texts = usable.select(F.col("doc_id").alias("_id"), F.col(lang_column).alias("_lang"), "text").join(picked, ["_lang", "_id"], "left_semi")
    sample = (texts.groupBy("_lang", "_id").agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text"))
              .select("_lang", "text").mapInArrow(read, "lang string, x binary").collect())
    languages = tuple(sorted({r["lang"] for r in sample}))
    code = codewords(len(languages))
    order = sorted(range(len(sample)), key=lambda i: (sample[i]["lang"], bytes(sample[i]["x"])))
    x = np.stack([np.frombuffer(sample[i]["x"], np.float32) for i in order])
    lang = np.array([languages.index(sample[i]["lang"]) for i in order])
    share = 1 / np.bincount(lang)[lang] / len(languages)  # every language counts the same
    y = code[lang]
    weights, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    mean_square = (x * x).sum(axis=1).max()
    speed, seen_w, seen_b = 4 / mean_square, np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(rounds):  # gradient descent with momentum on the logistic loss
        margin = y * (x @ weights + bias)
        pull = -y / (1 + np.exp(np.clip(margin, -30, 30))) * share[:, None]
        seen_w = 0.9 * seen_w + x.T @ pull + 1e-5 * weights
        seen_b = 0.9 * seen_b + pull.sum(axis=0)
        weights -= (speed * seen_w).astype(np.float32)
        bias -= (speed * seen_b).astype(np.float32)
    return LanguageModel(languages, code, weights, bias)


def decode(model: LanguageModel, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language by loss-weighted decoding, its score (0 to 1) and its lead over the second in loss per place."""
    loss = np.logaddexp(0, -margins[:, None, :] * model.code[None, :, :]).sum(axis=2)
    best = loss.argmin(axis=1)
    score = 1 / np.exp(loss.min(axis=1, keepdims=True) - loss).sum(axis=1)
    second = np.partition(loss, 1, axis=1)[:, 1] if loss.shape[1] > 1 else loss[:, 0] + np.inf
    return best, np.clip(score, 0, 1), (second - loss.min(axis=1)) / model.code.shape[1]


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "ignore")))


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text", least_lead: float = 0.05) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous (named with underscores added where ``docs`` has such a column).

    A NULL text, a text without a letter, or any text where nothing was learned is ``und`` with score 0.
    ``ambiguous``: the lead over the second codeword is under ``least_lead``, or the text is ``und``.
    """
    names = [free_name(docs, n) for n in ("lang_pred", "score", "ambiguous")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text_column):
            data, offsets = text_bytes(batch.column(text_column))
            raw = data.tobytes()
            known = np.array([bool(model.languages) and _has_letter(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], bool)
            lang, score, lead = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i in np.array_split(np.flatnonzero(known), max(1, known.sum() // 256)):
                if len(i):
                    x = np.stack([gram_counts(data[offsets[k]:offsets[k + 1]], BITS, SIZES) for k in i]) * 10
                    best, score[i], lead[i] = decode(model, x @ model.weights + model.bias)
                    lang[i] = np.array(model.languages, object)[best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(~known | (lead < least_lead))], [*batch.schema.names, *names])

    added = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()))]
    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, *added]))


def keep_identified(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told clearly, all columns unchanged. Where nothing was learned no language
    can be told, and all rows with a letter stay."""
    if not model.languages:
        return docs.filter(F.coalesce(F.rlike(text_column, F.lit(r"\p{L}")), F.lit(False)))
    named = identify(docs, model, text_column)
    return named.filter(~F.col(named.columns[-1])).select(*docs.columns)
