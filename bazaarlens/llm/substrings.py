"""Substring dedup: repeated runs of words, found by difference-cover anchors.

Places of a document are taken modulo PERIOD; COVER holds a pair of residues for every distance, so two
equal runs of ``window`` words have a common place, at the same depth in both, that is in the cover of
both documents. Only there is a hash of ``window - PERIOD + 1`` words, the anchor, sent over the network.
Anchors that two documents share extend to all windows around them, and those are compared by hashes of
96 bits over all their words. Nothing is paired: each step takes least and greatest ids by key.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens import session
from bazaarlens.llm.rows import bounded, free_name, text_bytes

#: A perfect difference set: every distance modulo 31 is a difference of two of these.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
WINDOW = 50

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Two independent pairs of odd multipliers: for bytes in a word, for words in a window.
_BASES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
_BLOCK = 1 << 21
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2 ** 64 for i up to n."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.cumprod(out)
    return _POWERS[base][:n]


def _sums(values: np.ndarray, first: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Hash of each run [first, stop) of the values: its polynomial in ``base`` modulo 2 ** 64, mixed."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)), dtype=np.uint64)])
    h = (total[stop] - total[first]) * _powers(pow(base, -1, 1 << 64), len(values) + 1)[first]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray, offsets: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the offsets of each text's words among them."""
    inside = ~_WHITE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    starts[at] = inside[at]
    first = np.flatnonzero(starts)
    bounds = np.searchsorted(first, offsets)
    out = np.empty(len(first), np.uint64)
    for a in range(0, len(first), _BLOCK // 8):  # a long text in blocks of words
        part = first[a:a + _BLOCK // 8]
        low = part[0]
        high = first[a + len(part)] if a + len(part) < len(first) else len(data)
        body = np.where(inside[low:high], data[low:high].astype(np.uint64) + np.uint64(1), np.uint64(0))
        out[a:a + len(part)] = _sums(body, part - low, np.append(part[1:], high) - low, _BASES[which][0])
    return out, bounds


def window_hashes(words: np.ndarray, starts: np.ndarray, size: int, which: int) -> np.ndarray:
    """Hash of the ``size`` words from each of the sorted ``starts``."""
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(words), _BLOCK):
        i, j = np.searchsorted(starts, (a, a + _BLOCK))
        if i < j:
            part = starts[i:j] - a
            out[i:j] = _sums(words[a:a + _BLOCK + size], part, part + size, _BASES[which][1])
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """k and tag: a row's id (0 if NULL) and its text's crc32, which tells rows of one id apart; never NULL."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k"),
                       F.coalesce(F.crc32(text.cast("binary")) * 2 + F.col("doc_id").isNull().cast("long"), F.lit(0)).alias("tag"), text.alias("text"))


def _anchors(keyed: DataFrame, window: int) -> DataFrame:
    """h, k and place (tag and word number): an anchor at every place of the cover, but for NULL ids."""
    size = window - PERIOD + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            words, bounds = word_hashes(*text_bytes(batch.column("text")), 0)
            count = np.diff(bounds)
            number = np.arange(len(words)) - np.repeat(bounds[:-1], count)
            at = np.flatnonzero(_IN_COVER[number % PERIOD] & (number + size <= np.repeat(count, count)) & np.repeat(count >= window, count))
            row = np.repeat(np.arange(batch.num_rows), count)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(window_hashes(words, at, size, 0).view(np.int64)), batch.column("k").take(pa.array(row)),
                 pa.array(number[at].astype(np.int32)), batch.column("tag").take(pa.array(row))], ["h", "k", "n", "tag"])

    return keyed.filter(F.col("tag") % 2 == 0).select("k", "tag", "text").mapInArrow(find, "h long, k long, n int, tag long")


def _marks(keyed: DataFrame, window: int) -> DataFrame:
    """k, tag, marks: the places of a document whose anchor an earlier or a later document has as well. Repeated rows
    have the same places, which combine before the shuffle."""
    shared = _anchors(keyed, window).groupBy("h").agg(F.min("k").alias("least"), F.max("k").alias("greatest")).filter("least < greatest")
    return (_anchors(keyed, window).join(shared, "h")
            .groupBy("k", "tag").agg(F.collect_set(F.struct("n", (F.col("k") > F.col("least")).alias("later"),
                                                            (F.col("k") < F.col("greatest")).alias("earlier"))).alias("marks")))


def _windows(marked: DataFrame, window: int, kind: str) -> DataFrame:
    """w, x (96 bits of hash), k, n, tag of every window around a mark of the kind."""
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            words, bounds = word_hashes(data, offsets, 0)
            more, _ = word_hashes(data, offsets, 1)
            marks = batch.column("marks")
            flat, per = marks.flatten(), np.diff(np.asarray(marks.offsets))
            chosen = np.flatnonzero(np.asarray(flat.field(kind).to_numpy(zero_copy_only=False), bool))
            doc = np.repeat(np.arange(batch.num_rows), per)[chosen]
            place = bounds[doc] + flat.field("n").to_numpy()[chosen]
            change = np.zeros(len(words) + 1, np.int64)  # windows that begin from PERIOD - 1 words before a mark up to it
            np.add.at(change, np.maximum(place - (PERIOD - 1), bounds[doc]), 1)
            np.add.at(change, place + 1, -1)
            count = np.diff(bounds)
            row = np.repeat(np.arange(batch.num_rows), count)
            number = np.arange(len(words)) - bounds[row]
            at = np.flatnonzero((np.cumsum(change[:-1]) > 0) & (number + window <= count[row]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(window_hashes(words, at, window, 0).view(np.int64)),
                 pa.array((window_hashes(more, at, window, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                 batch.column("k").take(pa.array(row[at])), pa.array(number[at].astype(np.int32)), batch.column("tag").take(pa.array(row[at]))],
                ["w", "x", "k", "n", "tag"])

    return marked.mapInArrow(extend, "w long, x int, k long, n int, tag long")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """k, tag, starts: the word numbers at which a window begins that also begins in a document of a smaller id.

    For ``docs`` (doc_id, text); k and tag are those of ``_keyed``. Documents without such a window are
    absent, as are NULL ids. Rows of one id don't make each other's windows repeat.
    """
    keyed = _keyed(docs)
    marks = session.cut(_marks(keyed, window))
    marked = keyed.join(marks, ["k", "tag"]).select("k", "tag", "text", "marks")
    least = _windows(marked, window, "earlier").groupBy("w", "x").agg(F.min("k").alias("least"))
    hits = _windows(marked, window, "later").join(least, ["w", "x"]).filter("least < k")
    return hits.groupBy("k", "tag").agg(F.collect_set("n").alias("starts"))


def _kept(text: bytes, starts: np.ndarray, window: int) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the kept words joined by one space."""
    words = text.split()
    if not len(starts):
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    keep = np.cumsum(change[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join(compress(words, keep.tolist()))


def _of_batch(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, bytes]]:
    data, offsets = text_bytes(batch.column("text"))
    raw = data.tobytes()
    for a, b, starts in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column("starts")):
        yield _kept(raw[a:b], np.asarray(starts.values if starts.is_valid else (), np.int64), window)


def repeat_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs`` (doc_id, text).

    A word is removed if a window that covers it is repeated (see ``repeated_windows``), judged on the
    input. A NULL text has no words; a NULL id loses nothing and is no one's source. Repeated rows get
    equal results.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            n, removed, kept = zip(*_of_batch(batch, window))
            nulls = np.asarray(batch.column("tag").to_numpy()) % 2 == 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("k").to_numpy(), pa.int64(), mask=nulls), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in kept])], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    keyed = _keyed(docs.select("doc_id", "text"))
    found = keyed.join(repeated_windows(docs, window), ["k", "tag"], "left").select("k", "tag", "text", "starts")
    return found.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without repeated words: same columns, text being the kept words joined by one space.

    A text that loses nothing stays as it is, and so do NULL texts and NULL ids. A document of which no
    word is left is dropped.
    """
    k, tag, starts = (free_name(docs, c) for c in ("_k", "_tag", "_starts"))
    hits = repeated_windows(docs.select("doc_id", "text"), window).select(F.col("k").alias(k), F.col("tag").alias(tag), F.col("starts").alias(starts))
    text = F.coalesce(F.col("text"), F.lit(""))
    wide = docs.withColumns({f"{k}w": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
                             f"{tag}w": F.coalesce(F.crc32(text.cast("binary")) * 2 + F.col("doc_id").isNull().cast("long"), F.lit(0))})
    joined = wide.join(hits, (F.col(f"{k}w") == F.col(k)) & (F.col(f"{tag}w") == F.col(tag)), "left").select(*docs.columns, starts)

    names = list(docs.columns)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            plain = pa.RecordBatch.from_arrays([batch.column("text"), batch.column(starts)], ["text", "starts"])
            out, left = [], []
            for old, (n, removed, kept) in zip(batch.column("text"), _of_batch(plain, window)):
                out.append(kept.decode("utf-8") if removed else old.as_py())
                left.append(not removed or removed < n)
            columns = [pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(left))

    return joined.mapInArrow(rewrite, T.StructType(docs.schema.fields))
