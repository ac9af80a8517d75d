"""Divergence of sources: how the term counts of each source of a language depart from the others'.

Terms are counted in tasks on packed bytes. A term of up to eight bytes is one 64-bit word, one of up to sixteen
two; these are radix-sorted and their runs counted. Longer terms are sorted as bytes in buckets by length. Spark adds the
counts of tasks up; shares and divergences are whole numbers throughout.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from bazaarlens import session
from bazaarlens.llm.rows import bounded, text_bytes
from bazaarlens.operators.skew import first_per_group

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([2**64 - 2 ** (64 - 8 * k) for k in range(9)], np.uint64)  # the first k bytes of a word
#: Counts held in a task before they are merged and handed on, bytes of text counted at once, cells of one table of shares.
HELD, SLICE, CELLS = 1 << 20, 4 << 20, 1 << 17


def radix_order(*words: np.ndarray) -> np.ndarray:
    """The stable order by unsigned words, the first one most significant: 16 bits at a time from the low end."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 8 * word.itemsize, 16):
            digit = ((word >> word.dtype.type(shift)) & word.dtype.type(0xFFFF)).astype(np.uint16)[order]
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit, kind="stable")]
    return order


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted run begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _runs(columns: tuple[np.ndarray, ...], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows sorted by ``columns``, group and doc: first rows of the runs of equal columns and group, their sizes, their documents."""
    new = _changes(*columns, group)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(new)))
    docs = np.add.reduceat((new | _changes(doc)).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return first, size.astype(np.int64), docs


def _text_array(rows: np.ndarray) -> pa.Array:
    """Strings from rows of bytes padded with zeros."""
    sizes = (rows != 0).sum(axis=1)
    return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(rows[rows != 0])))


def _as_bytes(*words: np.ndarray) -> np.ndarray:
    return np.concatenate([w.astype(">u8").view(np.uint8).reshape(-1, 8) for w in words], axis=1)


class TermCounts:
    """Counts of a task: occurrences and documents of each term in each group, merged and handed on when many."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.short: list[tuple[np.ndarray, ...]] = []   # word, group, occurrences, documents
        self.medium: list[tuple[np.ndarray, ...]] = []  # two words, group, occurrences, documents
        self.long: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []

    def held(self) -> int:
        return sum(len(x[0]) for x in (*self.short, *self.medium, *self.long))

    def codes(self, langs: list[str], sources: list[str]) -> np.ndarray:
        return np.array([self.groups.setdefault(pair, len(self.groups)) for pair in zip(langs, sources)], np.uint32)

    def add(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        """Count the terms of texts ``data[offsets[i]:offsets[i + 1]]``, the i-th in group ``group[i]``."""
        letter = _LETTER[data]
        if not letter.any():
            return
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = letter[:-1], letter[1:]
        filled = np.flatnonzero(offsets[1:] > offsets[:-1])
        before[offsets[filled]] = False
        after[offsets[filled + 1] - 1] = False
        start, stop = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
        doc = np.searchsorted(offsets, start, "right") - 1
        by_group = radix_order(group[doc])  # documents stay together below their group
        start, doc, size = start[by_group], doc[by_group], (stop - start)[by_group]
        longest = int(size.max())
        width = 16
        while width < longest:
            width *= 2
        padded = np.concatenate([_LOWER[data], np.zeros(width, np.uint8)])
        eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
        word = lambda at, n: eight[at].view(">u8").ravel().astype(np.uint64) & _KEEP[n]
        short, medium = np.flatnonzero(size <= 8), np.flatnonzero((size > 8) & (size <= 16))
        for held, which, words in ((self.short, short, (word(start[short], size[short]),)),
                                   (self.medium, medium, (word(start[medium], 8), word(start[medium] + 8, size[medium] - 8)))):
            if len(which):
                order = radix_order(*words)
                words, d = tuple(w[order] for w in words), doc[which[order]]
                first, n, docs = _runs(words, group[d], d)
                held.append((*(w[first] for w in words), group[d][first], n, docs))
        low = 16
        while low < longest:
            which = np.flatnonzero((size > low) & (size <= 2 * low))
            low *= 2
            if not len(which):
                continue
            rows = np.lib.stride_tricks.sliding_window_view(padded, low)[start[which]]
            rows[np.arange(low) >= size[which][:, None]] = 0
            value = rows.view(f"S{low}").ravel()
            order = np.argsort(value, kind="stable")
            value, d = value[order], doc[which[order]]
            first, n, docs = _runs((value,), group[d], d)
            self.long.append((_text_array(rows[order][first]), group[d][first], n, docs))

    def add_long_text(self, data: np.ndarray, group: np.ndarray) -> None:
        """Count one text piece by piece, cut between terms, as one document."""
        own, start = TermCounts(), 0
        while start < len(data):
            stop = start + SLICE
            while stop < len(data) and not len(gap := np.flatnonzero(~_LETTER[data[stop:stop + SLICE]])):
                stop += SLICE
            stop = stop + int(gap[0]) if stop < len(data) else len(data)
            own.add(data[start:stop], np.array([0, stop - start]), np.zeros(1, np.uint32))
            start = stop
        for kind, held in ((own.short, self.short), (own.medium, self.medium)):
            for *words, _, n, docs in map(_merged, [kind] if kind else []):
                held.append((*words, np.full(len(n), group[0], np.uint32), n, np.minimum(docs, 1)))
        if own.long:
            terms = pa.concat_arrays([x[0] for x in own.long]).dictionary_encode()
            n = np.bincount(terms.indices.to_numpy(), np.concatenate([x[2] for x in own.long])).astype(np.int64)
            self.long.append((terms.dictionary, np.full(len(n), group[0], np.uint32), n, np.ones(len(n), np.int64)))

    def take(self) -> Iterator[pa.RecordBatch]:
        """All counts so far, as rows; the counts start anew."""
        names = [list(x) for x in zip(*self.groups)] or [[], []]
        langs, sources = (pa.array(x, pa.string()) for x in names)
        tables = [(_text_array(_as_bytes(*words)), g, n, docs) for kind in (self.short, self.medium) if kind for *words, g, n, docs in [_merged(kind)]]
        for term, g, n, docs in [*tables, *self.long]:
            at = pa.array(g.astype(np.int64))
            for k in range(0, len(g), 1 << 16):  # rows of an output batch
                cut = slice(k, k + (1 << 16))
                place = at[cut]
                yield pa.RecordBatch.from_arrays([langs.take(place), sources.take(place), term[cut].cast(pa.string()), pa.array(n[cut]), pa.array(docs[cut])],
                                                 ["lang", "source", "term", "n", "docs"])
        self.__init__()


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    *words, group, n, docs = (np.concatenate(x) for x in zip(*parts))
    order = radix_order(group, *words)
    words, group = [w[order] for w in words], group[order]
    first = np.flatnonzero(_changes(*words, group))
    return (*(w[first] for w in words), group[first], np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first))


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: partial counts of tasks, to be added up. NULL text, lang and source are empty."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TermCounts()
        for batch in batches:
            for part in bounded([batch], "text", SLICE):
                data, offsets = text_bytes(part.column("text"))
                group = counts.codes(part.column("lang").to_pylist(), part.column("source").to_pylist())
                if len(data) > SLICE:
                    counts.add_long_text(data, group)
                else:
                    counts.add(data, offsets, group)
                if counts.held() > HELD:
                    yield from counts.take()
        yield from counts.take()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(counted, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 (count + 2) / (total + 2 terms)), exactly."""
    whole = lambda c: c.cast("decimal(20,0)")
    return 1 + F.call_function("div", F.lit(1_000_000_000).cast("decimal(10,0)") * whole(count + 2), whole(total + 2 * terms))


def _pair_sums(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """Divergence of each two sources over the terms of one block; a term that a source lacks has the source's least share."""
    lang, block = (k.as_py() for k in key)
    order = np.argsort(groups.column("source").to_numpy(zero_copy_only=False), kind="stable")
    sources = groups.column("source").take(pa.array(order)).combine_chunks()
    least = groups.column("p0").to_numpy()[order] if len(order) else np.zeros(0, np.int64)
    terms = rows.column("term").combine_chunks().dictionary_encode()
    shares = np.tile(least, (len(terms.dictionary), 1))
    place = {s: i for i, s in enumerate(sources.to_pylist())}
    at = np.array([place[s] for s in rows.column("source").to_pylist()], np.int64)
    shares[terms.indices.to_numpy(), at] = rows.column("p").to_numpy()
    ones, others, values = [], [], []
    for i in range(len(order) - 1 if len(terms.dictionary) or block == 0 else 0):
        p, q = shares[:, i:i + 1], shares[:, i + 1:]
        d = p - q
        values.append((d * d // (p + q)).sum(axis=0))
        ones.append(np.full(q.shape[1], i))
        others.append(np.arange(i + 1, len(order)))
    flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    a, b = sources.take(pa.array(flat(ones))), sources.take(pa.array(flat(others)))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a.cast(pa.string()), "b": b.cast(pa.string()), "value": flat(values)})


def audit_sources(docs: DataFrame, least_docs: int = 10, top: int = 10, cells: int = CELLS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: divergences of each source of a language.

    Part ``pair``: every other source of the language, with the divergence summed over all kept terms. Part ``term``: the
    ``top`` terms that the source has more of than its language. A term is kept in a language if ``least_docs`` of its rows
    have it; repeated rows count each. NULL lang and source are the empty one; a group without terms, or a language without
    kept terms, has pairs but no terms. The pairs of n sources are n (n - 1) rows by nature; they are summed in blocks of
    terms of about ``cells`` shares each.
    """
    counted = count_terms(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = W.Window.partitionBy("lang", "term")
    kept = session.cut(counted.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("n_lang"), F.sum("docs").over(term).alias("all_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).cast("long").alias("first")).filter(F.col("all_docs") >= least_docs).drop("all_docs"))
    zero = F.lit(0).cast("long")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("first"))
    langs = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("first").alias("terms"))
    seen = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = session.cut(seen.join(totals.drop("first"), ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "terms")]))
    rated = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))

    own = rated.withColumn("q", share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))).filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    best = first_per_group(own, ["lang", "source"], [F.desc("value"), F.asc("item")], top, F.xxhash64("item"))

    size = groups.groupBy("lang").agg((F.count("*") * F.max("terms")).alias("cells")).agg(F.max("cells")).first()[0]
    blocks = (size or 0) // cells + 1
    least = F.when(F.col("terms") > 0, share(zero, F.col("total"), F.col("terms"))).otherwise(zero)
    dealt = groups.select("lang", "source", least.alias("p0"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1).cast("int"))).alias("block"))
    table = rated.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), "source", "term", "p")
    sums = table.groupBy("lang", "block").cogroup(dealt.groupBy("lang", "block")).applyInArrow(
        _pair_sums, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"), "value")
    ranked = lambda df, part: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value",
        F.row_number().over(W.Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int").alias("rank"))
    return ranked(pairs.select("lang", "s.source", "s.item", "value"), "pair").unionByName(ranked(best, "term"))
