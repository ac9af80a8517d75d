"""Divergences of sources against brute force, and the packed counts against a plain counter."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _rows():
    draw = random.Random(9)
    words = ["a", "Ab", "seventh", "eightchr", "ninechars", "Sixteen" * 2 + "xy", "seventeen" + "z" * 8, "é" * 4, "é" * 5, "日本" * 9, "q" * 70, "Ünd",
             "x1y", "dash-ed", "nul\0inside", "K" * 33, "\U0001f600"]
    rows = []
    for i in range(420):
        lang, source = draw.choice(["en", "en", "de", None, ""]), draw.choice(["hot", "hot", "hot", "s1", "s2", None])
        rows.append((i % 300, " ".join(draw.choices(words, range(len(words), 0, -1), k=draw.randint(0, 12))) if i % 11 else None, lang, source))
    rows += [(1, "same same row", "en", "s1")] * 12 + [(2, None, "en", "silent"), (3, "", "xx", "few"), (4, "rare words", "xx", "few2"), (5, "one", "yy", "only")]
    rows += [(6, "Long Words " * 600_000, "en", "big"), (7, "k" * 300_000, "en", "big")]
    return rows


def _want(rows, least=10, top=10):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        found = Counter(_terms(text))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        docs[lang].update(found.keys())
        counts[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})
        p = {}
        for s, c in [*((s, counts[lang, s]) for s in sources), (None, whole)]:
            total = sum(c[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources - {s})
            term = sorted((-f(p[s][t], p[None][t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > p[None][t])[:top]
            out += [(lang, s, part, item.decode(), -v, k) for part, found in (("pair", pair), ("term", term)) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string")
    return frame.withColumns({"term": F.lit("x"), "n": F.lit(1), "p": F.lit(2), "part": F.lit("y"), "value": F.lit(3)}).repartition(5)


@pytest.mark.parametrize("cells", [source_audit.CELLS, 7])
def test_audit(docs, cells):
    got = source_audit.audit_sources(docs, cells=cells)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _want(_rows())


def test_empty_table(docs):
    assert source_audit.audit_sources(docs.limit(0)).count() == 0


def test_counts_of_terms(docs):
    want = defaultdict(lambda: [0, 0])
    for _, text, lang, source in _rows():
        for t, n in Counter(_terms(text)).items():
            want[lang or "", source or "", t][0] += n
            want[lang or "", source or "", t][1] += 1
    got = source_audit.count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs")).collect()
    assert {tuple(r[:3]): list(r[3:]) for r in got} == dict(want)


def test_counts_handed_on_early_and_in_pieces(spark, docs, monkeypatch):
    rows = [("en", "a", "word other " * 40), ("en", "b", "m" * 900 + " end"), ("de", "a", "x" * 20)] * 30
    for held, piece in ((1, 1 << 20), (1 << 20, 64)):
        monkeypatch.setattr(source_audit, "HELD", held)
        monkeypatch.setattr(source_audit, "SLICE", piece)
        counts, total = source_audit.TermCounts(), Counter()
        for lang, source, text in rows:
            data, group = np.frombuffer(text.encode(), np.uint8), counts.codes([lang], [source])
            counts.add_long_text(data, group) if len(data) > piece else counts.add(data, np.array([0, len(data)]), group)
            if counts.held() > held:
                for b in counts.take():
                    total.update({tuple(r[k] for k in ("lang", "source", "term")) + (c,): r[c] for r in b.to_pylist() for c in ("n", "docs")})
        for b in counts.take():
            for r in b.to_pylist():
                for c in ("n", "docs"):
                    total[r["lang"], r["source"], r["term"], c] += r[c]
        assert total == {("en", "a", "word", "n"): 1200, ("en", "a", "word", "docs"): 30, ("en", "a", "other", "n"): 1200, ("en", "a", "other", "docs"): 30,
                         ("en", "b", "m" * 900, "n"): 30, ("en", "b", "m" * 900, "docs"): 30, ("en", "b", "end", "n"): 30, ("en", "b", "end", "docs"): 30,
                         ("de", "a", "x" * 20, "n"): 30, ("de", "a", "x" * 20, "docs"): 30}


def test_radix_order():
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 3, 5000).astype(np.uint32), draw.integers(0, 2**64, 5000, dtype=np.uint64) >> draw.integers(0, 60, 5000).astype(np.uint64)
    assert (source_audit.radix_order(a, b) == np.lexsort((b, a))).all()
    assert len(source_audit.radix_order(np.zeros(0, np.uint64))) == 0
