"""Operators against brute force, with the awkward rows each has to take: NULLs, empty and long texts, ties,
repeated rows, empty tables, and columns with clashing names."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bazaarlens.llm import (components, language_id, packing, quality_ranking, quality_rules, sentence_pieces, sharding, simhash, substrings,
                            topk, url_rules)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, score double, fp string, _row int, kept string"


def _texts():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdeéñ") for _ in range(draw.randint(1, 6)))
    passage = [word() for _ in range(70)]
    body = [[word() for _ in range(draw.randint(20, 260))] for _ in range(24)]
    for i in (3, 5, 8, 13):
        cut = draw.randint(0, len(body[i]))
        body[i][cut:cut] = passage[draw.randint(0, 15):]
    texts = [" ".join(b) for b in body]
    texts[7] = texts[2] + "\n" + texts[2]  # a copy twice over
    texts[9] = texts[4]
    texts[10] = texts[4].replace(" ", "\t\n ", 40) + " more"
    return [*texts, "", None, " \n\t ", "one two three", "zwei  drei", "1 2 3 #$%", "x " * 40_000, "y" * 70_000, texts[4], texts[4]]


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    ids = [*range(len(texts) - 2), 9, None]  # the last two: a repeated row of id 9, and a NULL id
    return [(i, t, None, 0.5, "x", 1, "k") for i, t in zip(ids, texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _key(row):
    return tuple((v is not None, v) for v in row)


def _sorted(df_or_rows):
    got = df_or_rows.collect() if hasattr(df_or_rows, "collect") else df_or_rows
    return sorted((tuple(r) for r in got), key=_key)


def test_substrings(docs, none, rows):
    assert {(a - b) % 31 for a in substrings.COVER for b in substrings.COVER} == set(range(31))
    cut = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    least = {}
    for i, w in cut:
        if i is not None:
            for p in range(len(w) - 49):
                g = tuple(w[p:p + 50])
                least[g] = min(least.get(g, i), i)
    want = []
    for i, w in cut:
        gone = {q for p in range(len(w) - 49) if i is not None and least[tuple(w[p:p + 50])] < i for q in range(p, p + 50)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert _sorted(substrings.repeat_digests(docs)) == _sorted(want)
    left = substrings.remove_repeats(docs)
    assert left.columns == docs.columns
    by = {w[0]: w for w in want}
    for r in left.filter("doc_id IS NOT NULL").collect():
        n, removed, digest = by[r["doc_id"]][1:]
        if removed:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == digest and removed < n
    assert substrings.repeat_digests(none).count() == 0 and substrings.remove_repeats(none).count() == 0


def test_simhash(docs, none, rows):
    fps = []
    for _, t, *_ in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        fps.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0)
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (fps[i] ^ fps[j]).bit_count() <= 4) for i in range(len(rows))]
    least = {c: min((rows[j][0] for j in range(len(rows)) if label[j] == c and rows[j][0] is not None), default=None) for c in label}
    want = [(rows[i][0], fps[i] - (1 << 64 if fps[i] >> 63 else 0), least[label[i]]) for i in range(len(rows))]
    got = simhash.simhash_components(docs).select("doc_id", "fp", "component_id")
    assert _sorted(got) == _sorted(want)
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(c for c in set(least.values()))
    assert simhash.simhash_components(none).count() == 0


def test_simhash_crowded_buckets(spark):
    draw = np.random.default_rng(3)
    centre = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << draw.integers(0, 64, (40, 30, 2), dtype=np.uint64)
    fp = np.unique(np.concatenate([(centre[:, None] ^ np.bitwise_or.reduce(flips, axis=2)).ravel(), draw.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 4
    label = np.arange(len(fp))
    while (new := np.array([label[r].min() for r in near])).tolist() != label.tolist():
        label = new
    for bucket_rows in (4096, 7):  # whole buckets, and buckets cut into pairs of chunks
        found = components.roots(simhash.link_fingerprints(nodes, 4, bucket_rows)).collect()
        root = {r["u"]: r["root"] for r in found}
        groups = Counter(root.get(int(x), int(x)) for x in fp.view(np.int64))
        assert sorted(groups.values()) == sorted(np.bincount(label)[np.unique(label)].tolist())


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "u long, v long")
    root = {r["u"]: r["root"] for r in components.roots(edges).collect()}
    assert root == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def _statistics(t):
    t = t or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(docs, none, rows, spark):
    got = quality_rules.text_statistics(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert _sorted(got) == _sorted([(i, *_statistics(t)) for i, t, *_ in rows])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = quality_rules.judge_quality(docs, labels)
    assert all(r["kept"] == (not r["base_failed"]) for r in judged.collect())  # nothing learned
    assert quality_rules.keep_quality(none, labels).count() == 0


def test_quality_rules_learn_and_prune(spark):
    draw = random.Random(2)
    rows = []
    for i in range(900):
        bad = i % 3 == 0
        kind = i % 2
        rows.append((i, draw.uniform(0.4, 1) if bad and kind else draw.uniform(0, 0.3), draw.uniform(5, 9) if bad and not kind else draw.uniform(0, 4.5), int(not bad)))
    table = spark.createDataFrame(rows, "id long, a double, b double, y int")
    rules = quality_rules.fit_decision_list(table, "y", "id", ("a", "b"))
    judged = table.withColumn("ok", quality_rules.verdict(rules)).collect()
    # Thresholds are quantiles of the bad rows: a few of these lie below the lowest one.
    assert len(rules) == 2 and all(r["ok"] for r in judged if r["y"]) and sum(r["ok"] for r in judged if not r["y"]) < 30
    assert quality_rules.fit_decision_list(table.filter("y = 1"), "y", "id", ("a", "b")) == []


def test_quality_stage_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    kept = {r["doc_id"] for r in quality_rules.keep_quality(docs, labels).select("doc_id").collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    whole = {r["doc_id"]: _statistics(r["text"]) for r in docs.collect()}
    clean = [i for i, q in truth.items() if q == 1 and whole[i][0] >= 50 and 2 * whole[i][4] <= whole[i][0]]
    junk = [i for i, q in truth.items() if q == 0]
    assert sum(i in kept for i in clean) > 0.99 * len(clean) and sum(i in kept for i in junk) < 0.2 * len(junk)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in entry.queries()["op8_language_id"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert len(held) > 250 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in held)


def test_language_odd_rows(docs, none, spark):
    model = language_id.fit_languages(spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)] * 9)],
        "doc_id long, text string, lang string"))
    assert model.languages == ("de", "en")
    named = language_id.identify(docs, model)
    assert named.columns == [*docs.columns, "lang_pred", "score_", "ambiguous"]  # docs has a score of its own
    for r in named.collect():
        blank = not any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == blank and 0 <= r["score_"] <= 1 and (not blank or r["ambiguous"])
    assert language_id.identify(none, model).count() == 0
    nothing = language_id.fit_languages(none)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(250 * k + i, " ".join([letters[i % 26] + letters[i // 26] + letters[(7 * i) % 26]] * 30 + ["the", "of"] * k), f"l{i:03d}")
            for i in range(250) for k in range(4)]
    model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rounds=20)
    assert len(model.languages) == 250
    with pytest.raises(ValueError):
        language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_documents=200)


def test_one_text_per_sampled_id(spark, monkeypatch):
    rows = [(7, f"word number {i}", "en") for i in range(3000)] + [(i, "noch ein wort", "de") for i in range(500)]
    seen = []
    monkeypatch.setattr(language_id, "codewords", lambda n, real=language_id.codewords: real(n))
    monkeypatch.setattr(np, "stack", lambda x, *a, real=np.stack, **k: (seen.append(len(x)), real(x, *a, **k))[1])
    language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=300, rounds=1)
    assert max(seen) == 301


def test_corpus_without_languages_is_kept(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, None), (3, "12 34", None), (4, "more", None)], "doc_id long, text string, lang string")
    left = language_id.keep_identified(docs, language_id.fit_languages(docs))
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4] and left.columns == docs.columns


def test_many_kinds_of_bad_documents(spark):
    draw = random.Random(5)
    rows, names = [], [f"f{k}" for k in range(9)]
    for i in range(2700):
        kind = i % 18
        rows.append((i, *(draw.uniform(0.6, 1) if k == kind else draw.uniform(0, 0.5) for k in range(9)), int(kind > 8)))
    table = spark.createDataFrame(rows, ", ".join(["id long", *(f"{n} double" for n in names), "y int"]))
    rules = quality_rules.fit_decision_list(table, "y", "id", tuple(names))
    judged = table.withColumn("ok", quality_rules.verdict(rules)).collect()
    assert len(rules) == 9 and sum(r["ok"] for r in judged if not r["y"]) < 200 and all(r["ok"] for r in judged if r["y"])


def test_codewords():
    for n in (1, 2, 4, 6, 11):
        code = language_id.codewords(n)
        assert code.shape[0] == n and len({tuple(r) for r in code}) == n
        if n > 6:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 3


def test_ranking_held_out(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in entry.queries()["op2_quality_ranking"](spark, "/root/testdata/sf0.01").collect() if r["held_out"] and r["doc_id"] in truth]
    good = np.array([r["score"] for r in held if truth[r["doc_id"]] == 1])
    bad = np.array([r["score"] for r in held if truth[r["doc_id"]] == 0])
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in held)


def test_ranking_odd_rows(docs, none):
    labels = docs.select(F.col("doc_id").alias("_id"), (F.length("text") > 300).cast("int").alias("_label")).dropDuplicates(["_id"])
    model = quality_ranking.fit_ranking(docs, labels)
    scored = quality_ranking.score_quality(docs, model)
    assert scored.columns == [*docs.columns, "score_", "predicted"]
    assert all(0 <= r["score_"] <= 1 for r in scored.collect())
    assert quality_ranking.score_quality(none, model).count() == 0
    assert quality_ranking.fit_ranking(docs, labels.filter("_label = 1")) is None
    assert {r["predicted"] for r in quality_ranking.score_quality(docs, None).collect()} == {1}


def test_ranking_threshold_covers_all_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("text IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text")
    labels = quality_rules.label_quality(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality_ranking.fit_ranking(docs, labels, per_label=25)
    told = docs.join(labels, F.col("doc_id") == F.col("_id")).filter("_label IN (0, 1)")
    bad = told.filter("_label = 0").count()
    below = quality_ranking.score_quality(told.select("doc_id", "text"), model, cut=0.5).filter("score < 0.5").collect()
    assert abs(len(below) - bad) <= 2  # before, off by the error of 50 sampled scores


def test_ranking_repeated_ids(spark):
    bad = [(i, f"### {i} $$$ !!!") for i in range(100, 104)]
    rows = [(1, f"The garden has a bench, number {i}.") for i in range(300)] + bad
    labels = spark.createDataFrame([(1, 1), *((i, 0) for i, _ in bad)], "_id long, _label int")
    one, other = (quality_ranking.fit_ranking(spark.createDataFrame(r, "doc_id long, text string").coalesce(1), labels, per_label=2)
                  for r in (rows, rows[::-1]))
    assert one is not None and (one.weights == other.weights).all() and one.threshold == other.threshold


def test_topk_odd_rows(spark, tmp_path):
    draw = random.Random(4)
    vectors = [(i, [draw.uniform(-1, 1) for _ in range(6)]) for i in range(60)]
    same = [0.5, -0.25, 0.1, 0.9, -0.7, 0.3]
    vectors += [(i, same) for i in range(60, 110)] + [(40, vectors[3][1]), (None, same), (200, None), (220, [float("nan")] * 6),
                                                      (240, [float("inf")] * 6), (260, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (280, []), (300, [0.4, 0.4])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "v"))
    stored = topk.quantized(spark.read.parquet(str(tmp_path / "v")), "vec_id", "embedding")
    stored.write.parquet(str(tmp_path / "q"))
    stored = spark.read.parquet(str(tmp_path / "q"))
    rows = [(r["row"], r["vec_id"], r["v"]) for r in stored.collect()]
    assert len(rows) == 112
    for k in (5, 200):
        want = []
        for row, i, v in rows:
            if i % 20 == 0:
                scored = sorted((-sum(a * b for a, b in zip(v, x)), j, r) for r, j, x in rows if r != row and len(x) == len(v))
                want += [(i, n + 1, j, -s) for n, (s, j, r) in enumerate(scored[:k])]
        got = topk.top_k(stored, F.col("vec_id") % 20 == 0, k, nodes=3, block_rows=16, block_queries=2)
        assert _sorted(got) == _sorted(want)
    assert topk.top_k(stored.filter("vec_id < 0"), F.col("vec_id") % 20 == 0, 5).count() == 0


def test_topk_fewer_components_than_nodes(spark, tmp_path):
    rows = [(0, 0, [64])] + [(i, i, [-70 - 3 * i]) for i in range(1, 40)]
    spark.createDataFrame(rows, "row long, vec_id long, v array<long>").write.parquet(str(tmp_path / "q"))
    got = topk.top_k(spark.read.parquet(str(tmp_path / "q")), F.col("vec_id") == 0, 5, nodes=2)
    assert _sorted(got) == [(0, i, i, 64 * (-70 - 3 * i)) for i in range(1, 6)]


def _tokens(t):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(t or "", add_special_tokens=False).ids + [0]


def test_packing(docs, none, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ranks = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = packing.pack_documents(docs, path, 512, ranks).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = _tokens(t)
        cuts = [0, *range(len(ids) % 512 or 512, len(ids) + 1, 512)]
        want.update((i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert all(a == sum(n for _, n in places[:k]) for k, (a, _) in enumerate(places)) and sum(n for _, n in places) <= 512
    total = sum(r["length"] for r in got)
    assert len(by) <= 1.02 * total / 512 + 1
    assert packing.pack_documents(none, path).count() == 0
    whole = packing.sequences(docs.filter("doc_id < 6"), path, 512, ranks).collect()
    assert sorted(x for r in whole for x in r["ids"]) == sorted(x for i, t, *_ in rows if i is not None and i < 6 for x in _tokens(t))


def test_tokenizer_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = packing.Tokenizer(path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    draw = random.Random(9)
    for _ in range(300):
        t = "".join(draw.choice(["a", "the", " ", "  ", "\n", "'s", "'", "é", "ß", "12", "!", "\u00a0", "日本", "<|endoftext|>", "\x1c", "\x7f", "÷", "😀"]) for _ in range(30))
        assert np.frombuffer(both.ids(t.encode()), "<u4").tolist() == _tokens(t)[:-1]


def test_genetic_steps_keep_every_piece():
    draw = np.random.default_rng(1)
    sizes = draw.integers(1, 100, 300)
    group = packing.evolve(sizes, 100, [], 6, 40, 3)
    start = packing._repacked(sizes, np.zeros(300, np.int64), np.arange(300), 100, draw, 0.3)
    for p in (group[0], packing.crossover(sizes, group[0], start, 100, draw), packing.mutation(sizes, start, 100, draw)):
        assert np.bincount(p.bins, sizes).max() <= 100 and len(p.bins) == 300 and (p.fill > 0).all()
    assert len(group[0].fill) <= len(start.fill)


def test_url_rules(spark):
    urls = [None, "", "no host", "http://", "https://EXAMPLE.com/en/x?q#f", "http://www.example.com/en/", "http://a.www.example.com/en/b", "http://com/", "http://x.com",
            "http://x.com/a", "http://notexample.com/en/", "ftp://a.net/es/1", "http://a.net/es", "http://net/fr/#x", "http://a.b.c.d.e.net/fr/z", "http://x.org/en/",
            "http://example.com:80/en/", "http://example.com./en/", "http://y.com/a://z.net/es/", "http://a\nb.com/en/\n", "http://com?x/en/", "http://" + "a." * 3000 + "com/"]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
             ("com", "/a", "block"), (None, "/", "block")]
    want = []
    for i, u in enumerate(urls * 3):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        want.append((i, host, path, best and best[2], best[3] if best else "allow"))
    pages = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(urls * 3)], "page_id long, url string, host int, verdict string")
    table = url_rules.rules_table(spark, rules)
    assert _sorted(url_rules.judge_urls(pages, table, "page_id", "url")) == _sorted(want)
    assert url_rules.judge_urls(pages.limit(0), table, "page_id", "url").count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(pages, table.limit(0), "page_id", "url", "block").collect()} == {"block"}


def test_sharding(docs, none, rows, spark):
    got = sharding.assign_shards(docs, 5).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sharding.assign_shards(none, 5).count() == 0
    same = spark.createDataFrame([(7 if i % 2 else i, "z" * (i % 50)) for i in range(4000)], "doc_id long, text string")
    got = sharding.assign_shards(same, 24).collect()
    size, slots = Counter(), {}
    for r in got:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(size) == list(range(24)) and max(size.values()) - min(size.values()) < 250
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    firsts = sorted((r["doc_id"], r["shard"]) for r in got)
    assert [s for _, s in firsts] == sorted(s for _, s in firsts)  # key order


def test_repeated_rows_give_the_marks_of_one(spark):
    text = " ".join(f"w{i}" for i in range(90))
    one = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    many = spark.createDataFrame([(1, text)] * 60 + [(2, text)] * 3, "doc_id long, text string")
    marks = [{r["k"]: len(r["marks"]) for r in substrings._marks(substrings._keyed(d), 50).collect()} for d in (one, many)]
    starts = [{r["k"]: sorted(r["starts"]) for r in substrings.repeated_windows(d).collect()} for d in (one, many)]
    assert marks[0] == marks[1] and set(marks[0]) == {1, 2} and starts[0] == starts[1] == {2: list(range(41))}


def test_boundaries_by_a_tree_of_products(spark):
    names = [[sentence_pieces.START]] + [[f"0:{c}" for c in "abc"]] * 100
    draw, rows, want = random.Random(3), [], {}
    for row, n in enumerate((1, 7, 8, 9, 64, 65, 100)):
        path = [sentence_pieces.START] + [draw.choice(x) for x in names[1:n + 1]]
        every = []
        for k in range(n):  # the one path, and dead ends off it
            dead = {(path[k], x) for x in names[k + 1] if x != path[k + 1]} if k + 1 < n and draw.random() < .5 else set()
            every.append({(path[k], path[k + 1])} | dead)
        want[row] = sentence_pieces._boundaries(every)
        assert want[row] == path
        rows += [(row, k, [i for i, _ in m], [j for _, j in m]) for k, m in enumerate(every)]
    rows += [(99, k, [sentence_pieces.START] if not k else ["0:a", "0:b"], ["0:a", "0:b"] if k else ["0:a"]) for k in range(20)]
    rows[-1] = (99, 19, ["0:b"], ["0:b"])  # no way through
    got = {}
    for r in sentence_pieces._fixed(spark.createDataFrame(rows, sentence_pieces._MATRIX)).collect():
        got.setdefault(r["row"], {})[r["n"]] = (r["entry"], r["exit"])
    assert all(got[row] == dict(enumerate(zip(at, at[1:]))) for row, at in want.items())
    assert len(got[99]) == 20 and set(got[99].values()) == {(None, None)}


def test_sentence_pieces(docs, none, rows):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for giant, chunk in ((1 << 16, 8192), (200, 64)):  # the long texts, then nearly all, by the scan
        got = sentence_pieces.decode(sentence_pieces.encode(docs, path, giant_bytes=giant, chunk=chunk), path).collect()
        assert len(got) == len(rows) and max(r["n_chunks"] for r in got) > 8
        for r in got:
            assert np.frombuffer(r["ids"], "<u4").tolist() == model.encode(r["text"] or "")
            assert r["decoded"] == (r["text"] or "")
    assert sentence_pieces.encode(none, path).count() == 0


def test_scan_of_random_texts():
    p = sentence_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    draw = random.Random(1)
    letters = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "日", "😀", "\t", "er", "on", "X", "0", "12", ".", "!", "▁", "ß"]
    for _ in range(200):
        t = "".join(draw.choice(letters) for _ in range(draw.randint(1, 120)))
        want = p.model.encode(t)
        assert np.frombuffer(p.encode(t.encode()), "<u4").tolist() == want
        whole, chunks, matrices = sentence_pieces.normalised(t), [], []
        for n, a in enumerate(range(0, len(whole), 40)):
            b, low = min(a + 40, len(whole)), max(0, a - 32)
            chunks.append((whole[low:b + 32], a - low, b - low))
            matrices.append(set(sentence_pieces.transfer(p, *chunks[-1], n == 0, b == len(whole))))
        at = sentence_pieces._boundaries(matrices)
        assert [i for c, x, y in zip(chunks, at, at[1:]) for i in sentence_pieces.traced(p, *c, x, y)] == want
        left = right = matrices[0]
        for m in matrices[1:]:
            left = sentence_pieces.combine(left, m)
        for k, m in enumerate(reversed(matrices)):  # the same product from the right
            right = m if not k else sentence_pieces.combine(m, right)
        assert left == right and len(left) == 1


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "language ID", "SimHash near-dedup", "substring dedup", "best-fit packing"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for _, stage in pipeline.STAGES[:-1]:
        seen.append(pipeline.cut(stage(spark, seen[-1], sf)))
        assert seen[-1].schema == docs.schema
    good, named, single, trimmed = (s.collect() for s in seen[1:])
    for r in good:
        n, _, _, _, repeats = _statistics(r["text"])
        assert n >= 50 and 2 * repeats <= n
    assert {r["doc_id"] for r in named} <= {r["doc_id"] for r in good} and len(named) > 0.95 * len(good)
    groups = simhash.simhash_components(seen[2]).collect()
    assert sorted(r["doc_id"] for r in single) == sorted({r["component_id"] for r in groups})
    want = {r["doc_id"]: r for r in substrings.repeat_digests(seen[3]).collect()}
    for r in trimmed:
        w = want.pop(r["doc_id"])
        if w["n_removed"]:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == w["kept_sha256"]
    assert all(w["n_removed"] == w["n_words"] > 0 for w in want.values())
    packed = Counter()
    for r in pipeline.run(spark, sf).collect():
        packed[r["doc_id"]] += r["length"]
    assert packed == Counter({r["doc_id"]: len(_tokens(r["text"])) for r in trimmed})
