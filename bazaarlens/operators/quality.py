"""Checks of captured pages - what selectors and patterns find, and where."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions import text as tx
from bazaarlens.operators.extract import OUTLINE_COLUMNS
from bazaarlens.operators.selectors import (
    E, all_of, found_of, last_where, let, matches, nearest_above, packed, selector_array, spaced, stripped, stripped_sql, text_of)

CONTAINERS = "n.tag IN ('div', 'article', 'section')"


def _kept(df: DataFrame, *drop: str) -> list[str]:
    return [c for c in df.columns if c not in (*OUTLINE_COLUMNS, *drop)]


def selector_matches(outlines: DataFrame, selectors: DataFrame) -> DataFrame:
    """Page by page, what each selector of a table (columns: ``selectors.STEP``) finds: nodes by idx, in ``found``.

    Rows only for selectors that match; the outline stays on them.
    """
    every = outlines.select("*", F.explode(selector_array(selectors)).alias("_s"))
    return every.select(*outlines.columns, F.col("_s.selector").alias("selector"), F.expr(matches("_s")).alias("found")).filter(F.size("found") > 0)


def selector_coverage(outlines: DataFrame, selectors: DataFrame, sample_chars: int = 100) -> DataFrame:
    """Per selector of a table, pages it matches on, matches, and one sample text.

    The counts of a page become one short row per matching selector before the shuffle.
    """
    found = let(matches("s"), "found", "if(size(found) > 0, " + let("get(nodes, get(found, 0))", "x", (
        f"struct(s.selector AS selector, size(found) AS n, substring({stripped('x')}, 1, {sample_chars}) AS sample)")) + ", NULL)")
    hits = outlines.withColumn("_selectors", selector_array(selectors)).select(
        F.explode(F.expr(f"array_compact(transform(_selectors, s -> {found}))")).alias("h"))
    return hits.groupBy(F.col("h.selector").alias("selector")).agg(
        F.count("*").alias("pages"), F.sum("h.n").alias("matches"), F.min("h.sample").alias("sample"))


def pattern_coverage(texts: DataFrame, patterns: Mapping[str, str], text: str = "text",
                     source: str = "source_site") -> DataFrame:
    """Per source and named pattern, rows with a match and the smallest matched value. A dot also
    matches a line end.

    Each row is read once and aggregated wide; only the few result rows are turned long.
    """
    found = {n: tx.search_whole(F.col(text), "(?s)" + p) for n, p in patterns.items()}
    staged = texts.select(source, *[c.alias(f"v{i}") for i, c in enumerate(found.values())])
    wide = staged.groupBy(source).agg(
        *[F.struct(F.lit(n).alias("pattern"), F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("sample")).alias(f"r{i}")
          for i, n in enumerate(found)])
    return wide.select(source, F.explode(F.array(*[F.col(f"r{i}") for i in range(len(found))])).alias("r")).select(
        source, "r.*")


def all_money_values(texts: DataFrame, text: str = "text") -> DataFrame:
    """Every money value in order."""
    return texts.select(*_kept(texts, text), F.posexplode(
        F.regexp_extract_all(F.col(text), F.lit(fv.MONEY_VALUE), F.lit(0))).alias("pos", "value"))


def keyword_in_context(texts: DataFrame, keyword: str, rest: str = "", chars: int = 50, text: str = "text") -> DataFrame:
    """I4: every match of a keyword (plus an optional pattern after it) with ``chars`` on both sides.

    One regular expression returns match and both contexts, so no positions are collected.
    The look-ahead for the keyword keeps the look-behind off every other character.
    """
    word = "(?i:" + keyword.replace(" ", r"\ ") + ")"
    pattern = (rf"(?sU)(?={word})(?<=(\A.{{0,{chars - 1}}}|.{{{chars}}}))({word}(?i:{rest}))(?=(.{{0,{chars}}}))")
    group = [F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(g)) for g in (1, 2, 3)]
    flat = lambda c: F.replace(c, F.lit("\n"), F.lit(" "))
    return (
        texts.select(*_kept(texts, text), F.posexplode(F.arrays_zip(
            group[0].alias("before"), group[1].alias("found"), group[2].alias("after"))).alias("pos", "m"))
        .select(*_kept(texts, text), "pos", F.col("m.found").alias("found"),
                F.concat(flat(F.col("m.before")), flat(F.col("m.found")), flat(F.col("m.after"))).alias("context")))


def definition_pairs(outlines: DataFrame, words: Sequence[str] = ()) -> DataFrame:
    """Each ``dt`` with its next sibling ``dd``; ``words`` keeps labels holding one of them.

    The ``dd``s of a page are sorted by parent and place, so a sibling is found by halving steps.
    """
    dds = f"array_sort(transform({found_of(E('dd'))}, i -> struct(get(nodes, i).parent AS parent, i AS idx)))"
    after = f"get(dds, {last_where('dds', '{x} <= struct(dt.parent AS parent, dt.idx AS idx)')} + 1)"
    sibling = let(after, "d", f"if(d.parent = dt.parent, struct({stripped('dt')} AS label, "
                  f"{let('get(nodes, d.idx)', 'v', stripped('v'))} AS value), NULL)")
    pairs = F.expr(let(dds, "dds", f"array_compact(transform({all_of(E('dt'))}, dt -> {sibling}))"))
    out = outlines.select(*_kept(outlines), F.posexplode(pairs).alias("pos", "p")).select(
        *_kept(outlines), "pos", "p.*")
    return out.filter(tx.contains_any(F.lower("label"), words)) if words else out


def table_rows(outlines: DataFrame, first: int | None = None) -> DataFrame:
    """Cells of every table row; ``first`` limits the rows shown per table."""
    rows = all_of(E("tr"), within="t")
    rows = rows if first is None else f"slice({rows}, 1, {first})"
    cells = f"transform({all_of(E(('td', 'th')), within='r')}, c -> {stripped('c')})"
    tables = F.expr(f"transform({all_of(E('table'))}, t -> transform({rows}, r -> {cells}))")
    return (
        outlines.select(*_kept(outlines), F.posexplode(tables).alias("table_no", "rows"))
        .select(*_kept(outlines), "table_no", F.posexplode("rows").alias("row_no", "cells"))
        .filter(F.size("cells") > 0))


def expected_vs_actual(actual: DataFrame, expected: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Field by field, NULL equal to NULL."""
    joined = expected.select(key, *[F.col(f).alias(f"expected_{f}") for f in fields]).join(
        actual.select(key, *fields), key, "left")
    return joined.select(key, *[F.col(f).eqNullSafe(F.col(f"expected_{f}")).alias(f"{f}_ok") for f in fields])


def link_pattern_scan(outlines: DataFrame, parts: Sequence[str], skip: Sequence[str] = (),
                      min_text: int | None = None) -> DataFrame:
    """I8: distinct links holding any of the path parts and none of ``skip``."""
    links = F.expr(f"transform({all_of(E('a', has_attr='href'))}, n -> struct(n.attrs['href'] AS href, {packed('n')} AS label))")
    out = outlines.select(*_kept(outlines), F.explode(links).alias("l")).select(*_kept(outlines), "l.*")
    out = out.filter(tx.contains_any(F.col("href"), parts))
    if skip:
        out = out.filter(~tx.contains_any(F.col("href"), skip))
    if min_text is not None:
        out = out.filter(F.length("label") > min_text)
    return out.drop("label").distinct()


def embedded_json_keys(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Top-level keys of a JSON object, length of a JSON array; NULL for anything else."""
    valid = F.try_parse_json(F.col(body)).isNotNull()
    return bodies.select(
        *_kept(bodies, body), F.when(valid, F.array_join(F.json_object_keys(body), ",")).alias("keys"),
        F.when(valid, F.json_array_length(body)).alias("array_length"))


def dead_page_filter(outlines: DataFrame) -> DataFrame:
    """Drop pages whose title says they are gone."""
    title = F.lower(F.coalesce(text_of(E("title")), F.lit("")))
    return outlines.filter(~title.rlike(fv.DEAD_TITLE))


def locate_text(outlines: DataFrame, hit: Column) -> DataFrame:
    """Every text piece for which ``hit`` (over ``piece``) holds, with the element around it and that one's parent.

    ``n_found`` counts them by page; ``text`` is stripped.
    """
    pieces = F.filter(F.arrays_zip("strings", "string_nodes"), lambda z: F.coalesce(hit(z["strings"]), F.lit(False)))
    at = F.get("nodes", F.when(F.col("p.string_nodes") >= 0, F.col("p.string_nodes")))
    placed = (outlines.withColumn("_pieces", pieces).select("*", F.size("_pieces").alias("n_found"), F.posexplode("_pieces").alias("pos", "p"))
              .withColumn("_at", at))
    parent = F.get("nodes", F.when(F.col("_at.parent") >= 0, F.col("_at.parent")))
    return placed.withColumn("_parent", parent).select(
        *_kept(outlines), "pos", "n_found", F.col("_at.tag").alias("tag"), tx.strip(F.col("p.strings")).alias("text"),
        F.col("_parent.tag").alias("parent_tag"), F.col("_parent.cls").alias("parent_class"))


def locate_value(outlines: DataFrame, value: str) -> DataFrame:
    """Text pieces holding the value of a column, as they stand."""
    return locate_text(outlines, lambda piece: F.contains(piece, F.col(value)))


def locate_keywords(outlines: DataFrame, words: Sequence[str]) -> DataFrame:
    """Text pieces holding one of the words in any case."""
    return locate_text(outlines, lambda piece: tx.contains_any(F.lower(piece), [w.lower() for w in words]))


def locate_pattern(outlines: DataFrame, pattern: str) -> DataFrame:
    """Text pieces in which the pattern is found."""
    return locate_text(outlines, lambda piece: piece.rlike(pattern))


def container_text(outlines: DataFrame, link: E, patterns: Mapping[str, str]) -> DataFrame:
    """Text of the nearest ``div``/``article``/``section`` above each link, and what the patterns find in it."""
    box = "get(nodes, nullif(get(boxes, nullif(a.parent, -1)), -1))"
    around = let(box, "b", f"struct(a.attrs['href'] AS href, b.tag AS container, {spaced('b')} AS text)")
    found = outlines.select(*_kept(outlines), F.posexplode(F.expr(let(
        nearest_above(CONTAINERS), "boxes", f"transform({all_of(link)}, a -> {around})"))).alias("pos", "c"))
    return found.select(
        *_kept(outlines), "pos", "c.*",
        *[tx.search_whole(F.col("c.text"), p).alias(n) for n, p in patterns.items()])


def price_link_containers(outlines: DataFrame, price: str = r"\$[\d,]+", link: E = E("a", has_attr="href"), with_text: bool = False) -> DataFrame:
    """The containers that hold both a price and a link, each once a page, with their first link.

    From every text piece with a price the way goes up to the nearest element with a link below it; a way that meets
    ``body`` or ``html`` first counts for nothing. Text of scripts and styles is no piece. Whether a link lies below
    an element is one search in the sorted list of links. ``with_text`` adds each container's whole text, which
    nested containers share.
    """
    linked = f"coalesce(get(links, {last_where('links', '{x} <= n.idx')} + 1) <= n.last, false)"
    stop = nearest_above(f"n.tag IN ('body', 'html') OR {linked}")
    priced = f"filter(arrays_zip(strings, string_nodes), z -> z.string_nodes >= 0 AND z.strings RLIKE r'{price}')"
    ways = (f"array_sort(filter(transform({priced}, z -> get(stops, z.string_nodes)), "
            "i -> i >= 0 AND get(nodes, i).tag NOT IN ('body', 'html')))")
    box = let("get(nodes, i)", "b", (
        f"struct(b.tag AS container, b.cls AS container_class, {last_where('ways', '{x} <= i')} - {last_where('ways', '{x} < i')} AS n_prices, "
        f"get(nodes, get(links, {last_where('links', '{x} <= i')} + 1)).attrs['href'] AS href{f', {spaced('b')} AS text' if with_text else ''})"))
    boxes = let(found_of(link), "links", let(stop, "stops", let(ways, "ways", f"transform(array_distinct(ways), i -> {box})")))
    return outlines.select(*_kept(outlines), F.posexplode(F.expr(boxes)).alias("pos", "c")).select(*_kept(outlines), "pos", "c.*")


def script_inventory(outlines: DataFrame) -> DataFrame:
    """Every script by id, else source, else the start of its code."""
    names = F.expr(f"""transform({all_of(E('script'))}, n -> CASE
        WHEN n.attrs['id'] <> '' THEN struct('id' AS kind, n.attrs['id'] AS name)
        WHEN n.attrs['src'] <> '' THEN struct('src' AS kind, n.attrs['src'] AS name)
        ELSE struct('inline' AS kind, substring(coalesce(n.raw, 'No content'), 1, 100) AS name) END)""")
    return outlines.select(*_kept(outlines), F.posexplode(names).alias("pos", "s")).select(
        *_kept(outlines), "pos", "s.*")


def meta_tags(outlines: DataFrame, words: Sequence[str] = fv.META_WORDS) -> DataFrame:
    """``meta[property]`` whose property mentions one of the words."""
    tags = F.expr(f"""transform({all_of(E('meta', has_attr='property'))},
        n -> struct(n.attrs['property'] AS property, coalesce(n.attrs['content'], '') AS content))""")
    return (
        outlines.select(*_kept(outlines), F.explode(tags).alias("m")).select(*_kept(outlines), "m.*")
        .filter(tx.contains_any(F.lower("property"), words)))
