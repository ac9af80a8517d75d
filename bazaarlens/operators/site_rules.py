"""H2: a site as rows. Where each field of a record comes from is stored in a table and compiled to expressions.

A rule says for one field of one site where its text is: in an element, in the value of a labelled row, in the page, in
the URL, or given. Rules of one field are tried in the order of ``option``. A compiled site is an entry like those of
``extract.EXTRACTORS``: it shares their scan and its pages never leave the JVM after the parse.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Row, functions as F

from bazaarlens import schemas
from bazaarlens.functions import text as tx
from bazaarlens.operators.extract import EXTRACTORS, _AMOUNTS, Found, Layout, Pick, Rules, Site, extract_listings, pick
from bazaarlens.operators.selectors import E, elements

#: One rule. ``selector`` and ``unless`` name selectors of a table with the columns of ``selectors.STEP``.
RULE = ("site string, field string, option int, source string, selector string, take string, words array<string>, path string, "
        "pattern string, value string, unless string, most int, required boolean")
MOST_RULES = 10_000
SOURCES = ("element", "label", "page", "url", "value", "row", "setting")
_ROW = ("box", "row", "label", "value")
_SETTINGS = {"amounts": ("suffix",), "text": ("spaced",)}
_RECORD = {f.name for f in schemas.EXTRACTED.fields}


def _checked(r: Row, known: Mapping[str, E]) -> Row:
    """The rule, or an error that names it."""
    def refuse(why: str):
        raise ValueError(f"rule of site {r['site']}, field {r['field']}: {why}")

    if r["site"] is None or r["field"] is None or r["source"] not in SOURCES:
        refuse(f"site and field are needed, and one of {SOURCES} as source")
    if r["source"] == "setting":
        if r["value"] not in _SETTINGS.get(r["field"], ()):
            refuse(f"settings are {_SETTINGS}")
    elif r["field"] not in (_ROW if r["source"] == "row" else _RECORD):
        refuse("a record has no such field")
    if r["source"] in ("element", "row") and r["selector"] is None or r["source"] == "label" and not r["words"]:
        refuse("elements and rows need a selector, labels their words")
    for name in (r["selector"], r["unless"]):
        if name is not None and name not in known:
            refuse(f"unknown selector {name}")
    return r


def _compiled(rules: list[Row], known: Mapping[str, E]) -> Site:
    """One site from its rules, in order."""
    slots: dict[tuple[str, str], str] = {}
    kinds: dict[tuple[str, ...], str] = {}
    by_field: dict[str, list[Row]] = defaultdict(list)
    row: dict[str, E] = {}
    settings: set[str] = set()
    for r in rules:
        if r["source"] == "setting":
            settings.add(r["field"])
        elif r["source"] == "row":
            row[r["field"]] = known[r["selector"]]
        else:
            by_field[r["field"]].append(r)
            for key in ((r["selector"], r["take"] or "stripped"), (r["unless"], "text")):
                if key[0] is not None:
                    slots.setdefault(key, f"rule{len(slots)}")
            if r["source"] == "label":
                kinds.setdefault(tuple(w.lower() for w in r["words"]), f"rule{len(kinds)}")
    if kinds and set(row) != set(_ROW):
        raise ValueError(f"site {rules[0]['site']}: labels need a selector for each of {_ROW}")
    suffix = "amounts" in settings
    required = [f for f, of in by_field.items() if any(r["required"] for r in of)]

    def text(at: Found, r: Row) -> Column:
        source = r["source"]
        value = (at.picks[slots[r["selector"], r["take"] or "stripped"]] if source == "element" else
                 at.labels[kinds[tuple(w.lower() for w in r["words"])]] if source == "label" else
                 at.text if source == "page" else at.url if source == "url" else F.lit(r["value"]).cast("string"))
        if r["path"] is not None:
            value = F.get_json_object(value, r["path"])
        if r["pattern"] is not None:
            value = tx.search(value, r["pattern"])
        if source != "element" or r["take"] not in (None, "stripped") or r["path"] is not None or r["pattern"] is not None:
            value = tx.strip(value)
        if r["most"] is not None:
            value = tx.truncate(value, r["most"])
        if r["unless"] is not None:
            value = F.when(at.picks[slots[r["unless"], "text"]].isNull(), value)
        return tx.not_blank(value)

    def fields(at: Found) -> dict[str, Column | tuple[Column, ...]]:
        every = {f: tuple(text(at, r) for r in of) for f, of in by_field.items()}
        return {f: of if f in _AMOUNTS and not suffix else F.coalesce(*of) for f, of in every.items()}

    def complete(got: Rules) -> Rules:
        keep = F.lit(True)
        for f in required:
            keep = keep & got[f].isNotNull()
        return {"_keep": keep}

    picks: dict[str, Pick] = {slot: pick(known[name], take=take) for (name, take), slot in slots.items()}
    layout = Layout(row["box"], row["row"], row["label"], row["value"]) if kinds else None
    return Site(fields, picks, layout=layout, kinds=tuple((k, w) for w, k in kinds.items()), derived=complete if required else None,
                spaced_text="text" in settings, suffix_amounts=suffix)


_COMPILED: dict[tuple, dict[str, Site]] = {}


def sites(rules: DataFrame, selectors: DataFrame) -> dict[str, Site]:
    """The sites of a table of rules (columns: RULE), over a table of selectors (columns: ``selectors.STEP``).

    ``element``: text of the first element of ``selector``; ``take`` says which (stripped, text, packed, raw or an
    attribute's name). ``label``: value of the last labelled row with all ``words``; the ``row`` rules with the fields
    box, row, label and value name the selectors of such rows, and a row goes to the first rule that fits. ``page`` is the
    page's text, ``url`` the URL, ``value`` the given one. Then, where given: ``path`` reads it as JSON, ``pattern`` takes its first
    capture, ``most`` its first characters; a rule with ``unless`` counts on pages without that selector only. A blank text is none.
    The first text counts; of amounts, the first that is not zero. Without a ``required`` field there is no record.
    ``setting``: amounts = suffix, text = spaced.

    Rules are a setting of the job: more than MOST_RULES are refused, as are unknown fields, sources and selectors, and a
    rule without a site. No rules are no sites. Columns besides RULE's are ignored, repeated rules change nothing.
    """
    names = [part.split()[0] for part in RULE.split(", ")]
    rows = rules.select(*names).distinct().limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    known = elements(selectors)
    rows = sorted((_checked(r, known) for r in rows), key=lambda r: (r["site"], r["option"] or 0, r["field"], repr(r)))
    key = (repr(rows), repr(known))
    if key not in _COMPILED:  # the same rules are the same sites, so their expressions are built once
        by_site: dict[str, list[Row]] = defaultdict(list)
        for r in rows:
            by_site[r["site"]].append(r)
        _COMPILED[key] = {name: _compiled(of, known) for name, of in by_site.items()}
    return _COMPILED[key]


def extract_by_rules(pages: DataFrame, rules: DataFrame, selectors: DataFrame,
                     functions: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                     extractors: dict[str, Site] | None = None) -> DataFrame:
    """Records of pages of any mix of sites: those of ``extractors`` (the built ones) and of the rules, which go before one of
    their name.

    ``functions``: for a site, what its records go through besides, as DataFrame to DataFrame. Each of these sites
    is a branch of its own that reads only its pages.
    """
    every, own = (EXTRACTORS if extractors is None else extractors) | sites(rules, selectors), functions or {}
    unknown = sorted(set(own) - set(every))
    if unknown:
        raise ValueError(f"functions for sites without an extractor: {unknown}")
    at = F.col("source_site")
    out = extract_listings(pages.filter(~F.coalesce(at.isin(*own), F.lit(False))) if own else pages, every)
    for name, change in own.items():
        out = out.unionByName(extract_listings(pages.filter(at == name), {name: every[name]}).transform(change), allowMissingColumns=True)
    return out
