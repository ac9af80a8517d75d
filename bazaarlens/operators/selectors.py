"""Element selection over an outline and its inverted index, written as Spark SQL array expressions.

``E("div", cls="card") >> E("a", cls="title")`` reads "an ``a.title`` inside a ``div.card``".
Candidates come from the postings of a page's tags, class names and attribute names, the shortest lists
meeting first; only candidates are looked at, never all nodes. The functions return SQL text over the outline's
columns; a ``node`` argument is the name of a node column or lambda variable. Results come in document order.

``selector_array`` makes selectors from rows of a table, and ``matches`` interprets them.
"""
from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.text import WHITE_SPACE, strip

_NONE = "CAST(array() AS array<int>)"


def quoted(value: str) -> str:
    """A text as it stands between the quotes of a SQL literal."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _named(test: str) -> str:
    """Nodes with a class name that passes the test."""
    return f"array_sort(array_distinct(flatten(map_values(map_filter(class_index, (k, v) -> {test})))))"


@dataclass(frozen=True)
class E:
    """One element test. Several ``tag``s mean any of them; ``cls`` lists class names that must all be there."""

    tag: str | tuple[str, ...] | None = None
    cls: str = ""
    class_part: str = ""                                                  # substring of the class attribute
    class_regex: str = ""                                                 # pattern found in a class name
    attrs: dict[str, str] = field(default_factory=dict, hash=False)       # exact values
    attr_parts: dict[str, str] = field(default_factory=dict, hash=False)  # substrings
    attr_starts: dict[str, str] = field(default_factory=dict, hash=False)  # prefixes
    attr_ends: dict[str, str] = field(default_factory=dict, hash=False)   # suffixes
    has_attr: str = ""
    inside: E | None = None

    def __rshift__(self, other: E) -> E:
        return replace(other, inside=self)

    def postings(self) -> str:
        """Nodes that have all names, by idx."""
        lists = [f"class_index['{quoted(name)}']" for name in self.cls.split()]
        if self.class_part:  # a part with a space goes over the end of a name
            lists.append("attr_index['class']" if " " in self.class_part else _named(f"contains(k, '{self.class_part}')"))
        if self.class_regex:
            lists.append(_named(f"k RLIKE '{quoted(self.class_regex)}'"))
        named = dict.fromkeys([*self.attrs, *self.attr_parts, *self.attr_starts, *self.attr_ends, *([self.has_attr] if self.has_attr else [])])
        lists += [f"attr_index['{quoted(k)}']" for k in named]
        if isinstance(self.tag, str):
            lists.append(f"tag_index['{quoted(self.tag)}']")
        elif self.tag is not None:
            lists.append(f"array_sort(concat({', '.join(f"coalesce(tag_index['{t}'], {_NONE})" for t in self.tag)}))")
        if not lists:
            return "filter(sequence(0, size(nodes)), i -> i < size(nodes))"
        found = lists[0]
        for other in lists[1:]:
            found = f"array_intersect({found}, {other})"
        return f"coalesce({found}, {_NONE})"

    def found(self, within: str | None = None) -> str:
        """Matching nodes by idx; ``within`` names a node they have to be below."""
        out, node = self.postings(), "get(nodes, i)"
        tests = [f"contains({node}.cls, '{self.class_part}')"] if " " in self.class_part else []
        tests += [f"{node}.attrs['{quoted(k)}'] = '{quoted(v)}'" for k, v in self.attrs.items()]
        for test, wanted in (("contains", self.attr_parts), ("startswith", self.attr_starts), ("endswith", self.attr_ends)):
            tests += [f"{test}({node}.attrs['{quoted(k)}'], '{quoted(v)}')" for k, v in wanted.items()]
        if within:
            tests.insert(0, f"i > {within}.idx AND i <= {within}.last")
        if tests:
            out = f"filter({out}, i -> {' AND '.join(tests)})"
        if self.inside is not None:
            out = let(regions(self.inside.found(within)), "rg", f"filter({out}, i -> {in_regions('i', 'rg')})")
        return out


def regions(found: str) -> str:
    """What lies below the nodes: disjoint intervals (lo, hi] in order. Nested nodes are in the outermost one's."""
    return (f"aggregate({found}, CAST(array() AS array<struct<lo: int, hi: int>>), (kept, i) -> if(size(kept) > 0 AND "
            "try_element_at(kept, -1).hi >= i, kept, concat(kept, array(named_struct('lo', i, 'hi', get(nodes, i).last)))))")


def last_where(name: str, test: str) -> str:
    """Place of the last element of the array column ``name`` that passes ``test`` (over ``{x}``), by halving steps; -1 if
    none does. Those that pass must come first."""
    halves = f"transform(sequence(CAST(floor(log2(greatest(size({name}), 1))) AS int), 0, -1), e -> shiftleft(1, e))"
    return f"aggregate({halves}, -1, (p, step) -> if(coalesce({test.format(x=f'get({name}, p + step)')}, false), p + step, p))"


def in_regions(i: str, found: str) -> str:
    """Whether idx ``i`` lies in one of the intervals: in the last one that starts before it."""
    return f"coalesce(get({found}, {last_where(found, '{x}.lo < ' + i)}).hi >= {i}, false)"


def nearest_above(stop: str) -> str:
    """For every node the nearest node that passes ``stop`` (over ``n``), itself or above it, by idx; -1 if none does.

    Pointers to parents that end at such nodes are followed by doubling: as many rounds as the page's size has bits.
    """
    start = f"transform(nodes, n -> if({stop}, n.idx, n.parent))"
    rounds = "sequence(1, CAST(ceil(log2(size(nodes) + 2)) AS int))"
    return f"aggregate({rounds}, {start}, (up, r) -> transform(up, p -> if(p < 0, -1, get(up, p))))"


def below(node: str) -> str:
    """All descendants of a node."""
    return f"slice(nodes, {node}.idx + 2, {node}.last - {node}.idx)"


def found_of(*options: E, within: str | None = None) -> str:
    """Every element matching one of the options, by idx."""
    every = [o.found(within) for o in options]
    return every[0] if len(every) == 1 else f"array_sort(array_distinct(concat({', '.join(every)})))"


def all_of(*options: E, within: str | None = None) -> str:
    """Every element matching one of the options."""
    return f"transform({found_of(*options, within=within)}, i -> get(nodes, i))"


def first(*options: E, within: str | None = None) -> str:
    return f"get(nodes, get({found_of(*options, within=within)}, 0))"


def first_of(*options: E, within: str | None = None) -> str:
    """First element of the first option that matches anything."""
    return f"coalesce({', '.join(first(o, within=within) for o in options)})" if len(options) > 1 else first(
        *options, within=within)


# --- selectors as rows ------------------------------------------------------------
#: A row is one step of a selector: the steps by number, the outermost ancestor first. Each of its tests may be NULL.
STEP = "selector string, step int, tag string, classes string, class_regex string, attr string, op string, value string"
_STEPS = "array<struct<selector: string, path: array<struct<tag: string, classes: array<string>, class_regex: string, attr: string, op: string, value: string>>>>"
_OPS = ("=", "*=", "^=", "$=")
MOST_STEPS = 10_000


def _paths(rows: DataFrame) -> dict[str, list]:
    """The steps of each selector of a table, the outermost first."""
    names = [part.split()[0] for part in STEP.split(", ")]
    steps = rows.select(*names).limit(MOST_STEPS + 1).collect()
    if len(steps) > MOST_STEPS:
        raise ValueError(f"more than {MOST_STEPS} selector steps")
    paths: dict[str, list] = defaultdict(list)
    for r in sorted(steps, key=lambda r: r["step"]):
        if r["op"] is not None and (r["op"] not in _OPS or r["attr"] is None or r["value"] is None):
            raise ValueError(f"selector {r['selector']}: an attribute, one of {_OPS} and a value belong together")
        paths[r["selector"]].append({"tag": r["tag"], "classes": (r["classes"] or "").split(), **{k: r[k] for k in ("class_regex", "attr", "op", "value")}})
    return paths


def selector_array(rows: DataFrame) -> Column:
    """The selectors of a table with the columns of STEP, as one constant array.

    ``classes`` are names that must all be there, ``class_regex`` is searched for in single class names, ``attr`` alone
    asks for presence, with ``op`` (=, *=, ^=, $=) for its ``value``. A step without any test matches every element.
    Selectors are a setting of the job: more than MOST_STEPS rows are refused, as is an unknown ``op``.
    """
    return F.from_json(F.lit(json.dumps([{"selector": k, "path": v} for k, v in _paths(rows).items()])), _STEPS)


def elements(rows: DataFrame) -> dict[str, E]:
    """The selectors of such a table by name, each as an element test of its own."""
    tests = {"=": "attrs", "*=": "attr_parts", "^=": "attr_starts", "$=": "attr_ends"}
    out: dict[str, E] = {}
    for name, path in _paths(rows).items():
        chain = None
        for c in path:
            attr = {} if c["attr"] is None else {"has_attr": c["attr"]} if c["op"] is None else {tests[c["op"]]: {c["attr"]: c["value"]}}
            one = E(c["tag"], " ".join(c["classes"]), class_regex=c["class_regex"] or "", **attr)
            chain = one if chain is None else chain >> one
        out[name] = chain
    return out


def _step(c: str) -> str:
    """Nodes that one step matches, whatever is around them."""
    lists = [
        f"if(size({c}.classes) = 0, NULL, aggregate({c}.classes, CAST(NULL AS array<int>), (met, k) -> if(met IS NULL, "
        f"coalesce(class_index[k], {_NONE}), array_intersect(met, coalesce(class_index[k], {_NONE})))))",
        f"if({c}.class_regex IS NULL, NULL, {_named(f'rlike(k, {c}.class_regex)')})",
        f"if({c}.attr IS NULL, NULL, coalesce(attr_index[{c}.attr], {_NONE}))",
        f"if({c}.tag IS NULL, NULL, coalesce(tag_index[{c}.tag], {_NONE}))"]
    met = (f"aggregate(array({', '.join(lists)}), CAST(NULL AS array<int>), "
           "(met, x) -> if(met IS NULL, x, if(x IS NULL, met, array_intersect(met, x))))")
    every = "filter(sequence(0, size(nodes)), i -> i < size(nodes))"
    value = f"get(nodes, i).attrs[{c}.attr]"
    test = (f"CASE {c}.op WHEN '=' THEN {value} = {c}.value WHEN '*=' THEN contains({value}, {c}.value) "
            f"WHEN '^=' THEN startswith({value}, {c}.value) WHEN '$=' THEN endswith({value}, {c}.value) ELSE true END")
    return f"filter(coalesce({met}, {every}), i -> {test})"


def matches(selector: str) -> str:
    """Nodes that a selector of ``selector_array`` matches, by idx."""
    inside = let(regions("before"), "rg", f"filter(here, i -> {in_regions('i', 'rg')})")
    both = let(_step("c"), "here", f"if(before IS NULL, here, {inside})")
    return f"aggregate({selector}.path, CAST(NULL AS array<int>), (before, c) -> {both})"


def let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once under a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def stripped_sql(text: str) -> str:
    return f"btrim({text}, '{WHITE_SPACE}')"


def _pieces(node: str) -> str:
    return f"slice(strings, {node}.s0 + 1, {node}.s1 - {node}.s0)"


def text(node: str) -> str:
    """Text of a node as it stands; NULL when there is no node."""
    return f"array_join({_pieces(node)}, '')"


def stripped(node: str) -> str:
    return stripped_sql(text(node))


def spaced(node: str) -> str:
    """Stripped non-empty pieces joined by a space."""
    return f"array_join(filter(transform({_pieces(node)}, s -> {stripped_sql('s')}), s -> s <> ''), ' ')"


def packed(node: str) -> str:
    """Stripped pieces joined by nothing."""
    return f"array_join(transform({_pieces(node)}, s -> {stripped_sql('s')}), '')"


def text_of(*options: E) -> Column:
    """Stripped text of the first element of an ordered selector list."""
    return F.expr(let(first_of(*options), "x", stripped("x")))


def attr_of(attr: str, *options: E) -> Column:
    """Attribute of the first element found."""
    return F.expr(f"{first_of(*options)}.attrs['{attr}']")


def page_text(strings: Column) -> Column:
    return F.array_join(strings, "")


def spaced_text(strings: Column) -> Column:
    return F.array_join(F.filter(F.transform(strings, strip), lambda s: s != ""), " ")
