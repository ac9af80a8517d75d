"""Selectors over the inverted index, as expressions and as rows, against a plain walk over the nodes."""
import random
import re

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import quality
from bazaarlens.operators.selectors import STEP, E, all_of, first, selector_array
from bazaarlens.sources.html import _Outline, flatten_pages

TAGS, CLASSES = ("div", "section", "p", "a", "ul", "li", "span"), ("card", "price-box", "a", "Price", "x9")


def _html(draw, depth=0):
    out = []
    for _ in range(draw.randint(0, 4 if depth < 4 else 1)):
        tag = draw.choice(TAGS)
        cls = " ".join(draw.sample(CLASSES, draw.randint(0, 2)))
        href = draw.choice(["", ' href="/listing/7"', ' href="https://x.example/item"', " href"])
        out.append(f'<{tag}{f" class={chr(34)}{cls}{chr(34)}" if cls else ""}{href}>t{draw.randint(0, 9)}{_html(draw, depth + 1) if depth < 6 else ""}</{tag}>')
    return "".join(out)


def _pages():
    draw = random.Random(3)
    return [""] + ["<br>", "just text"] + [f"<html><body>{_html(draw)}</body></html>" for _ in range(60)]


def _step(node, tests):
    names, attrs = node[4].split(), node[5]
    value = attrs.get(tests.get("attr"))
    ops = {"=": lambda v, w: v == w, "*=": lambda v, w: w in v, "^=": str.startswith, "$=": str.endswith}
    return ((tests.get("tag") in (None, node[3])) and all(c in names for c in (tests.get("classes") or "").split())
            and ("class_regex" not in tests or any(re.search(tests["class_regex"], c) for c in names))
            and ("attr" not in tests or value is not None) and ("op" not in tests or ops[tests["op"]](value, tests["value"])))


def _walk(html, path):
    nodes = _Outline().outline(html)[0]
    out = []
    for node in nodes:
        chain, up = [], node[2]
        while up >= 0:
            chain.append(nodes[up])
            up = nodes[up][2]
        at, ok = len(path) - 2, _step(node, path[-1])
        for above in chain:
            if at >= 0 and _step(above, path[at]):
                at -= 1
        if ok and at < 0:
            out.append(node[0])
    return out


PATHS = {
    "all": [{}], "div": [{"tag": "div"}], "two": [{"classes": "a card"}], "regex": [{"class_regex": "(?i)^price"}], "has": [{"attr": "href"}],
    "part": [{"tag": "a", "attr": "href", "op": "*=", "value": "/listing/"}], "start": [{"attr": "href", "op": "^=", "value": "https"}],
    "end": [{"attr": "href", "op": "$=", "value": "7"}], "same": [{"attr": "href", "op": "=", "value": ""}], "none": [{"tag": "table"}],
    "div a": [{"tag": "div"}, {"tag": "a"}], "div div": [{"tag": "div"}, {"tag": "div"}],
    "deep": [{"class_regex": "ar"}, {"tag": "div"}, {"classes": "Price"}], "div *": [{"tag": "div"}, {}],
}


@pytest.fixture(scope="module")
def outlines(spark):
    rows = [(i, h) for i, h in enumerate(_pages())]
    return flatten_pages(spark.createDataFrame(rows, "page int, html string").repartition(3)).cache()


def _table(spark, paths):
    names = [part.split()[0] for part in STEP.split(", ")]
    rows = [[({"selector": n, "step": k} | t).get(c) for c in names] for n, path in paths.items() for k, t in enumerate(path)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, STEP)


def test_selectors_as_rows(spark, outlines):
    found = {(r["page"], r["selector"]): r["found"] for r in quality.selector_matches(outlines, _table(spark, PATHS)).collect()}
    want = {(i, n): idx for i, h in enumerate(_pages()) for n, path in PATHS.items() if (idx := _walk(h, path))}
    assert found == want
    counts = {r["selector"]: (r["pages"], r["matches"]) for r in quality.selector_coverage(outlines, _table(spark, PATHS)).collect()}
    assert counts == {n: (sum(k[1] == n for k in want), sum(len(v) for k, v in want.items() if k[1] == n)) for n in PATHS if any(k[1] == n for k in want)}


def test_selectors_as_expressions(spark, outlines):
    some = {"div": E("div"), "two": E(cls="a card"), "regex": E(class_regex="(?i)^price"), "has": E(has_attr="href"), "none": E("table"),
            "part": E("a", attr_parts={"href": "/listing/"}), "end": E(attr_ends={"href": "7"}), "same": E(attrs={"href": ""}),
            "div a": E("div") >> E("a"), "div div": E("div") >> E("div"), "deep": E(class_regex="ar") >> E("div") >> E(cls="Price"), "all": E()}
    rows = outlines.select("page", *[F.expr(f"transform({all_of(e)}, n -> n.idx)").alias(n) for n, e in some.items()],
                           F.expr(f"{first(some['div'])}.idx").alias("_first")).collect()
    for r in rows:
        for n in some:
            assert r[n] == _walk(_pages()[r["page"]], PATHS[n]), (r["page"], n)
        assert r["_first"] == (r["div"] or [None])[0]


def test_selector_tables_that_are_refused(spark):
    for row in ({"attr": "a", "op": "~=", "value": "x"}, {"op": "=", "value": "x"}, {"attr": "a", "op": "="}):
        with pytest.raises(ValueError):
            selector_array(_table(spark, {"bad": [row]}))
    with pytest.raises(ValueError):
        selector_array(spark.range(10_001).selectExpr("CAST(id AS string) AS selector", "0 AS step", *(
            f"CAST(NULL AS string) AS {c}" for c in ("tag", "classes", "class_regex", "attr", "op", "value"))))
    assert quality.selector_coverage(flatten_pages(spark.createDataFrame([("<p>",)], "html string")), _table(spark, {}).limit(0)).count() == 0


def test_containers_of_a_deep_page_take_linear_time(spark):
    depth = 25_000
    html = "".join(f"<div>${i}" if i % 2 else "<div>" for i in range(depth)) + '<a href="/x">x</a><b>$1</b>'
    outline = flatten_pages(spark.createDataFrame([(0, html)], "page int, html string"))
    rows = quality.price_link_containers(outline).collect()
    assert len(rows) == depth // 2 and {r["href"] for r in rows} == {"/x"} and sum(r["n_prices"] for r in rows) == depth // 2 + 1
    boxes = quality.container_text(outline, E("a"), {}).collect()
    assert [(r["container"], r["text"]) for r in boxes] == [("div", f"${depth - 1} x $1")]


def test_containers_stop_at_the_body(spark):
    html = '<html><head><a href="/h">h</a></head><body>$1<p>$2</p><div><a>no href</a><i>$3</i></div><td>$4<a href="">e</a></td></body></html>'
    rows = quality.price_link_containers(flatten_pages(spark.createDataFrame([(html,)], "html string"))).collect()
    assert [(r["container"], r["n_prices"], r["href"]) for r in rows] == [("td", 1, "")]
    text = quality.price_link_containers(flatten_pages(spark.createDataFrame([("<p>$1 <a href=1>a</a>",)], "html string")), with_text=True)
    assert [r["text"] for r in text.collect()] == ["$1 a"]


def test_definitions_of_nested_lists(spark):
    html = "<dl><dt>a<dl><dt>b<dd>c</dl><dt>d<dd>e<dd>f</dl><dl><dt>g</dl><dl><dd>h</dl>"
    rows = quality.definition_pairs(flatten_pages(spark.createDataFrame([(html,)], "html string"))).collect()
    assert [(r["label"], r["value"]) for r in rows] == [("abc", "e"), ("b", "c"), ("d", "e")]
