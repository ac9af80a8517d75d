"""Outlines, extraction, cards and the crawl on small literal pages."""
import random
import re
import time
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Row, functions as F


from bazaarlens import fixed_values as fv
from bazaarlens.functions.text import strip
from bazaarlens.operators import cards, extract, frontier, quality, report
from bazaarlens.operators.selectors import E, all_of, spaced_text, stripped, stripped_sql, text_of
from bazaarlens.plans import catalog
from bazaarlens.session import cut
from bazaarlens.sources import html
from bazaarlens.sources.html import _Outline, _bounded, flatten_pages


def outline(spark, *pages, **extra):
    rows = [Row(page_id=n, html=h, **extra) for n, h in enumerate(pages)]
    kinds = "".join(f", {k} string" for k in extra)
    return flatten_pages(spark.createDataFrame(rows, "page_id int, html string" + kinds))


def texts(df, *options):
    return [r[0] for r in df.select(F.expr(f"transform({all_of(*options)}, n -> {stripped('n')})")).collect()]


def test_malformed_markup(spark):
    df = outline(spark, "<div><p>one<b>two<p>three</div><ul><li>a<li>b</ul><img><br>tail &amp; &nbsp;end", None)
    assert df.count() == 1  # a page without HTML drops out
    assert texts(df, E("p")) == [["onetwo", "three"]]
    assert texts(df, E("li")) == [["a", "b"]]
    assert df.select(spaced_text(F.col("strings"))).first()[0] == "one two three a b tail & \xa0end"


def test_output_batches_are_bounded_and_whole():
    sizes = [3_000_000, 6_000_000, 20_000_000, 1, 1] + [1] * 600
    runs = list(_bounded(["x" * n for n in sizes]))
    assert [a for a, _ in runs][0] == 0 and all(b == c for (_, b), (c, _) in zip(runs, runs[1:])) and runs[-1][1] == len(sizes)
    assert runs[:3] == [(0, 1), (1, 2), (2, 3)] and max(b - a for a, b in runs) == 256
    assert list(_bounded([])) == []


def test_scripts_and_comments_are_not_text(spark):
    df = outline(spark, "<title>t</title><script>var a='<p>no</p>';</script><style>p{}</style><!-- c -->x")
    assert df.select(spaced_text(F.col("strings"))).first()[0] == "t x"
    assert df.select(F.expr("nodes[1].raw")).first()[0] == "var a='<p>no</p>';"


def test_selectors(spark):
    df = outline(spark, """<div class="a b"><div class="a"><i class="x">1</i></div><i>2</i></div><i class="x y" data-k="pq">3</i>""")
    assert texts(df, E("div", cls="a") >> E("i")) == [["1", "2"]]  # nested ancestors give no duplicates
    assert texts(df, E("div", cls="a") >> E("div") >> E("i")) == [["1"]]
    assert texts(df, E(cls="y x")) == [["3"]]
    assert texts(df, E(class_part="x ")) == [["3"]]
    assert texts(df, E(attr_ends={"data-k": "q"})) == [["3"]]
    assert texts(df, E("i", cls="y"), E("div", cls="b")) == [["12", "3"]]  # document order, not option order
    assert df.select(text_of(E("b"), E("i", cls="y"))).first()[0] == "3"


def listing(spark, site, html, url="https://x/1"):
    df = spark.createDataFrame([(site, url, html)], "source_site string, listing_url string, html string")
    rows = extract.extract_listings(df).collect()
    return rows[0] if rows else None


def test_empireflippers_literal_expectation(spark):
    row = listing(spark, "EmpireFlippers", """<h1>L</h1><div class="info-price">Listing Price <b>$649,354</b></div>
        <p>Avg. Monthly Profit $16,234</p><p>Avg. Monthly Revenue $86,589</p>""")
    assert (row.price, row.cash_flow, row.revenue) == (649354.0, 194808.0, 1039068.0)


def test_bizbuysell_literal_expectation(spark):
    row = listing(spark, "BizBuySell", """<h1>Liquor Store</h1><div class="financials">
        <p><span class="title">Asking Price:</span> $135,000</p><p><span class="title">Cash Flow (SDE):</span> $88,000</p>
        <p><span class="title">Gross Revenue:</span> $285,000</p><p><span class="title">Established:</span> 1999</p></div>""")
    assert (row.price, row.cash_flow, row.revenue, row.established_year) == (135000.0, 88000.0, 285000.0, 1999)


def test_bizbuysell_price_keeps_the_first_usable_row(spark):
    row = listing(spark, "BizBuySell", """<div class="financials"><p><span class="title">Asking Price</span> n/a</p>
        <p><span class="title">Asking Price</span> $5k</p><p><span class="title">Asking Price</span> $9k</p></div>""")
    assert row.price == 5000.0


def test_last_label_row_wins_even_when_unreadable(spark):
    row = listing(spark, "WebsiteClosers", """<h1>T</h1><div class="sb-table">
        <div class="line"><div class="left">Cash Flow</div><div class="right">$1</div></div>
        <div class="line"><div class="left">Cash Flow</div><div class="right">n/a</div></div></div>""")
    assert row.cash_flow is None


def test_pages_without_title_give_no_record(spark):
    assert listing(spark, "WebsiteClosers", "<h1> </h1>") is None
    assert listing(spark, "FEInternational", "<p>x</p>") is None
    assert listing(spark, "QuietLight", "<p>x</p>").title == "Title not found"
    assert listing(spark, "Unknown", "<h1>x</h1>") is None


def test_accepting_offers_is_zero(spark):
    row = listing(spark, "QuietLight", """<div class="inform_price single_business_price"><h4>Asking Price: Accepting Offers</h4></div>""")
    assert (row.price, row.multiple) == (0.0, None)


def test_a_new_site_is_one_more_entry(spark):
    site = extract.Site(lambda at: {"title": at.picks["title"], "price": at.picks["cost"]},
                        {"title": extract.pick(E("h6")), "cost": extract.pick(E("b"))})
    df = spark.createDataFrame([("New", "u", "<h6>N</h6><b>$3k</b>"), ("Flippa", "f", "<h1>F</h1>")],
                               "source_site string, listing_url string, html string")
    rows = {r.source_site: r for r in extract.extract_listings(df, extract.EXTRACTORS | {"New": site}).collect()}
    assert (rows["New"].title, rows["New"].price, rows["Flippa"].title) == ("N", 3000.0, "F")


def test_bare_comma_is_a_card_price(spark):
    df = outline(spark, '<div class="listing-card"><h3>T</h3> a, b $5k</div>', source="QuietLight")
    row = cards.extract_cards(df).first()
    assert (row.asking_price, row.asking_price_raw, row.listing_url) == (0.0, ",", None)


def result_pages(spark, rows):
    df = spark.createDataFrame(rows, "source_site string, search_url string, page int, html string")
    pages = cut(frontier.discover_links(flatten_pages(df)))
    kept = frontier.truncate_frontier(frontier.explode_links(pages), pages)
    return sorted((r.page, r.pos, r.url) for r in kept.collect())


def test_crawl_stops_at_a_missing_page(spark):
    link = '<div class="post_item"><a class="post_title" href="/{0}">t</a></div>'
    rows = [("WebsiteClosers", "s", p, link.format(p)) for p in (1, 2, 4)]
    assert [u for _, _, u in result_pages(spark, rows)] == ["https://www.websiteclosers.com/1", "https://www.websiteclosers.com/2"]


def test_crawl_keeps_the_last_page_without_next(spark):
    card = '<div class="listing-card"><a class="listing-card__link" href="/listings/{0}">t</a></div>'
    rows = [("QuietLight", "s", 1, card.format(1) + '<a class="next">'), ("QuietLight", "s", 2, card.format(2)),
            ("QuietLight", "s", 3, card.format(3))]
    assert [p for p, _, _ in result_pages(spark, rows)] == [1, 2]


def test_crawl_without_a_first_page_is_empty(spark):
    assert result_pages(spark, [("WebsiteClosers", "s", 2, '<div class="post_item"><a class="post_title" href="/a"></a></div>')]) == []


def test_spare_links_count_only_when_own_are_old(spark):
    ld = '<script type="application/ld+json">{"about":[{"item":{"url":"https://b/1"}}]}</script>'
    css = '<div class="search-result-card"><a href="/c{0}">x</a></div>'
    rows = [("BizBuySell", "s", p, ld + css.format(p)) for p in (1, 2)]
    assert [u for _, _, u in result_pages(spark, rows)] == ["https://b/1", "https://www.bizbuysell.com/c2"]


def test_keyword_in_context_overlaps_and_edges(spark):
    df = spark.createDataFrame([(1, "fee x Fee\ny"), (2, "none")], "id int, text string")
    rows = quality.keyword_in_context(df, "fee", chars=5).orderBy("pos").collect()
    assert [(r.pos, r.found, r.context) for r in rows] == [(0, "fee", "fee x Fe"), (1, "Fee", "ee x Fee y")]


def test_keyword_in_context_with_a_value_after_it(spark):
    df = spark.createDataFrame([(1, "net profit: $1,200 a month")], "id int, text string")
    row = quality.keyword_in_context(df, "profit", r"[:\s]*\$?[\d,]+", chars=4).first()
    assert (row.found, row.context) == ("profit: $1,200", "net profit: $1,200 a m")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_embedded_json_is_parsed_once(spark):
    bodies = {
        "whole": '{"name":" A ","description":null,"offers":{"price":1250000.50,"availableAtOrFrom":{"address":{"addressLocality":"X","addressRegion":"Y"}}}}',
        "text": '{"name":"B","offers":{"price":"$2,000"}}', "free": '{"name":"C","offers":{}}', "null": '{"name":"D","offers":null}',
        "array": '[{"name":"E"}]', "list": '{"name":"F","offers":[{"price":5}]}', "cut": '{"name":"G"', "tail": '{"name":"H"} x', "empty": "", "none": None,
        "twice": '{"name":"I","name":"J"}', "scalar": '"K"', "long": '{"name":"' + "L" * 300_000 + '","offers":{"price":7}}'}
    df = spark.createDataFrame(list(bodies.items()), "k string, body string").withColumn("json", extract.parsed(F.col("body")))
    f = extract.jsonld_fields(F.col("json"))
    out = df.select("k", *[c.alias(n) for n, c in f.items()])
    assert _plan(out).count("try_parse_json") + _plan(out).count("parseJson") == 1
    got = {r["k"]: tuple(r)[1:] for r in out.collect()}
    assert got["whole"] == (" A ", None, "1250000.5", "X, Y") and got["text"] == ("B", None, "$2,000", None)
    assert got["free"][2] == "0" and got["null"] == ("D", None, None, None) and got["list"][2] == "0" and got["twice"][0] == "J"
    assert got["long"][0] == "L" * 300_000 and got["long"][2] == "7"
    assert all(got[k] == (None,) * 4 for k in ("array", "cut", "empty", "none", "scalar"))
    assert got["tail"][0] == "H"


def test_embedded_listing_is_told_from_other_values(spark):
    at = '{"props":{"pageProps":{"listing":%s}}}'
    rows = [(k, at % v) for k, v in (("some", '{"headline":"T","financialSummary":{"revenue":5e6,"profit":[1]},"foundedIn":2010}'), ("empty", "{}"),
                                     ("null", "null"), ("text", '"t"'), ("list", "[]"))]
    f = extract.nextdata_fields(F.col("json"))
    out = spark.createDataFrame(rows, "k string, body string").withColumn("json", extract.parsed(F.col("body"))).select("k", *[c.alias(n) for n, c in f.items()])
    got = {r["k"]: r for r in out.collect()}
    assert [k for k in got if got[k]["_keep"]] == ["some"]
    assert (got["some"]["title"], got["some"]["established_year"], got["some"]["cash_flow"]) == ("T", "2010", "[1]")
    assert float(got["some"]["revenue"]) == 5e6


def test_links_from_embedded_json_with_odd_entries(spark):
    pages = [("a", '{"about":[{"item":{"url":"u1"}},{"item":{}},{},null,{"item":{"url":null}},{"item":{"url":"u2","x":1}}]}'), ("b", '{"about":{}}'), ("c", "{bad"),
             ("d", '{"about":[]}'), ("e", '{"other":1}')]
    rows = [(k, f'<script type="application/ld+json">{body}</script>') for k, body in pages]
    got = flatten_pages(spark.createDataFrame(rows, "k string, html string")).select("k", frontier.jsonld_links().alias("links")).collect()
    assert {r["k"]: r["links"] for r in got} == {"a": ["u1", "u2"], "b": [], "c": [], "d": [], "e": []}


def test_unreadable_pages_are_marked_and_the_others_come_out(spark):
    df = outline(spark, "<p>a</p><![foo[y]]>", "<h1>good</h1>", "<b>x</b><![ x", source_site="WebsiteClosers", listing_url="u")
    rows = {r.page_id: r.parse_error for r in df.select("page_id", "parse_error").collect()}
    assert rows[1] is None and "AssertionError" in rows[0] and rows[2]
    good = extract.extract_outlines(df).collect()
    assert [(r.page_id, r.title) for r in good] == [(1, "good")]
    both = {r.page_id: r.reject_reason for r in extract.extract_outlines(df, with_rejects=True).collect()}
    assert both[1] is None and all(both[n].startswith("page cannot be read: ") for n in (0, 2))


def test_stray_end_tags_take_linear_time(spark):
    n = 20_000
    for page in ("<div>" * n + "</p>" * n, "<ul>" + "<div>" * n + "<li></li>" * n, "<b>" * n + "<p></p>" * n + "a&amp;" * n):
        start = time.process_time()
        _Outline().outline(page)
        assert time.process_time() - start < 3


def test_an_unreadable_row_leaves_the_one_before_it(spark):
    rows = "".join(f"<li><h6>{a}</h6><p>{b}</p></li>" for a, b in (("Multiple", "3.5"), ("Multiple", "n/a"), ("Revenue", "$5"), ("Revenue", "none")))
    page = f'<h3>t</h3><div class="inform_revenue single_business">{rows}</div>'
    lines = "".join(f'<div class="line"><div class="left">Year Established</div><div class="right">{y}</div></div>' for y in ("1999", "long ago"))
    both = (outline(spark, page, source_site="QuietLight", listing_url="u")
            .unionByName(outline(spark, f'<h1>t</h1><div class="sb-table">{lines}</div>', source_site="WebsiteClosers", listing_url="v")))
    got = {r.listing_url: r for r in extract.extract_outlines(both).collect()}
    assert got["u"].multiple == 3.5 and got["u"].revenue is None and got["v"].established_year == 1999


def test_fixed_values_hold_the_words_they_should():
    assert {"kindle", "audible", "amazon kdp", "amazon affiliate"} <= set(fv.AMAZON_RELATED)
    assert fv.FBA_URL_TERMS == ("amazon", "fba") and (fv.FBA_URL_WEIGHT, fv.ECOMMERCE_WEIGHT, fv.FBA_THRESHOLD) == (2.0, 0.5, 1.0)
    assert fv.ECOMMERCE_TERMS == ("ecommerce", "e-commerce", "online retail")
    assert {"amazon fba", "asin", "private label"} <= set(fv.FBA_KEYWORDS)
    assert fv.YEAR_WINDOW == (1900, 2025) and fv.ESTIMATED_SEARCH_PAGES == 10
    assert fv.BQ_FINANCING == "financing available|seller financing|owner financing|sba"
    assert fv.STOP_ON_NO_NEW == ("BizBuySell", "BizQuest", "Flippa", "WebsiteClosers")
    assert len(fv.SITES) == 9 and fv.SITES[0][1].startswith("https://")


def _line(n):
    return f'<div class="line"><div class="left">Asking Price</div><div class="right"> ${n},500 </div></div>'


def test_plain_pages_are_outlined_quicker_than_the_library_reads_tags():
    pages = ["<!DOCTYPE html><html><body><h1> a </h1>" + "".join(_line(n + k) for k in range(8)) + "</body></html>" for n in range(400)]

    def seconds(read):
        start = time.process_time()
        for page in pages:
            read(page)
        return time.process_time() - start

    def library(page):
        parser = HTMLParser()
        parser.feed(page)
        parser.close()

    assert min(seconds(_Outline().outline) for _ in range(3)) < min(seconds(library) for _ in range(3))


def test_plain_pages_are_read_as_the_library_reads_them(monkeypatch):
    bits = ("<p>", "</p >", '<div class="a  b a">', "</div>", "<LI>", "<ul>", "</ul>", "<br/>", "<div/>", "<a HREF='x&amp;y' b c=\"\">", "</a>", "<!-- x -->",
            "<!---->", "<!DOCTYPE html>", "<script>a < b && '</p>'</script>", "<script></script>", "<style>p{}</style>", "<title>t &amp; u</title>",
            "<template>", "</template>", "a & b &copy; &#65;", "x > y", "\xa0", "<td>", "<tr>", "<table>", "</table>", "<dt>", "<dd>", "<option>",
            "<a href=x>", "<a b='>'>", "<!-- a > b -->", "<!-->", "<a < b>", "</ x>", "<", "<script><!-- </script>", "<textarea><b></textarea>", "<title><b>")
    pick = random.Random(5)
    pages = ["".join(pick.choice(bits) for _ in range(pick.randint(0, 20))) for _ in range(3000)] + list(bits)
    quick = [_Outline().outline(page) for page in pages]
    assert 100 < sum(html._plain_events(page) is not None for page in pages) < len(pages)
    monkeypatch.setattr(html, "_plain_events", lambda page: None)
    assert quick == [_Outline().outline(page) for page in pages]


def test_label_rows_are_evaluated_once(spark):
    rows = catalog.QUERIES["c3_label_value_rows"](spark, "/root/testdata/sf0.001")
    assert "Filter" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_only_some_pages_are_python_texts_at_a_time(monkeypatch):
    pages = pa.RecordBatch.from_arrays([pa.array(["<p>a</p>", None] * 1000), pa.array(range(2000))], names=["html", "k"])
    most = []
    monkeypatch.setattr(html, "_bounded", lambda texts: most.append(len(texts)) or [(0, len(texts))])
    out = [k for batch in html._flatten_batches(iter([pages])) for k in batch.column(0).to_pylist()]
    assert out == list(range(0, 2000, 2)) and max(most) <= 256


def test_fields_that_nobody_reads_are_not_worked_out(spark):
    plan = catalog.QUERIES["c12_require_title"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_got_title" in plan and "_got_price" not in plan and "_raw_price" not in plan


def test_strip_trims_all_white_space_of_unicode(spark):
    white = [c for c in range(0x3100) if re.fullmatch(r"\s", chr(c)) and not 0x1C <= c <= 0x1F]
    texts = [chr(c) + "a" + chr(d) for c in (*white, 0x1C, 0x180E, 0x200B, 0xFEFF) for d in (0x20, 0x2028, 0x200B)] + ["", " \n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert df.filter(~strip(F.col("t")).eqNullSafe(by_pattern) | ~F.expr(stripped_sql("t")).eqNullSafe(by_pattern)).count() == 0
    assert "regexp" not in str(df.select(strip(F.col("t")))._jdf.queryExecution().analyzed())


def test_cells_are_looked_up_once_a_table_not_once_a_row(spark):
    """Every row of a table looked its cells up, and sorted all of the page's, three times."""
    assert extract.CELLS.nodes().count("tag_index['td']") == 1
    rows = "".join(f"<tr><th> L{n} </th><td>v{n}</td></tr><tr><td>lone</td></tr><tr><td>a</td><td>b</td><td>c</td></tr>" for n in range(40))
    html = f"<table><tr><td>other</td><td>table</td></tr></table><table class='listing-data-table'>{rows}</table><td>out</td><td>side</td>"
    pages = flatten_pages(spark.createDataFrame([("x", html)], "site string, html string"))
    got = extract.label_rows(pages, {"x": extract.CELLS}, F.col("site")).select("_rows").first()[0]
    assert [(r.label, r.value) for r in got] == [(f"l{n}", f"v{n}") for n in range(40)]


def test_a_page_laid_out_like_an_earlier_one_is_not_outlined_again(monkeypatch):
    pages = [f'<p class="a">{n}<a href="/{n}">x &amp; {n}</a><script>s&amp;{n}</script><br>' for n in range(300)]
    odd = ["", "plain", "<p", "<div>a<![foo[y]]>", "<script>a<b</script>", "<template>t<b>u</b></template>", "<p>&#1;</p>", "<title>x", "<p class='a  b'>y"]
    every = [page for pair in zip(pages, odd * 40) for page in pair]

    def columns(text):
        one = html._Shapes().arrays([text])
        return [c.to_pylist()[0] for c in one]

    made = []
    add = _Outline.add_events
    monkeypatch.setattr(_Outline, "add_events", lambda self, *a: made.append(1) or add(self, *a))
    shapes, got = html._Shapes(), []
    for at in range(0, len(every), 64):
        got += zip(*[c.to_pylist() for c in shapes.arrays(every[at:at + 64])])
    assert len(made) < len(every) / 2  # 300 pages were one outline
    for text, row in zip(every, got):
        nodes, strings, holders, error = _Outline().outline(text)
        assert [list(n.values()) for n in row[0]] == [[*n[:5], list(n[5].items()), *n[6:]] for n in nodes]
        assert (list(row[1]), list(row[2]), row[3]) == (strings, holders, error)
        assert list(row) == columns(text)


def test_no_generated_method_is_too_long_to_be_compiled(spark):
    """Java only interprets a method of over 8,000 bytes, row for row."""
    debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
    for name in ("h2_sites_from_rules", "f4_site_completeness", "f4_completeness_by_source", "c13_cards_bizquest", "c_listing_quietlight"):
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert df.collect()
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        sizes = [stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size())]
        assert sizes and 0 < min(sizes) and max(sizes) <= 8000, (name, sizes)


def test_a_worker_returns_only_what_a_query_reads_of_an_outline(spark):
    """Spark copies every column that a worker returns into rows, and asks value by value for NULLs that can't be there."""
    for name, unread in (("i12_container_text", ("class_index", "string_nodes", "parse_error")), ("c13_cards_bizquest", ("string_nodes", "parse_error")),
                         ("c_listing_websiteclosers", ("string_nodes",)), ("c_listing_quietlight", ("string_nodes",))):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        returned = re.search(r"MapInArrow .*", plan)[0]
        assert "nodes#" in returned and not any(f"{c}#" in returned for c in unread), (name, returned)
    nodes = flatten_pages(spark.createDataFrame([("<p>a",)], "html string"), ("nodes",), ("idx", "tag")).schema["nodes"]
    assert nodes.dataType.elementType.fieldNames() == ["idx", "tag"] and not nodes.nullable and not nodes.dataType.containsNull


def test_wanted_columns_are_those_of_the_whole_outline(spark):
    pages = ['<p class="a b">x<a href="/1">1 &amp; 2</a><script>s > 1 && "<"</script>', "plain > text", "<p", "", "a > b < c", "<div>a<![foo[y]]>", "<p>q"]
    df = spark.createDataFrame(list(enumerate(pages * 3)), "k int, html string")
    some, fields = ("nodes", "strings", "attr_index"), ("idx", "parent", "attrs", "raw")
    got = {r.k: r for r in flatten_pages(df, some, fields).collect()}
    for whole in flatten_pages(df).collect():
        part = got[whole.k]
        assert part.asDict().keys() == {"k", *some} and part.strings == whole.strings and part.attr_index == whole.attr_index
        assert [tuple(n) for n in part.nodes] == [tuple(n[f] for f in fields) for n in whole.nodes]


def test_names_of_fields_are_not_compared_one_by_one(spark):
    """Completeness looked every field up in the list of names, and asked for the site by its name in every column."""
    plan = catalog.QUERIES["f4_completeness_by_source"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and plan.count("= FEInternational)") == 1
    rows = spark.createDataFrame([("x", 0.0, None, ["title", "price", "city", "gone"]), ("", 2.0, "y", ["title", "city"]), ("x", 1.0, "y", []), (None, None, None, None)],
                                 "title string, price double, city string, emitted array<string>")
    got = report.record_completeness(rows).select("filled_fields", "total_fields").collect()
    assert [tuple(r) for r in got] == [(1, 4), (1, 2), (0, 0), (None, None)]
