"""Registered checks of page parsing, extraction, cards and page quality (A2, B4-B6, C, H1, I)."""
from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.operators import cards, extract, frontier, quality, report, site_rules
from bazaarlens.operators.selectors import STEP, E, all_of, attr_of, first, let, spaced_text, text, text_of
from bazaarlens.plans import ingest, inputs as i, page_inputs as p
from bazaarlens.plans.functions_catalog import LISTINGS, _FACTS, _sql_category
from bazaarlens.plans.registry import query, table
from bazaarlens.plans.tables_catalog import PRICED, priced_listings
from bazaarlens.session import cut, fresh_path, own
from bazaarlens.sources import runlog, store
from bazaarlens.sources.html import flatten_pages
from bazaarlens.streaming.incremental import incremental_ingest

C = F.col


def _outlines(spark, sf_dir, sql, *wanted):
    return flatten_pages(i.bind(spark, sf_dir, sql, spread=True), *wanted)


def _page_outlines(spark, sf_dir):
    return flatten_pages(table(spark, sf_dir, "pages"))


# --- A2, B4 on the captured pages ---------------------------------------------------
def _unescaped(x):
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _between(start, end):
    return _unescaped(f"regexp_extract(html, '(?s){start}(.*?){end}', 1)")


_PLAIN = r"regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '<x>', 'g')"
_PIECES = rf"list_transform(string_split_regex({_PLAIN}, '<[^>]*>'), lambda s: trim(s, ' ' || chr(10) || chr(13) || chr(9)))"


@query("a2_flatten_pages", f"""SELECT page_id, md5({_unescaped(f"array_to_string(list_filter({_PIECES}, lambda s: s <> ''), ' ')")}) AS text_md5,
  {_between('<title>', '</title>')} AS title, {_between('<h1>', '</h1>')} AS h1,
  CAST(length(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_paragraphs, CAST(length(regexp_extract_all(html, '<a href')) AS INTEGER) AS n_links,
  regexp_extract(html, '<script>(.*?)</script>', 1) AS script FROM pages""")
def a2(spark, sf_dir):
    return _page_outlines(spark, sf_dir).select(
        "page_id", F.md5(spaced_text(C("strings")).cast("binary")).alias("text_md5"),
        F.expr(let(first(E("title")), "x", text("x"))).alias("title"), F.expr(let(first(E("h1")), "x", text("x"))).alias("h1"),
        F.expr(f"size({all_of(E('p'))})").alias("n_paragraphs"), F.expr(f"size({all_of(E('nav') >> E('a'))})").alias("n_links"),
        F.expr(f"{first(E('script'))}.raw").alias("script"))


@query("b4_all_links", f"""SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS href FROM (
  SELECT page_id, regexp_extract_all({_unescaped('html')}, '<a href="([^"]*)"', 1) AS l FROM pages) t""")
def b4(spark, sf_dir):
    return _page_outlines(spark, sf_dir).select("page_id", F.posexplode(frontier.all_links()).alias("pos", "href"))


# --- B4-B6, B9 on results pages -----------------------------------------------------
_RESULT_LINKS = "WITH " + i.cte(p.RESULT_LINKS)


def _result_pages(spark, sf_dir, site=None):
    """Results pages with their links; of one site, chosen before anything is parsed."""
    pages = i.bind(spark, sf_dir, p.RESULT_PAGES, spread=True)
    if site:
        pages = pages.filter(C("source_site") == site)
    return frontier.discover_links(flatten_pages(pages)).drop("p_partkey")


@query("b4_site_links", f"""{_RESULT_LINKS} SELECT source_site, search_url, page, spare, url, count(*) AS n
FROM offered GROUP BY ALL""")
def b4_sites(spark, sf_dir):
    pages = cut(_result_pages(spark, sf_dir))
    both = [frontier.links_of(pages, c).withColumn("spare", F.lit(c == "spare")) for c in ("candidates", "spare")]
    return store.union_all_sites(both).groupBy("source_site", "search_url", "page", "spare", "url").agg(F.count("*").alias("n"))


# BizBuySell: a page's own links are new up to page 29, except where page % 4 = 3 has none
_USED = "NOT spare OR page % 4 = 3 OR page >= 30"


@query("b5_jsonld_links", f"""{_RESULT_LINKS} SELECT search_url, page, url, count(*) AS n FROM offered
WHERE source_site = 'BizBuySell' AND ({_USED}) GROUP BY ALL""")
def b5(spark, sf_dir):
    pages = _result_pages(spark, sf_dir, "BizBuySell")
    return frontier.explode_links(cut(pages)).groupBy("search_url", "page", "url").agg(F.count("*").alias("n"))


_SHOP = "https://www.bizbuysell.com/business/"


@query("b5_overlapping_links", f"""WITH RECURSIVE pages AS (SELECT concat('s', p_partkey % 7) AS search_url, p_partkey // 7 + 1 AS page, p_partkey % 2 = 0 AS has_json,
    ['{_SHOP}' || (p_partkey // 7 * 3 % 11) || '/', '{_SHOP}' || (p_partkey // 7 * 7 % 13) || '/'] AS ld,
    ['{_SHOP}' || (p_partkey // 7 * 5 % 17) || '/', '{_SHOP}' || (p_partkey // 7 % 23) || '/'] AS css FROM part),
own AS (SELECT search_url, page, CASE WHEN has_json THEN ld ELSE CAST([] AS VARCHAR[]) END AS own, css FROM pages),
walk AS (SELECT search_url, page, own, css, len(own) = 0 AS spare, CASE WHEN len(own) = 0 THEN css ELSE own END AS seen
    FROM own WHERE page = (SELECT min(page) FROM own o WHERE o.search_url = own.search_url)
  UNION ALL SELECT o.search_url, o.page, o.own, o.css, len(list_filter(o.own, lambda u: NOT list_contains(w.seen, u))) = 0,
    list_distinct(list_concat(w.seen, CASE WHEN len(list_filter(o.own, lambda u: NOT list_contains(w.seen, u))) = 0 THEN o.css ELSE o.own END))
  FROM walk w JOIN own o ON o.search_url = w.search_url AND o.page = w.page + 1),
used AS (SELECT search_url, page, unnest(own) AS url FROM walk UNION ALL SELECT search_url, page, unnest(css) FROM walk WHERE spare)
SELECT search_url, CAST(page AS INTEGER) AS page, url, count(*) AS n FROM used GROUP BY ALL""")
def b5_overlapping(spark, sf_dir):
    """Own and spare links of one URL space: a spare link used earlier makes an own link old."""
    item = "concat('/business/', CAST({} AS STRING), '/')"
    step = "(p_partkey DIV 7)"
    ld = [item.format(f"{step} * 3 % 11"), item.format(f"{step} * 7 % 13")]
    css = [item.format(f"{step} * 5 % 17"), item.format(f"{step} % 23")]
    about = ", ', ', ".join(f"""'{{"item":{{"url":"https://www.bizbuysell.com', {u}, '"}}}}'""" for u in ld)
    cards = ", ".join(f"""'<div class="search-result-card"><a href="', {u}, '">x</a></div>'""" for u in css)
    pages = i.bind(spark, sf_dir, f"""SELECT 'BizBuySell' AS source_site, concat('s', CAST(p_partkey % 7 AS STRING)) AS search_url,
      CAST({step} + 1 AS INT) AS page, concat(CASE WHEN p_partkey % 2 = 0 THEN
      concat('<script type="application/ld+json">{{{{"about":[', {about.replace('{', '{{').replace('}', '}}')}, ']}}}}</script>') ELSE '' END, {cards}) AS html FROM {{part}}""", spread=True)
    links = frontier.explode_links(cut(frontier.discover_links(flatten_pages(pages))))
    return links.groupBy("search_url", "page", "url").agg(F.count("*").alias("n"))


@query("b6_nextdata_links", f"""{_RESULT_LINKS} SELECT search_url, page, url, count(*) AS n FROM offered
WHERE source_site = 'Acquire' GROUP BY ALL""")
def b6(spark, sf_dir):
    pages = _result_pages(spark, sf_dir, "Acquire")
    return frontier.links_of(pages, "candidates").groupBy("search_url", "page", "url").agg(F.count("*").alias("n"))


@query("b9_crawl_result_pages", f"""{_RESULT_LINKS},
limits AS (SELECT source_site, search_url, least(max(page), CASE WHEN source_site IN ('QuietLight', 'WebsiteProperties', 'EmpireFlippers')
    THEN 25 WHEN source_site IN ('Acquire', 'FEInternational') THEN 1 WHEN source_site = 'BizBuySell' THEN 30 ELSE 29 END) AS last_page
  FROM ({i.cte(p.RESULT_KEYS)}) k GROUP BY source_site, search_url)
SELECT source_site, search_url, url, min(page) AS page FROM offered JOIN limits USING (source_site, search_url)
WHERE page <= last_page AND ({_USED}) GROUP BY ALL""")
def b9_crawl(spark, sf_dir):
    pages = cut(_result_pages(spark, sf_dir))
    return frontier.truncate_frontier(frontier.explode_links(pages), pages).drop("pos")


# --- C: extraction ------------------------------------------------------------------
def _listing_pages(spark, sf_dir, site):
    html = p.LISTING_PAGES[site][0]
    return i.bind(spark, sf_dir, html, spread=True).selectExpr(
        f"'{site}' AS source_site", f"{p.LISTING_URL} AS listing_url", "p_partkey", "html")


_COLUMNS = {
    "QuietLight": "title industry description price revenue cash_flow multiple seller_financing",
    "BizBuySell": "title description price revenue cash_flow ebitda location industry established_year",
    "BizQuest": "title price asking_price_raw cash_flow cash_flow_raw profit revenue revenue_raw location city state established_year "
                "description employees inventory_value real_estate_included reason_for_selling financing_available training_provided "
                "category business_type",
    "WebsiteProperties": "title price revenue cash_flow multiple description established_year employees industry location",
    "Flippa": "title description price revenue cash_flow industry",
    "EmpireFlippers": "title price revenue cash_flow multiple industry established_year description",
    "Acquire": "title description price revenue cash_flow multiple established_year industry",
    "FEInternational": "title price revenue cash_flow multiple industry location established_year description",
    "WebsiteClosers": "title description price cash_flow revenue established_year",
}


def _register_site(site):
    _, fields, where = p.LISTING_PAGES[site]
    source = "part"
    if site == "BizQuest":
        source = f"({i.cte(p.BIZQUEST_PARTS)}) t"
        fields += (f", COALESCE({_sql_category(p.BIZQUEST_TEXT)}, 'General') AS category"
                   f", COALESCE({_sql_category(p.BIZQUEST_TEXT)}, 'Business') AS business_type")

    @query(f"c_listing_{site.lower()}", f"SELECT p_partkey, {fields} FROM {source} {where}")
    def run(spark, sf_dir):
        return extract.extract_listings(_listing_pages(spark, sf_dir, site)).select("p_partkey", *_COLUMNS[site].split())


for _site in p.LISTING_PAGES:
    _register_site(_site)


def _mixed_pages(spark, sf_dir):
    pages = i.bind(spark, sf_dir, p.mixed_listing_pages(), spread=True)
    # through a lambda: nine templates in one plain CASE are a method too long for Java to compile
    return pages.selectExpr("source_site", f"{p.LISTING_URL} AS listing_url", "p_partkey", let("html", "page", "page") + " AS html")


def _mixed_sql(columns):
    """The listings of the mixed pages, from the same columns as each site's own check."""
    branches = []
    for n, (site, (_, fields, where)) in enumerate(p.LISTING_PAGES.items()):
        source = f"({i.cte(p.BIZQUEST_PARTS)}) t" if site == "BizQuest" else "part"
        keep = f"{where} AND" if where else "WHERE"
        branches.append(f"SELECT '{site}' AS source_site, {columns} FROM (SELECT p_partkey, {p.LISTING_URL} AS listing_url, {fields} "
                        f"FROM {source} {keep} p_partkey % 9 = {n}) q{n}")
    return " UNION ALL ".join(branches)


_MIXED = "p_partkey, listing_url, title, price, revenue, cash_flow, description"


@query("c_listing_all_sites", _mixed_sql(_MIXED))
def all_sites(spark, sf_dir):
    return extract.extract_listings(_mixed_pages(spark, sf_dir)).select("source_site", *_MIXED.split(", "))


def _named_rows(spark, schema, *rows):
    """A table of the schema from dicts; what a row leaves out is NULL."""
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([[r.get(c) for c in names] for r in rows], schema)


def _rule(site, field, source, selector=None, option=0, **more):
    return {"site": site, "field": field, "source": source, "selector": selector, "option": option} | more


# two sites that the library has no code for; their pages are laid out like those of two that it has
_RULES = (
    _rule("Harbour", "title", "element", "h1", required=True), _rule("Harbour", "description", "element", "text box", most=2000),
    _rule("Harbour", "box", "row", "table"), _rule("Harbour", "row", "row", "line"), _rule("Harbour", "label", "row", "left"),
    _rule("Harbour", "value", "row", "right"), _rule("Harbour", "price", "label", words=["asking price"]),
    _rule("Harbour", "cash_flow", "label", words=["cash", "flow"]), _rule("Harbour", "revenue", "label", words=["gross income"]),
    _rule("Harbour", "established_year", "label", words=["year established"], pattern=r"(\d{4})"),
    _rule("Lagoon", "title", "element", "h1"), _rule("Lagoon", "title", "element", "og title", 1, take="content"),
    _rule("Lagoon", "description", "element", "meta description", take="content"),
    _rule("Lagoon", "description", "element", "og description", 1, take="content"),
    _rule("Lagoon", "price", "element", "price box", take="text", pattern=r"\$([\d,]+)"),
    _rule("Lagoon", "price", "page", option=1, pattern=r"buy it now:\s*\$([\d,]+)", unless="price box"),
    _rule("Lagoon", "revenue", "page", pattern=r"net revenue:\s*\$([\d.,]+k?)"),
    _rule("Lagoon", "cash_flow", "page", pattern=r"(?:cash flow|net profit)\s+\$([\d,]+)"),
    _rule("Lagoon", "industry", "page", pattern=r"niche:\s*([^,]+)"))
_RULE_SELECTORS = (
    ("h1", 0, {"tag": "h1"}), ("text box", 0, {"tag": "div", "classes": "wysiwyg cfx"}), ("table", 0, {"tag": "div", "classes": "sb-table"}),
    ("line", 0, {"tag": "div", "classes": "line"}), ("left", 0, {"tag": "div", "classes": "left"}), ("right", 0, {"tag": "div", "classes": "right"}),
    ("og title", 0, {"tag": "meta", "attr": "property", "op": "=", "value": "og:title"}),
    ("meta description", 0, {"tag": "meta", "attr": "name", "op": "=", "value": "description"}),
    ("og description", 0, {"tag": "meta", "attr": "property", "op": "^=", "value": "og:desc"}),
    ("price box", 0, {"tag": "div", "class_regex": "price"}))
_RULED = "p_partkey, title, description, price, revenue, cash_flow, industry, established_year"


@query("h2_sites_from_rules", f"""
  SELECT 'Harbour' AS source_site, {_RULED} FROM (SELECT p_partkey, CAST(NULL AS VARCHAR) AS industry, {p.WEBSITECLOSERS_FIELDS} FROM part {p.WEBSITECLOSERS_WHERE}) h
  UNION ALL SELECT 'Lagoon', {_RULED} FROM (SELECT p_partkey, CAST(NULL AS INTEGER) AS established_year, {p.FLIPPA_FIELDS} FROM part) l
  UNION ALL SELECT 'QuietLight', {_RULED} FROM (SELECT p_partkey, CAST(NULL AS INTEGER) AS established_year, {p.QUIETLIGHT_FIELDS} FROM part) q""")
def h2_rules(spark, sf_dir):
    """Two sites whose rules are rows of a stored table, next to one that has code."""
    folder = own(fresh_path(spark, "rules"))
    _named_rows(spark, site_rules.RULE, *_RULES).write.parquet(f"{folder}/rules")
    _selectors(spark, *_RULE_SELECTORS).write.parquet(f"{folder}/selectors")
    pages = [_listing_pages(spark, sf_dir, like).withColumn("source_site", F.lit(site))
             for site, like in (("Harbour", "WebsiteClosers"), ("Lagoon", "Flippa"), ("QuietLight", "QuietLight"))]
    rules, selectors = (spark.read.parquet(f"{folder}/{t}") for t in ("rules", "selectors"))
    built = {"QuietLight": extract.EXTRACTORS["QuietLight"]}
    return site_rules.extract_by_rules(store.union_all_sites(pages), rules, selectors, extractors=built).select("source_site", *_RULED.split(", "))


@query("h1_incremental_ingest", f"""SELECT source_site, listing_url, title, price, revenue, cash_flow FROM (
  {_mixed_sql('listing_url, title, price, revenue, cash_flow')}) q""")
def h1(spark, sf_dir):
    """Two capture drops; the second repeats every page of the first, so it must add nothing."""
    folder = fresh_path(spark, "stream")
    name = "bazaarlens_" + folder.rsplit("-", 1)[1]
    pages = _mixed_pages(spark, sf_dir).select(
        C("listing_url").alias("url"), "html", F.lit(False).alias("rendered"),
        F.lit("2024-05-01 02:00:00").cast("timestamp").alias("fetched_at"), "source_site")
    store.create_listings_table(spark, name, f"{folder}/listings")
    for _ in range(2):
        pages.write.mode("append").parquet(f"{folder}/captures")
        incremental_ingest(spark, f"{folder}/captures", name, f"{folder}/progress").awaitTermination()
    return spark.table(name).select("source_site", "listing_url", "title", "price", "revenue", "cash_flow")


_BAD = {"unknown": "p_partkey % 19 = 7", "broken": "p_partkey % 13 = 5", "untimed": "p_partkey % 17 = 3"}


def _awkward_pages(spark, sf_dir):
    """The mixed pages, some with a marked section no parser knows, some without a time, some of an unknown site."""
    return _mixed_pages(spark, sf_dir).select(
        C("listing_url").alias("url"), F.when(F.expr(_BAD["broken"]), F.concat("html", F.lit("<![foo[y]]>"))).otherwise(C("html")).alias("html"),
        F.lit(False).alias("rendered"), F.when(~F.expr(_BAD["untimed"]), F.lit("2024-05-01 02:00:00").cast("timestamp")).alias("fetched_at"),
        F.when(F.expr(_BAD["unknown"]), F.lit("Nowhere")).otherwise(C("source_site")).alias("source_site"))


_SITE_SQL = "CASE p_partkey % 9 " + " ".join(f"WHEN {n} THEN '{site}'" for n, site in enumerate(p.LISTING_PAGES)) + " END"
# a page without a record is neither stored nor rejected; unless it is of an unknown site or can't be read
_AWKWARD = f"""WITH q AS ({_mixed_sql("p_partkey AS k, title")}), judged AS (SELECT {p.LISTING_URL.replace('STRING', 'VARCHAR')} AS listing_url, title,
  CASE WHEN {_BAD['unknown']} THEN 'Nowhere' ELSE {_SITE_SQL} END AS source_site, q.k IS NOT NULL AS has_record, CASE
  WHEN {_BAD['unknown']} THEN 'no extractor for site Nowhere'
  WHEN {_BAD['broken']} THEN 'page cannot be read: AssertionError: unknown status keyword ''foo'' in marked section'
  WHEN {_BAD['untimed']} AND q.k IS NOT NULL THEN 'scraped_at is missing' END AS reject_reason FROM part LEFT JOIN q ON part.p_partkey = q.k)"""


@query("e4_malformed_pages", f"""{_AWKWARD}
SELECT source_site, listing_url, CASE WHEN reject_reason IS NULL THEN title END AS title, reject_reason FROM judged
WHERE has_record OR reject_reason IS NOT NULL""")
def e4_malformed(spark, sf_dir):
    """Good rows and rejects of a stream over awkward pages, dropped twice."""
    folder = fresh_path(spark, "stream")
    name = "bazaarlens_" + folder.rsplit("-", 1)[1]
    store.create_listings_table(spark, name)
    for _ in range(2):
        _awkward_pages(spark, sf_dir).write.mode("append").parquet(f"{folder}/captures")
        incremental_ingest(spark, f"{folder}/captures", name, f"{folder}/progress").awaitTermination()
    good = spark.table(name).select("source_site", "listing_url", "title", F.lit(None).cast("string").alias("reject_reason"))
    bad = spark.table(f"{name}_rejects").select("source_site", "listing_url", F.lit(None).cast("string").alias("title"), "reject_reason")
    return good.unionByName(bad.distinct())  # each drop is a run of its own


@query("f6_ingest_run_log", f"""{_AWKWARD}, asked AS (SELECT unnest(['Silent', 'Nowhere', {", ".join(f"'{s}'" for s in p.LISTING_PAGES)}]) AS site_name),
seen AS (SELECT source_site AS site_name, count(*) AS n, count(reject_reason) AS bad,
  count(*) FILTER (has_record AND reject_reason IS NULL) AS stored FROM judged GROUP BY 1)
SELECT site_name, 'completed' AS status, COALESCE(n, 0) AS total_listings_found, CAST(0 AS BIGINT) AS existing_listings, COALESCE(n, 0) AS new_listings,
  COALESCE(stored, 0) AS successful_scrapes, COALESCE(n - stored, 0) AS failed_scrapes, COALESCE(bad, 0) AS error_count, 10 + COALESCE(n, 0) AS api_calls_made
FROM asked LEFT JOIN seen USING (site_name)""")
def f6_ingest(spark, sf_dir):
    """The log of a whole run over awkward pages, one site asked for having no URL."""
    folder = fresh_path(spark, "run")
    name = "bazaarlens_" + folder.rsplit("-", 1)[1]
    store.create_listings_table(spark, name)
    store.create_log_table(spark, f"{name}_log")
    pages = cut(_awkward_pages(spark, sf_dir))  # captures are a stored table
    found = pages.select("source_site", C("url").alias("listing_url"))
    ingest.ingest_run(spark, "r", found, pages, name, f"{name}_log", F.lit(1), sites=["Silent", "Nowhere", *p.LISTING_PAGES])
    return runlog.current_run_log(spark.table(f"{name}_log")).select(
        "site_name", "status", "total_listings_found", "existing_listings", "new_listings", "successful_scrapes", "failed_scrapes",
        "error_count", "api_calls_made")


@query("c1_first_node_text", """SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_name END AS title FROM part""")
def c1(spark, sf_dir):
    return _outlines(spark, sf_dir, p.FEINTERNATIONAL).select(
        "p_partkey", text_of(E("h1", cls="listing-title"), E("h1"), E("h2", cls="title")).alias("title"))


_LAYOUTS = {"paragraphs": "BizBuySell", "headings": "QuietLight", "cells": "WebsiteProperties", "lines": "WebsiteClosers"}


@query("c3_label_value_rows", """SELECT 'paragraphs' AS layout, p_partkey, 0 AS pos, 'asking price:' AS label, concat('$', p_size, ',500') AS value
    FROM part WHERE p_partkey % 5 <> 2
  UNION ALL SELECT 'paragraphs', p_partkey, 1, 'cash flow (sde):', CASE WHEN p_partkey % 3 = 0 THEN 'Not Disclosed' ELSE concat('$', p_size, ',000') END
    FROM part WHERE p_partkey % 5 <> 2
  UNION ALL SELECT 'paragraphs', p_partkey, 2, 'gross revenue:', concat('$', p_size, ',900') FROM part WHERE p_partkey % 5 <> 2
  UNION ALL SELECT 'paragraphs', p_partkey, 3, 'ebitda:', CASE WHEN p_partkey % 4 = 0 THEN 'Not Disclosed' ELSE concat('$', p_size, '00') END
    FROM part WHERE p_partkey % 5 <> 2
  UNION ALL SELECT 'paragraphs', p_partkey, 4, 'established:', CAST(1950 + p_size AS VARCHAR) FROM part WHERE p_partkey % 5 <> 2
  UNION ALL SELECT 'headings', p_partkey, 0, 'revenue', concat('$', p_size, ',000') FROM part
  UNION ALL SELECT 'headings', p_partkey, 1, 'net income', CASE WHEN p_partkey % 4 = 0 THEN 'n/a' ELSE '$7k' END FROM part
  UNION ALL SELECT 'headings', p_partkey, 2, 'multiple', CASE WHEN p_partkey % 3 = 0 THEN '.' ELSE '3.5' END FROM part
  UNION ALL SELECT 'cells', p_partkey, 0, 'gross revenue', concat('$', p_size, ',000') FROM part
  UNION ALL SELECT 'cells', p_partkey, 1, 'annual cash flow', CASE WHEN p_partkey % 4 = 0 THEN '0' ELSE '$250,000' END FROM part
  UNION ALL SELECT 'cells', p_partkey, 2, 'year established', concat('Since ', 1990 + p_size % 30) FROM part
  UNION ALL SELECT 'cells', p_partkey, 3, 'employees', CASE WHEN p_partkey % 3 = 0 THEN 'none' ELSE concat('about ', p_size, ' people') END FROM part
  UNION ALL SELECT 'cells', p_partkey, 4, 'industry', p_type FROM part
  UNION ALL SELECT 'cells', p_partkey, 5, 'location', 'Austin, TX' FROM part
  UNION ALL SELECT 'lines', p_partkey, 0, 'asking price', concat('$', p_size, ',500') FROM part
  UNION ALL SELECT 'lines', p_partkey, 1, 'cash flow', CASE WHEN p_partkey % 3 = 0 THEN 'N/A' ELSE '$1.5M' END FROM part
  UNION ALL SELECT 'lines', p_partkey, 2, 'gross income', concat('$', p_size, 'mm') FROM part
  UNION ALL SELECT 'lines', p_partkey, 3, 'year established', CASE WHEN p_partkey % 4 = 0 THEN 'in 99' ELSE concat('in ', 1990 + p_size % 30) END FROM part
""")
def c3(spark, sf_dir):
    pages = store.union_all_sites([
        i.bind(spark, sf_dir, p.LISTING_PAGES[site][0], spread=True).withColumn("layout", F.lit(layout))
        for layout, site in _LAYOUTS.items()])
    layouts = {layout: extract.EXTRACTORS[site].layout for layout, site in _LAYOUTS.items()}
    rows = extract.label_rows(flatten_pages(pages), layouts, C("layout"))
    # not a plain column: of one, Spark would infer a filter and evaluate the rows once more for it, below the projections
    return rows.select("layout", "p_partkey", F.posexplode(F.coalesce("_rows", F.array())).alias("pos", "r")).select(
        "layout", "p_partkey", "pos", "r.label", "r.value")


@query("c5_meta_content", """SELECT p_partkey, concat('OG ', p_name) AS og_title, concat('Meta ', p_brand) AS description,
  CASE WHEN p_partkey % 2 = 0 THEN concat('Meta ', p_brand) END AS named FROM part""")
def c5(spark, sf_dir):
    named = E("meta", attrs={"name": "description"})
    return _outlines(spark, sf_dir, p.FLIPPA).select(
        "p_partkey", attr_of("content", E("meta", attrs={"property": "og:title"})).alias("og_title"),
        attr_of("content", named, E("meta", attrs={"property": "og:description"})).alias("description"),
        attr_of("content", named).alias("named"))


@query("c12_require_title", f"""SELECT 'WebsiteClosers' AS source_site, p_partkey, p_name AS title FROM part {p.WEBSITECLOSERS_WHERE}
  UNION ALL SELECT 'FEInternational', p_partkey, p_name FROM part {p.FEINTERNATIONAL_WHERE}""")
def c12(spark, sf_dir):
    pages = store.union_all_sites([_listing_pages(spark, sf_dir, s) for s in ("WebsiteClosers", "FEInternational")])
    return extract.extract_listings(pages).select("source_site", "p_partkey", "title")


_CARD_COLUMNS = ("title listing_url asking_price asking_price_raw cash_flow cash_flow_raw profit profit_raw revenue revenue_raw "
                 "location city state category business_type").split()


def _register_cards(source):
    first, where, fields = p.CARD_FIELDS[source]

    @query(f"c13_cards_{source.lower()}", f"""WITH c AS (SELECT *, CAST(n AS INTEGER) AS j FROM part, range(0, {first}) r(n))
    SELECT p_partkey, j AS card_pos, {fields} FROM c {where}""")
    def run(spark, sf_dir):
        outlines = _outlines(spark, sf_dir, p.CARD_PAGES[source], extract.INDEXED, extract.ELEMENTS).withColumn("source", F.lit(source))
        return cards.extract_cards(outlines).select("p_partkey", "card_pos", *_CARD_COLUMNS)


for _source in p.CARD_PAGES:
    _register_cards(_source)

# --- I: page quality ----------------------------------------------------------------
def _selectors(spark, *rows):
    """A selectors table from (selector, step, {test: value})."""
    return _named_rows(spark, STEP, *({"selector": name, "step": step} | tests for name, step, tests in rows))


_SELECTORS = (
    ("title", 0, {"tag": "title"}), ("h1", 0, {"tag": "h1"}), ("div.ad", 0, {"tag": "div", "classes": "ad"}), ("nav a", 0, {"tag": "nav"}),
    ("nav a", 1, {"tag": "a"}), ("footer", 0, {"tag": "footer"}), ("[class*=a]", 0, {"class_regex": "a"}), ("table", 0, {"tag": "table"}))
_FIRST_TEXT = {
    "title": ("<title>", _between("<title>", "</title>")), "h1": ("<h1>", _between("<h1>", "</h1>")),
    "div.ad": ('<div class="ad">', _between('<div class="ad">', "</div>")),
    "nav a": ("<a href", _between('<a href="[^"]*">', "</a>")), "footer": ("<footer>", _between("<footer>", "</footer>")),
    "[class*=a]": ('class="ad"', _between('<div class="ad">', "</div>")),
}


@query("i1_selector_coverage", "WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS selector, length(regexp_extract_all(html, '{mark}')) AS n, left(trim({text}), 100) AS sample FROM pages"
    for name, (mark, text) in _FIRST_TEXT.items())
    + ") SELECT selector, count(*) AS pages, CAST(sum(n) AS BIGINT) AS matches, min(sample) AS sample FROM s WHERE n > 0 GROUP BY selector")
def i1(spark, sf_dir):
    return quality.selector_coverage(_page_outlines(spark, sf_dir), _selectors(spark, *_SELECTORS))


_SITE_SELECTORS = (
    ("a class with price", 0, {"class_regex": "(?i)PRICE"}), ("meta[content]", 0, {"tag": "meta", "attr": "content"}),
    ("li p", 0, {"tag": "li"}), ("li p", 1, {"tag": "p"}), ("div.financials span.title", 1, {"tag": "span", "classes": "title"}),
    ("div.financials span.title", 0, {"tag": "div", "classes": "financials"}), ("script[type$=json]", 0, {"tag": "script", "attr": "type", "op": "$=", "value": "json"}),
    ("meta[property^=og:]", 0, {"attr": "property", "op": "^=", "value": "og:"}), ("[data-listing-id]", 0, {"attr": "data-listing-id"}),
    ("html body h1", 0, {"tag": "html"}), ("html body h1", 1, {"tag": "body"}), ("html body h1", 2, {"tag": "h1"}))
_SITE_COUNTS = {
    "a class with price": """CASE m WHEN 0 THEN 1 WHEN 1 THEN CAST(p % 5 = 2 AS INT) WHEN 2 THEN CAST(p % 3 = 0 AS INT) WHEN 4 THEN CAST(p % 3 < 2 AS INT)
      WHEN 5 THEN CAST(p % 3 <> 0 AS INT) ELSE 0 END""",
    "meta[content]": "CASE m WHEN 2 THEN CAST(p % 4 = 0 AS INT) WHEN 4 THEN 2 WHEN 5 THEN CAST(p % 4 = 1 AS INT) ELSE 0 END",
    "li p": "CASE m WHEN 0 THEN 3 ELSE 0 END",
    "div.financials span.title": "CASE WHEN m = 1 AND p % 5 <> 2 THEN 5 ELSE 0 END",
    "script[type$=json]": "CASE m WHEN 1 THEN CAST(p % 5 < 2 AS INT) WHEN 6 THEN 1 ELSE 0 END",
    "meta[property^=og:]": "CASE m WHEN 4 THEN 2 - CAST(p % 2 = 0 AS INT) ELSE 0 END",
    "html body h1": """CASE m WHEN 1 THEN 2 WHEN 2 THEN CAST(p % 3 = 0 AS INT) WHEN 4 THEN CAST(p % 4 <> 0 AS INT) WHEN 5 THEN 1 WHEN 6 THEN 1
      WHEN 7 THEN CASE p % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END WHEN 8 THEN CAST(p % 5 > 0 AS INT) ELSE 0 END""",
}


@query("i1_selector_table", "WITH k AS (SELECT p_partkey AS p, p_partkey % 9 AS m FROM part), s AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS selector, {n} AS n FROM k" for name, n in _SITE_COUNTS.items())
    + ") SELECT selector, count(*) AS pages, CAST(sum(n) AS BIGINT) AS matches FROM s WHERE n > 0 GROUP BY selector")
def i1_table(spark, sf_dir):
    """Selectors of all kinds, as rows, over listing pages of nine sites."""
    outlines = flatten_pages(_mixed_pages(spark, sf_dir).select("html"))
    return quality.selector_coverage(outlines, _selectors(spark, *_SITE_SELECTORS)).drop("sample")


@query("f4_site_completeness", p.record_sizes())
def f4_sites(spark, sf_dir):
    """Records of nine sites, each measured by the fields of its own."""
    records = extract.extract_listings(_mixed_pages(spark, sf_dir), with_emitted=True)
    return report.record_completeness(records).select("source_site", "p_partkey", "filled_fields", "total_fields")


@query("f4_completeness_by_source", f"""SELECT source_site, count(*) AS records, CAST(sum(filled_fields) AS BIGINT) AS filled_fields,
  CAST(sum(total_fields) AS BIGINT) AS total_fields, min(filled_fields) AS least_filled, max(filled_fields) AS most_filled
  FROM ({p.record_sizes()}) r GROUP BY source_site""")
def f4_by_source(spark, sf_dir):
    return report.completeness_by_source(extract.extract_listings(_mixed_pages(spark, sf_dir), with_emitted=True))


_SPREAD_FACTS = (f"concat({_FACTS}, CASE seq % 3 WHEN 0 THEN concat(chr(10), 'Cash Flow', chr(10), 'of $', CAST(seq AS STRING), ',500') "
                 "WHEN 1 THEN concat(chr(10), 'SDE', chr(10), 'is $', CAST(seq AS STRING), '; Established: 1999') ELSE '; Gross Revenue: $7,000' END)")


@query("i2_pattern_coverage", f"{LISTINGS}, a AS (SELECT source_site, {_SPREAD_FACTS} AS t FROM listings) " + " UNION ALL ".join(
    f"""SELECT source_site, '{name}' AS pattern, count(nullif(regexp_extract(t, '(?is){rx}', 0), '')) AS n,
    min(nullif(regexp_extract(t, '(?is){rx}', 0), '')) AS sample FROM a GROUP BY source_site""" for name, rx in fv.COVERAGE_PATTERNS.items()))
def i2(spark, sf_dir):
    texts = i.bind(spark, sf_dir, i.RAW_LISTINGS).select("source_site", F.expr(_SPREAD_FACTS).alias("text"))
    return quality.pattern_coverage(texts, fv.COVERAGE_PATTERNS)


@query("i3_all_money_values", f"""{LISTINGS}, a AS (SELECT seq, regexp_extract_all({_FACTS}, '{fv.MONEY_VALUE}') AS l FROM listings)
SELECT seq, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS value FROM a""")
def i3(spark, sf_dir):
    return quality.all_money_values(i.bind(spark, sf_dir, i.RAW_LISTINGS).select("seq", F.expr(_FACTS).alias("text")))


@query("i4_keyword_in_context", r"""WITH parts AS (SELECT doc_id, text, string_split(lower(text), 'of the') AS l FROM documents),
pieces AS (SELECT doc_id, text, unnest(l) AS piece, generate_subscripts(l, 1) AS k, length(l) AS total FROM parts),
placed AS (SELECT doc_id, text, k, total, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) + (k - 1) * 6 AS start0 FROM pieces)
SELECT doc_id, CAST(k - 1 AS INTEGER) AS pos, substr(text, CAST(start0 + 1 AS BIGINT), 6) AS found,
  replace(substr(text, CAST(greatest(start0 - 50, 0) + 1 AS BIGINT), CAST(start0 + 56 - greatest(start0 - 50, 0) AS BIGINT)), chr(10), ' ') AS context
FROM placed WHERE k < total""")
def i4(spark, sf_dir):
    return quality.keyword_in_context(table(spark, sf_dir, "documents").select("doc_id", "text"), "of the")


def _quality_pages(spark, sf_dir, *wanted):
    return _outlines(spark, sf_dir, p.QUALITY, *wanted)


@query("i5_definition_pairs", """SELECT p_partkey, 0 AS pos, 'Asking Price' AS label, concat('$', p_size, ',500') AS value FROM part
  UNION ALL SELECT p_partkey, 1, 'Cash Flow', concat('$', p_size, ',000') FROM part""")
def i5(spark, sf_dir):
    return quality.definition_pairs(_quality_pages(spark, sf_dir), ("price", "revenue", "cash", "flow", "ebitda"))


@query("i6_table_rows", """SELECT p_partkey, 0 AS table_no, 0 AS row_no, 'Year | Sales' AS cells FROM part
  UNION ALL SELECT p_partkey, 0, 1, concat('2020 | $', p_size) FROM part""")
def i6(spark, sf_dir):
    return quality.table_rows(_quality_pages(spark, sf_dir)).withColumn("cells", F.array_join("cells", " | "))


@query("i7_expected_vs_actual", f"""{PRICED}
SELECT seq, price IS NOT DISTINCT FROM CASE WHEN p_size < 25 THEN price ELSE p_size END AS price_ok,
  title IS NOT DISTINCT FROM p_name AS title_ok, cash_flow IS NOT DISTINCT FROM p_size * 3000.0::DOUBLE AS cash_flow_ok
FROM priced JOIN part ON p_partkey = seq""")
def i7(spark, sf_dir):
    actual = priced_listings(spark, sf_dir)
    expected = table(spark, sf_dir, "part").join(actual.select("seq", C("price").alias("was")), C("p_partkey") == C("seq")).select(
        "seq", F.when(C("p_size") < 25, C("was")).otherwise(C("p_size").cast("double")).alias("price"), C("p_name").alias("title"),
        (C("p_size") * 3000.0).alias("cash_flow"))
    return quality.expected_vs_actual(actual, expected, "seq", ["price", "title", "cash_flow"])


@query("i8_link_pattern_scan", f"""WITH l AS (SELECT page_id, unnest(regexp_extract_all({_unescaped('html')}, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT DISTINCT page_id, href FROM l WHERE (contains(href, '/the') OR contains(href, '/d') OR contains(href, 'en')) AND NOT contains(href, ',')""")
def i8(spark, sf_dir):
    return quality.link_pattern_scan(_page_outlines(spark, sf_dir), ("/the", "/d", "en"), (",",)).select("page_id", "href")


@query("i9_embedded_json_keys", f"""WITH b AS (SELECT c_custkey, 'jsonld' AS kind, body FROM ({i.cte(i.JSONLD)}) x
  UNION ALL SELECT c_custkey, 'next', body FROM ({i.cte(i.NEXTDATA)}) y
  UNION ALL SELECT c_custkey, 'list', concat('[', c_custkey, ',"', c_name, '",null]') FROM customer)
SELECT c_custkey, kind, CASE WHEN json_valid(body) THEN CASE WHEN starts_with(body, '{{') THEN array_to_string(json_keys(CASE WHEN json_valid(body) THEN body END), ',') END END AS keys,
  CASE WHEN json_valid(body) AND starts_with(body, '[') THEN CAST(json_array_length(CASE WHEN json_valid(body) THEN body END) AS INTEGER) END AS array_length FROM b""")
def i9(spark, sf_dir):
    lists = table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("list").alias("kind"),
        F.concat(F.lit("["), C("c_custkey").cast("string"), F.lit(',"'), "c_name", F.lit('",null]')).alias("body"))
    bodies = [i.bind(spark, sf_dir, sql).withColumn("kind", F.lit(kind)) for kind, sql in (("jsonld", i.JSONLD), ("next", i.NEXTDATA))]
    return quality.embedded_json_keys(store.union_all_sites([*bodies, lists]))


@query("i10_dead_page_filter", "SELECT p_partkey, p_name AS title FROM part WHERE p_partkey % 7 > 1")
def i10(spark, sf_dir):
    return quality.dead_page_filter(_quality_pages(spark, sf_dir)).select("p_partkey", text_of(E("title")).alias("title"))


@query("i11_locate_value", """SELECT p_partkey, 0 AS pos, 'span' AS tag, concat('about $', p_size, ',354 now') AS text, 'box' AS parent_class FROM part""")
def i11(spark, sf_dir):
    pages = flatten_pages(i.bind(spark, sf_dir, f"SELECT q.*, concat('$', CAST(p_size AS STRING), ',354') AS wanted FROM ({p.QUALITY}) q "
                                 "JOIN (SELECT p_partkey AS k, p_size FROM {part}) s ON q.p_partkey = s.k", spread=True))
    return quality.locate_value(pages, "wanted").drop("wanted", "n_found", "parent_tag")


@query("i11_locate_keywords", """WITH f AS (SELECT p_partkey, unnest([
    {'pos': 0, 'tag': 'dt', 'text': 'Asking Price', 'parent_tag': 'dl', 'parent_class': ''},
    {'pos': 1, 'tag': 'p', 'text': concat('Price $', p_size, ',900'), 'parent_tag': 'article', 'parent_class': ''},
    {'pos': 2, 'tag': 'i', 'text': 'revenue', 'parent_tag': 'p', 'parent_class': ''}], recursive := true) FROM part)
  SELECT p_partkey, pos, 3 AS n_found, tag, text, parent_tag, parent_class FROM f""")
def i11_words(spark, sf_dir):
    return quality.locate_keywords(_quality_pages(spark, sf_dir), ("PRICE", "Revenue"))


@query("i11_locate_pattern", r"""WITH f AS (SELECT p_partkey, unnest([
    {'pos': 0, 'tag': 'dd', 'text': concat('$', p_size, ',500'), 'parent_tag': 'dl', 'parent_class': ''},
    {'pos': 1, 'tag': 'dd', 'text': concat('$', p_size, ',000'), 'parent_tag': 'dl', 'parent_class': ''},
    {'pos': 2, 'tag': 'span', 'text': concat('about $', p_size, ',354 now'), 'parent_tag': 'section', 'parent_class': 'box'},
    {'pos': 3, 'tag': 'p', 'text': concat('Price $', p_size, ',900'), 'parent_tag': 'article', 'parent_class': ''},
    {'pos': 4, 'tag': 'p', 'text': concat('$', p_size, '00k profit: $', p_size, ',111'), 'parent_tag': 'article', 'parent_class': ''}], recursive := true) FROM part)
  SELECT p_partkey, pos, 5 AS n_found, tag, text, parent_tag, parent_class FROM f""")
def i11_pattern(spark, sf_dir):
    return quality.locate_pattern(_quality_pages(spark, sf_dir), r"\$\d+,\d{3}")


_MENTIONS = {"price": r"\$[\d,]+(?:\.\d+)?[KkMm]?", "revenue": r"(?:revenue|sales)[:\s]*\$?[\d,]+[KkMm]?",
             "cash_flow": r"(?:cash flow|profit|income)[:\s]*\$?[\d,]+[KkMm]?"}


@query("i12_container_text", """SELECT p_partkey, 0 AS pos, concat('/business-for-sale/', p_partkey, '/') AS href, 'article' AS container,
  concat('Price $', p_size, ',900 revenue $', p_size, '00k profit: $', p_size, ',111 go') AS text, concat('$', p_size, ',900') AS price,
  concat('revenue $', p_size, '00k') AS revenue, concat('profit: $', p_size, ',111') AS cash_flow FROM part""")
def i12(spark, sf_dir):
    link = E("a", attr_parts={"href": "/business-for-sale/"})
    pages = _quality_pages(spark, sf_dir, ("nodes", "strings", "tag_index", "attr_index"), ("idx", "parent", "tag", "attrs", "s0", "s1"))
    return quality.container_text(pages, link, _MENTIONS)


@query("i12_price_link_containers", """SELECT p_partkey, 0 AS pos, 'div' AS container, 'grid' AS container_class,
    CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END AS n_prices, concat('/l/', p_partkey) AS href FROM part
  UNION ALL SELECT p_partkey, 1, 'div', 'card a', 1, concat('/l/', p_partkey) FROM part
  UNION ALL SELECT p_partkey, 2, 'section', '', 2, concat('/m/', p_partkey) FROM part WHERE p_partkey % 2 = 0""")
def i12_containers(spark, sf_dir):
    return quality.price_link_containers(_outlines(spark, sf_dir, p.CONTAINERS))


@query("i13_script_inventory", """SELECT p_partkey, 0 AS pos, 'src' AS kind, '/a.js' AS name FROM part
  UNION ALL SELECT p_partkey, 1, 'id', 'state' FROM part UNION ALL SELECT p_partkey, 2, 'inline', concat('var k=', p_partkey, ';') FROM part""")
def i13(spark, sf_dir):
    return quality.script_inventory(_quality_pages(spark, sf_dir))


@query("i14_meta_tags", """SELECT p_partkey, 'og:title' AS property, p_name AS content FROM part
  UNION ALL SELECT p_partkey, 'product:Price', CAST(p_size AS VARCHAR) FROM part""")
def i14(spark, sf_dir):
    return quality.meta_tags(_quality_pages(spark, sf_dir))
