"""Registered checks of sources, sinks, frontier and set operations (A, B, E)."""
from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions import money, text as tx
from bazaarlens.operators import extract, frontier
from bazaarlens.plans import inputs as i
from bazaarlens.plans.registry import query
from bazaarlens.session import fresh_path
from bazaarlens.sources import captures, runlog, sites, store

C = F.col
LISTINGS = f"WITH listings AS ({i.cte(i.RAW_LISTINGS)})"
CONFIGS = f"WITH configs AS ({i.cte(i.SITE_CONFIGS)})"
LINKS = f"WITH links AS ({i.cte(i.FRONTIER)})"
PRICED = f"""{LISTINGS}, priced AS (SELECT source_site, listing_url, seq, title, {i.sql_price_base('price_text')} AS price,
  {i.sql_price_base('cash_flow_text')} AS cash_flow, description, industry FROM listings)"""


def priced_listings(spark, sf_dir):
    """The derived listings with their amounts read."""
    return i.bind(spark, sf_dir, i.RAW_LISTINGS).select(
        "source_site", "listing_url", "seq", "title", money.parse_price_base(C("price_text")).alias("price"),
        money.parse_price_base(C("cash_flow_text")).alias("cash_flow"), "description", "industry")


# --- A ------------------------------------------------------------------------------
@query("a1_read_captures", f"""WITH c AS ({i.cte(i.CAPTURES)})
SELECT page_id, url, rendered, CAST(length(html) AS BIGINT) AS n_chars FROM c WHERE html IS NOT NULL""")
def a1(spark, sf_dir):
    return captures.usable(i.bind(spark, sf_dir, i.CAPTURES)).select(
        "page_id", "url", "rendered", F.length("html").cast("long").alias("n_chars"))


@query("a3_prefer_rendered", f"""WITH c AS ({i.cte(i.CAPTURES)}),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY rendered DESC, html DESC) AS rn FROM c WHERE html IS NOT NULL)
SELECT page_id, url, rendered, md5(html) AS html_md5 FROM r WHERE rn = 1""")
def a3(spark, sf_dir):
    # of captures equal in order the SQL takes the last by HTML; of the same HTML, which it leaves open, the first page
    return captures.prefer_rendered(i.bind(spark, sf_dir, i.CAPTURES), ties=F.struct("html", (-C("page_id")).alias("page"))).select(
        "page_id", "url", "rendered", F.md5(C("html").cast("binary")).alias("html_md5"))


@query("a4_site_config", f"""{LISTINGS}, sites(name, base_url, enabled) AS (VALUES
{', '.join(f"('{s[0]}', '{s[1]}', {str(s[6]).lower()})" for s in fv.SITES)})
SELECT name, base_url, enabled, count(seq) AS n FROM sites LEFT JOIN listings ON source_site = name GROUP BY ALL""")
def a4(spark, sf_dir):
    counts = i.bind(spark, sf_dir, i.RAW_LISTINGS).groupBy("source_site").agg(F.count("*").alias("n"))
    return (
        sites.site_config(spark).join(counts, C("name") == C("source_site"), "left")
        .select("name", "base_url", "enabled", F.coalesce("n", F.lit(0).cast("long")).alias("n")))


_STORED = f"""{PRICED}, rows AS (SELECT *, CAST(concat('0x', substr(md5(listing_url), 1, 15)) AS BIGINT) AS id,
  CASE WHEN cash_flow IS NULL THEN NULL ELSE TIMESTAMP '2024-05-01 02:00:00' END AS scraped_at FROM priced)"""


def _stored_rows(spark, sf_dir):
    """Listings as the store wants them; those without cash flow lack the required time."""
    stamp = F.when(C("cash_flow").isNotNull(), F.lit("2024-05-01 02:00:00").cast("timestamp"))
    return store.to_listings(priced_listings(spark, sf_dir), stamp)


@query("a5_a7_append_listings", f"""{_STORED}
SELECT source_site, id, listing_url, title, price, cash_flow, strftime(scraped_at, '%Y-%m-%dT%H:%M:%S.%f') AS scraped_at
FROM rows WHERE scraped_at IS NOT NULL""")
def a7(spark, sf_dir):
    path = fresh_path(spark, "listings")
    name = "bazaarlens_" + path.rsplit("-", 1)[1]
    store.create_listings_table(spark, name, path)
    store.append_listings(_stored_rows(spark, sf_dir), name)
    return spark.table(name).select(
        "source_site", "id", "listing_url", "title", "price", "cash_flow", tx.iso_timestamp(C("scraped_at")).alias("scraped_at"))


@query("a8_write_json", f"""{_STORED}
SELECT listing_url, title, price, cash_flow, strftime(scraped_at, '%Y-%m-%dT%H:%M:%S.%f') AS scraped_at FROM rows""")
def a8(spark, sf_dir):
    path = fresh_path(spark, "json")
    path = store.write_json(_stored_rows(spark, sf_dir), path)
    return spark.read.schema("listing_url string, title string, price double, cash_flow double, scraped_at string").json(path)


@query("a6_a9_append_run_log", f"""WITH u AS ({i.cte(i.RUNS)})
SELECT run_id, site_name, strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') AS start_time, 'running' AS status,
  CAST(0 AS BIGINT) AS total_listings_found, CAST(0 AS BIGINT) AS api_calls_made, CAST(NULL AS DOUBLE) AS duration_seconds
FROM u GROUP BY run_id, site_name""")
def a9(spark, sf_dir):
    path = fresh_path(spark, "runlog")
    name = "bazaarlens_" + path.rsplit("-", 1)[1]
    runlog_rows = runlog.initial_run_rows(
        i.bind(spark, sf_dir, i.RUNS).groupBy("run_id", "site_name").agg(F.min("ts").alias("start_time")))
    store.create_log_table(spark, name, path)
    runlog.append_run_log(runlog_rows, name)
    return spark.table(name).select(
        "run_id", "site_name", tx.iso_timestamp(C("start_time")).alias("start_time"), "status", "total_listings_found",
        "api_calls_made", "duration_seconds")


@query("a10_orchestrator_run", f"""WITH r AS ({i.cte(i.REQUESTS)})
SELECT strftime(ts, 'run_%Y%m%d_%H%M%S') AS run_id, 'orchestrator' AS source, 'completed' AS status,
  CASE event_id % 5 WHEN 2 THEN 'manual' WHEN 3 THEN 'api' ELSE 'scheduler' END AS trigger_type, '1.0.2' AS scraper_version,
  strftime(ts, '%Y-%m-%d') AS ingestion_date, CAST(0 AS BIGINT) AS total_listings_found, CAST(0 AS BIGINT) AS new_listings,
  CAST(0 AS BIGINT) AS updated_listings FROM r""")
def a10(spark, sf_dir):
    return runlog.orchestrator_runs(i.bind(spark, sf_dir, i.REQUESTS)).drop("start_time", "end_time").withColumn(
        "ingestion_date", C("ingestion_date").cast("string"))


# --- B ------------------------------------------------------------------------------
_CHOSEN = ("QuietLight", "BizQuest", "Flippa", "Acquire", "WebsiteClosers")


@query("b1_select_sites", f"""{CONFIGS} SELECT s_suppkey, name FROM configs WHERE enabled AND name IN {_CHOSEN}
  AND name IN {tuple(n for n in extract.EXTRACTORS if n not in fv.SINGLE_PAGE_SITES)}""")
def b1(spark, sf_dir):
    runnable = [n for n in extract.EXTRACTORS if n not in fv.SINGLE_PAGE_SITES]
    return sites.select_sites(i.bind(spark, sf_dir, i.SITE_CONFIGS), _CHOSEN, runnable).select("s_suppkey", "name")


@query("b2_resolve_search_urls", f"""{CONFIGS}, u AS (SELECT s_suppkey, 0 AS k, ecommerce_url AS url FROM configs
  UNION ALL SELECT s_suppkey, 1, amazon_url FROM configs
  UNION ALL SELECT s_suppkey, 2, list_url FROM configs WHERE ecommerce_url IS NULL AND amazon_url IS NULL
  UNION ALL SELECT s_suppkey, 3, concat(list_url, 'more/') FROM configs WHERE ecommerce_url IS NULL AND amazon_url IS NULL
    AND list_url IS NOT NULL
  UNION ALL SELECT s_suppkey, 4, search_url FROM configs WHERE ecommerce_url IS NULL AND amazon_url IS NULL AND list_url IS NULL)
SELECT s_suppkey, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY k) - 1 AS INTEGER) AS search_pos, url AS resolved_url
FROM u WHERE url IS NOT NULL""")
def b2(spark, sf_dir):
    several = F.when(C("list_url").isNotNull(), F.array("list_url", F.concat("list_url", F.lit("more/"))))
    return sites.resolve_search_urls(i.bind(spark, sf_dir, i.SITE_CONFIGS).withColumn("search_urls", several)).select(
        "s_suppkey", "search_pos", "resolved_url")


@query("b3_page_urls", f"""{CONFIGS}, p AS (SELECT s_suppkey, name, search_url AS s,
  unnest(range(1, CAST(CASE WHEN name IN ('Acquire', 'FEInternational') THEN 2 ELSE 2 + s_suppkey % 4 END AS BIGINT))) AS n
  FROM configs WHERE search_url IS NOT NULL)
SELECT s_suppkey, CAST(n AS INTEGER) AS page, CASE name WHEN 'BizBuySell' THEN s || n || '/'
  WHEN 'BizQuest' THEN CASE WHEN n = 1 THEN 'https://www.bizquest.com/businesses-for-sale/'
    ELSE 'https://www.bizquest.com/businesses-for-sale/page-' || n || '/' END
  WHEN 'QuietLight' THEN CASE WHEN n = 1 THEN s ELSE rtrim(s, '/') || '/page/' || n || '/' END
  WHEN 'WebsiteProperties' THEN CASE WHEN n = 1 THEN s ELSE s || '/page/' || n || '/' END
  WHEN 'Flippa' THEN s || '&offset=' || ((n - 1) * 50)
  WHEN 'EmpireFlippers' THEN s || CASE WHEN contains(s, '?') THEN '&page=' ELSE '?page=' END || n
  WHEN 'WebsiteClosers' THEN CASE WHEN n = 1 THEN s ELSE s || 'page/' || n || '/' END ELSE s END AS page_url FROM p""")
def b3(spark, sf_dir):
    searches = i.bind(spark, sf_dir, i.SITE_CONFIGS).filter(C("search_url").isNotNull())
    return sites.page_urls(searches, "name", "search_url", (1 + C("s_suppkey") % 4).cast("int")).select(
        "s_suppkey", "page", "page_url")


_HREF = ("CASE seq % 4 WHEN 0 THEN concat('/listing/', CAST(seq AS STRING)) WHEN 1 THEN listing_url "
         "WHEN 2 THEN concat('rel/', CAST(seq AS STRING)) ELSE '//cdn.example/x' END")


@query("b7_absolutise", f"""{LISTINGS}, a AS (SELECT seq, {_HREF} AS href FROM listings)
SELECT seq, CASE WHEN starts_with(href, '/') THEN 'https://base.example' || href ELSE href END AS url,
  CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://base.example' || href END AS url_unless_http FROM a""")
def b7(spark, sf_dir):
    base = F.lit("https://base.example")
    return i.bind(spark, sf_dir, i.RAW_LISTINGS).select("seq", F.expr(_HREF).alias("href")).select(
        "seq", tx.absolutise(C("href"), base).alias("url"), tx.absolutise_unless_http(C("href"), base).alias("url_unless_http"))


def _links(spark, sf_dir):
    return i.bind(spark, sf_dir, i.FRONTIER)


@query("b8_dedup_ordered", f"""{LINKS}, r AS (SELECT *, row_number() OVER (PARTITION BY source_site, url
  ORDER BY search_pos, page, pos) AS rn FROM links)
SELECT source_site, url, search_pos, page, pos FROM r WHERE rn = 1""")
def b8(spark, sf_dir):
    return frontier.dedup_ordered(_links(spark, sf_dir))


# one page of one search is missing, one matched nothing, and next markers end at page 30
_HERE = "NOT (search_pos = 2 AND page = 9)"
_MATCHED = "CASE WHEN search_pos = 3 AND page = 17 THEN 0 ELSE count(*) END"


@query("b9_truncate_frontier", f"""{LINKS}, l AS (SELECT * FROM links WHERE {_HERE}),
pages AS (SELECT source_site, search_url, search_pos, page, {_MATCHED} AS n_matched, page < 30 AS has_next FROM l
  GROUP BY source_site, search_url, search_pos, page),
f AS (SELECT source_site, search_url, url, page, pos, row_number() OVER (PARTITION BY source_site, search_url, url ORDER BY page, pos) AS rn FROM l),
firsts AS (SELECT * FROM f WHERE rn = 1),
grid AS (SELECT s.source_site, s.search_url, g.page FROM (SELECT DISTINCT source_site, search_url FROM l) s, range(1, 43) g(page)),
state AS (SELECT g.*, p.page IS NOT NULL AS here, p.n_matched, p.has_next,
  (SELECT count(*) FROM firsts x WHERE x.source_site = g.source_site AND x.search_url = g.search_url AND x.page = g.page) AS n_new
  FROM grid g LEFT JOIN pages p USING (source_site, search_url, page)),
stops AS (SELECT source_site, search_url, min(CASE WHEN NOT here THEN page - 1
    WHEN source_site = 'BizQuest' AND n_new = 0 THEN page - 1
    WHEN source_site = 'WebsiteProperties' AND n_new = 0 AND page > 1 THEN page - 1
    WHEN source_site IN ('QuietLight', 'WebsiteProperties') AND n_matched = 0 THEN page - 1
    WHEN source_site IN ('QuietLight', 'WebsiteProperties') AND NOT has_next THEN page END) AS last_page FROM state GROUP BY 1, 2)
SELECT source_site, search_url, url, firsts.page, pos FROM firsts JOIN stops USING (source_site, search_url) WHERE firsts.page <= last_page""")
def b9(spark, sf_dir):
    links = _links(spark, sf_dir).filter(_HERE)
    pages = links.groupBy("source_site", "search_url", "search_pos", "page").agg(
        F.expr(_MATCHED).alias("n_matched"), (C("page") < 30).alias("has_next"))
    return frontier.truncate_frontier(links, pages)


@query("b10_max_pages", f"""{LINKS} SELECT source_site, search_url, page, count(*) AS n, count(DISTINCT url) AS n_urls
FROM links WHERE page <= 3 GROUP BY ALL""")
def b10(spark, sf_dir):
    capped = frontier.cap_pages(_links(spark, sf_dir), max_listings=None, max_pages=3)
    return capped.groupBy("source_site", "search_url", "page").agg(
        F.count("*").alias("n"), F.count_distinct("url").alias("n_urls"))


@query("b11_max_listings", f"""{LINKS}, r AS (SELECT *, row_number() OVER (PARTITION BY source_site, url
  ORDER BY search_pos, page, pos) AS rn FROM links WHERE page <= 1),
d AS (SELECT *, row_number() OVER (PARTITION BY source_site ORDER BY search_pos, page, pos) AS k FROM r WHERE rn = 1)
SELECT source_site, url, search_pos, page, pos FROM d WHERE k <= 40""")
def b11(spark, sf_dir):
    first_pages = frontier.cap_pages(_links(spark, sf_dir), max_listings=40)
    return frontier.cap_listings(frontier.dedup_ordered(first_pages), 40)


# --- E ------------------------------------------------------------------------------
def _stored(spark, sf_dir):
    """What an earlier run stored: the listings that name an industry."""
    return i.bind(spark, sf_dir, i.RAW_LISTINGS).filter(C("industry").isNotNull())


@query("e1_existing_urls", f"""{LISTINGS} SELECT DISTINCT source_site, listing_url FROM listings
WHERE listing_url IN (SELECT listing_url FROM listings WHERE industry IS NOT NULL)""")
def e1(spark, sf_dir):
    return store.existing_urls(i.bind(spark, sf_dir, i.RAW_LISTINGS), _stored(spark, sf_dir))


@query("e2_new_urls", f"""{LISTINGS} SELECT source_site, listing_url, min(seq) AS pos FROM listings
WHERE listing_url NOT IN (SELECT listing_url FROM listings WHERE industry IS NOT NULL) GROUP BY ALL""")
def e2(spark, sf_dir):
    candidates = i.bind(spark, sf_dir, i.RAW_LISTINGS).groupBy("source_site", "listing_url").agg(F.min("seq").alias("pos"))
    return store.new_urls(candidates, _stored(spark, sf_dir))


@query("e3_union_all_sites", f"""{PRICED} SELECT source_site, listing_url, seq, title,
  CASE WHEN source_site <> 'QuietLight' THEN price END AS price, CASE WHEN source_site <> 'BizBuySell' THEN cash_flow END AS cash_flow,
  CASE WHEN source_site <> 'BizQuest' THEN industry END AS industry FROM priced""")
def e3(spark, sf_dir):
    rows = priced_listings(spark, sf_dir).drop("description")
    lacking = {"QuietLight": ["price"], "BizBuySell": ["cash_flow"], "BizQuest": ["industry"],
               "WebsiteProperties": [], "EmpireFlippers": [], "WebsiteClosers": []}
    return store.union_all_sites([store.by_site(rows, s).drop(*c) for s, c in lacking.items()])


@query("e4_rejected_rows", f"""{_STORED} SELECT source_site, listing_url, 'scraped_at is missing' AS reject_reason FROM rows
WHERE scraped_at IS NULL""")
def e4(spark, sf_dir):
    return store.rejected(_stored_rows(spark, sf_dir)).select("source_site", "listing_url", "reject_reason")


@query("e5_high_value", f"{PRICED} SELECT source_site, listing_url, seq, price FROM priced WHERE price > 1000000")
def e5(spark, sf_dir):
    return store.high_value(priced_listings(spark, sf_dir)).select("source_site", "listing_url", "seq", "price")


@query("e6_by_site", f"{PRICED} SELECT seq, listing_url, price, cash_flow FROM priced WHERE source_site = 'BizQuest'")
def e6(spark, sf_dir):
    return store.by_site(priced_listings(spark, sf_dir), "BizQuest").select("seq", "listing_url", "price", "cash_flow")
