"""Links on results pages, and which of them a crawl would have reached."""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions import text as tx
from bazaarlens.operators.extract import JSONLD, NEXTDATA, OUTLINE_COLUMNS, by_site
from bazaarlens.operators.selectors import E, all_of, first
from bazaarlens.operators.skew import first_per_group
from bazaarlens.session import cut

_LINKS = {
    "BizBuySell": E("div", cls="search-result-card") >> E("a"),
    "BizQuest": E("a", attr_parts={"href": "/business-for-sale/"}, attr_ends={"href": "/"}),
    "QuietLight": E("div", cls="listing-card") >> E("a", cls="listing-card__link"),
    "WebsiteProperties": E("article", cls="listing-card") >> E("h3", cls="mb-2") >> E("a"),
    "Flippa": E("a", has_attr="href"),
    "EmpireFlippers": E("div", cls="listing-item") >> E("a"),
    "FEInternational": E("a", cls="card_businesses_item"),
    "WebsiteClosers": E("div", cls="post_item") >> E("a", cls="post_title"),
}
_NEXT = {
    "QuietLight": E("a", cls="next"),
    "WebsiteProperties": E("a", cls="next page-numbers"),
    "EmpireFlippers": E("a", cls="next-page-link"),
}
_BASE = {row[0]: row[1] for row in fv.SITES}


_NO_LINKS = "CAST(array() AS array<string>)"


def hrefs(selector: E) -> Column:
    """``href`` of every match that has one, in document order."""
    return F.expr(f"filter(transform({all_of(selector)}, n -> n.attrs['href']), h -> h IS NOT NULL)")


def all_links() -> Column:
    """Every ``a[href]``, in document order."""
    return hrefs(E("a", has_attr="href"))


def jsonld_links() -> Column:
    """``about[].item.url`` of the first JSON-LD block; empty when absent or malformed."""
    about = f"try_variant_get(try_parse_json({first(JSONLD)}.raw), '$.about', 'array<struct<item:struct<url:string>>>')"
    return F.expr(f"coalesce(filter({about}.item.url, u -> u IS NOT NULL), {_NO_LINKS})")


def nextdata_slugs() -> Column:
    """``props.pageProps.listings[].slug``"""
    listings = f"try_variant_get(try_parse_json({first(NEXTDATA)}.raw), '$.props.pageProps.listings', 'array<struct<slug:string>>')"
    return F.expr(f"coalesce(filter({listings}.slug, s -> s IS NOT NULL), {_NO_LINKS})")


def discover_links(outlines: DataFrame, site: str = "source_site") -> DataFrame:
    """Candidates per results page, with what the stop rules need: match count and next marker.

    ``candidates`` are a page's own; ``spare`` ones count only on a page whose own bring nothing
    new (see ``explode_links``). Both are as found; ``listing_url`` makes URLs of them.
    """
    at, none = F.col(site), F.expr(_NO_LINKS)
    by_selector = {n: hrefs(s) for n, s in _LINKS.items()}
    own = by_selector | {"BizBuySell": jsonld_links(), "Acquire": nextdata_slugs()}
    keep = [c for c in outlines.columns if c not in OUTLINE_COLUMNS]
    return outlines.select(
        *keep, F.coalesce(by_site(at, own), none).alias("candidates"),
        F.when(at.isin(*_FALLBACK_SITES), by_site(at, {n: by_selector[n] for n in _FALLBACK_SITES}))
        .otherwise(none).alias("spare"),
        F.coalesce(by_site(at, {n: F.expr(f"size({all_of(s)})") for n, s in _LINKS.items()}), F.lit(0)).alias("n_matched"),
        F.coalesce(by_site(at, {n: F.expr(f"size({all_of(s)}) > 0") for n, s in _NEXT.items()}), F.lit(False))
        .alias("has_next"))


def listing_url(site: Column, href: Column, spare: Column) -> Column:
    """A candidate as an absolute listing URL, or NULL when the site's filter rejects it."""
    href = tx.not_blank(href)

    def absolute(name: str) -> Column:
        return tx.absolutise(href, F.lit(_BASE[name]))

    return by_site(site, {
        "BizBuySell": F.when(spare, absolute("BizBuySell")).otherwise(href),
        "BizQuest": F.when(href != "/business-for-sale/", absolute("BizQuest")),
        "QuietLight": F.when(href.contains("/listings/"), absolute("QuietLight")),
        "WebsiteProperties": href,
        "Flippa": F.when(href.rlike("(?d)" + fv.FL_LISTING_HREF) & absolute("Flippa").contains(_BASE["Flippa"]),
                         absolute("Flippa")),
        "EmpireFlippers": F.when(absolute("EmpireFlippers").contains("/listing/"), absolute("EmpireFlippers")),
        "Acquire": F.concat(F.lit(_BASE["Acquire"] + "/app/listing/"), href),
        "FEInternational": tx.absolutise_unless_http(href, F.lit(_BASE["FEInternational"])),
        "WebsiteClosers": tx.absolutise_unless_http(href, F.lit(_BASE["WebsiteClosers"])),
    })


_PAGE_KEY = ["source_site", "search_url", "page"]
_FALLBACK_SITES = ("BizBuySell",)


def links_of(pages: DataFrame, column: str) -> DataFrame:
    """One row per link of a page: ``url`` and its position."""
    return (
        pages.select(*_PAGE_KEY, F.posexplode(column).alias("pos", "href"))
        .select(*_PAGE_KEY, "pos", listing_url(F.col("source_site"), F.col("href"), F.lit(column == "spare")).alias("url"))
        .filter(F.col("url").isNotNull()))


def explode_links(pages: DataFrame) -> DataFrame:
    """One row per link. A page's spare links are used when it offers no own link that is new at that
    point of its search URL, own links and used spare links of earlier pages being known (B5).

    Whether a page needs its spare links depends on earlier pages only, and more used links can only
    make more pages need theirs: starting from none, the set of such pages grows to the one that
    reading in order would find. A round costs two grouped aggregates and sends one count to the driver.
    Reads its input more than once: pass a cut or stored result of ``discover_links``.
    """
    own = links_of(pages, "candidates")
    at = F.col("source_site").isin(*_FALLBACK_SITES)
    fallback, own_there = pages.filter(at), own.filter(at)
    spare = links_of(fallback, "spare")

    def without_new(used: DataFrame) -> DataFrame:
        """Pages of which every own link occurs on an earlier page, own or used there."""
        first = own_there.unionByName(used).groupBy("source_site", "search_url", "url").agg(F.min("page").alias("page"))
        new = own_there.join(first, [*_PAGE_KEY, "url"], "left_semi").select(*_PAGE_KEY)
        return cut(fallback.select(*_PAGE_KEY).distinct().join(new, _PAGE_KEY, "left_anti"))

    needing, before = without_new(spare.limit(0)), 0
    while (n := needing.count()) > before:
        before, needing = n, without_new(spare.join(needing, _PAGE_KEY, "left_semi"))
    return own.unionByName(spare.join(needing, _PAGE_KEY, "left_semi"))


# digits kept for each part of a crawl position; a value too large fails, it never wraps
_DIGITS = {"search_pos": 9, "page": 10, "pos": 19}


def _first(links: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key, the smallest position. The parts are packed into one decimal because a minimum
    of a struct would sort all links on the map side; a decimal is aggregated by hash."""
    place = F.col(order[0]).cast("decimal(38,0)")
    for c in order[1:]:
        place = (place * F.lit(Decimal(10 ** _DIGITS[c])) + F.col(c)).cast("decimal(38,0)")
    parts, rest = [], "place"
    for c in reversed(order[1:]):
        unit = f"{10 ** _DIGITS[c]}BD"
        parts.append(F.expr(f"CAST({rest} % {unit} AS {dict(links.dtypes)[c]})").alias(c))
        rest = f"({rest} div {unit})"
    parts.append(F.expr(f"CAST({rest} AS {dict(links.dtypes)[order[0]]})").alias(order[0]))
    return links.groupBy(*keys).agg(F.min(place).alias("place")).select(*keys, *reversed(parts))


def first_occurrences(links: DataFrame) -> DataFrame:
    """Distinct URLs of a search URL, each at its first page and position."""
    return _first(links, ["source_site", "search_url", "url"], ["page", "pos"])


def dedup_ordered(links: DataFrame) -> DataFrame:
    """B8 across search URLs: a site's distinct URLs at their first (search, page, position)."""
    return _first(links, ["source_site", "url"], ["search_pos", "page", "pos"])


def page_limits(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Last page a crawl keeps, per search URL.

    Pages are read in order from 1 and reading stops at the first one that is missing, that
    breaks the site's stop rule (excluded), or that has no next marker (kept). How many new
    links a page has does not depend on where reading stops, so everything reduces to two
    grouped aggregates; no window runs over a search URL.

    ``pages``: one row per captured page with ``n_matched`` and ``has_next``.
    """
    site = F.col("source_site")
    def mark(at: Column, here: int, n_matched: Column | int = 0, has_next: Column | int = 0) -> Column:
        return F.struct(
            at.cast("int").alias("page"), F.lit(0).cast("long").alias("n_new"), F.lit(here).alias("here"),
            F.lit(n_matched).cast("long").alias("n_matched"), F.lit(has_next).cast("int").alias("has_next"))

    # a page vouches for itself and makes page 1 and the page after it expected
    seen = pages.select("source_site", "search_url", F.explode(F.array(
        mark(F.col("page"), 1, F.col("n_matched"), F.col("has_next")), mark(F.col("page") + 1, 0),
        mark(F.lit(1), 0))).alias("m")).select("source_site", "search_url", "m.*")
    new = first_occurrences(links).select(
        "source_site", "search_url", F.col("page").cast("int").alias("page"), F.lit(1).cast("long").alias("n_new"),
        F.lit(0).alias("here"), F.lit(0).cast("long").alias("n_matched"), F.lit(0).alias("has_next"))
    marks = (
        seen.unionByName(new)
        .groupBy(*_PAGE_KEY)
        .agg(F.sum("n_new").alias("n_new"), F.max("here").alias("here"), F.max("n_matched").alias("n_matched"),
             F.max("has_next").alias("has_next"))
    )
    unread = (
        (F.col("here") == 0)
        | (site.isin(*fv.STOP_ON_NO_NEW) & (F.col("n_new") == 0))
        | (site.isin(*fv.STOP_ON_NO_NEW_AFTER_FIRST) & (F.col("n_new") == 0) & (F.col("page") > 1))
        | (site.isin(*fv.STOP_ON_NO_MATCH) & (F.col("n_matched") == 0))
        | (site.isin(*fv.SINGLE_PAGE_SITES) & (F.col("page") > 1))
    )
    last = site.isin(*fv.STOP_WITHOUT_NEXT) & (F.col("has_next") == 0)
    return marks.groupBy("source_site", "search_url").agg(
        F.min(F.when(unread, F.col("page") - 1).when(last, F.col("page"))).alias("last_page"))


def truncate_frontier(links: DataFrame, pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """First occurrences on the pages a crawl keeps."""
    found = first_occurrences(links if max_pages is None else links.filter(F.col("page") <= max_pages))
    # limits are a row per search; a hot search's links are split by adaptive skew handling
    kept = found.join(page_limits(links, pages), ["source_site", "search_url"])
    return kept.filter(F.col("page") <= F.col("last_page")).drop("last_page")


def cap_pages(links: DataFrame, max_listings: int | None, max_pages: int | None = None) -> DataFrame:
    """A listing cap alone limits the crawl to the first page."""
    pages = max_pages if max_pages is not None else (1 if max_listings else None)
    return links if pages is None else links.filter(F.col("page") <= pages)


def cap_listings(urls: DataFrame, max_listings: int | None) -> DataFrame:
    """The first N URLs of a site in crawl order."""
    if not max_listings:
        return urls
    order = [F.col(c) for c in ("search_pos", "page", "pos") if c in urls.columns]
    return first_per_group(urls, ["source_site"], [*order, F.col("url")], max_listings, F.col("url"))
