"""Pages rendered from table columns, one template per site and layout.

A template is SQL over ``part``; what the page must yield is stated from the same columns,
so the checking SQL never parses HTML.
"""
from __future__ import annotations

import re

S = "CAST(p_size AS STRING)"
K = "CAST(p_partkey AS STRING)"


def page(html: str) -> str:
    return f"SELECT p_partkey, concat('<!DOCTYPE html><html>', {html}, '</html>') AS html FROM {{part}}"


# --- listing pages ------------------------------------------------------------------
QUIETLIGHT = page(f"""'<body><h3> ', p_name, ' </h3>',
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('<div class="listing-card__category-name"> ', p_type, '</div>') END,
  '<div class="single_business_price x inform_price"><h4>Asking Price: ', CASE WHEN p_partkey % 5 = 0 THEN 'Accepting Offers'
    ELSE concat('$', CAST(p_size + 7 AS STRING), ',000 + Inventory') END, '</h4><p> About ', p_name, ' <b>now</b></p><p>more</p></div>',
  '<div class="inform_revenue single_business"><ul><li><h6>Revenue</h6><p>$', {S}, ',000</p></li><li><h6>Net Income</h6><p>',
  CASE WHEN p_partkey % 4 = 0 THEN 'n/a' ELSE '$7k' END, '</p></li><li><h6>Multiple</h6><p>', CASE WHEN p_partkey % 3 = 0 THEN '.' ELSE '3.5' END,
  '</p></li><li><h6>No value</h6></li><li>plain</ul></div>', CASE WHEN p_partkey % 3 = 0 THEN '<footer>Seller Financing possible</footer>' ELSE '' END, '</body>'""")
QUIETLIGHT_FIELDS = """p_name AS title, CASE WHEN p_partkey % 7 = 0 THEN 'Industry not found' ELSE p_type END AS industry,
  concat('About ', p_name, ' now') AS description, CASE WHEN p_partkey % 5 = 0 THEN 0.0::DOUBLE ELSE (p_size + 7) * 1000.0::DOUBLE END AS price,
  p_size * 1000.0::DOUBLE AS revenue, CASE WHEN p_partkey % 4 <> 0 THEN 7000.0::DOUBLE END AS cash_flow,
  CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 4 <> 0 THEN round((p_size + 7) * 1000.0::DOUBLE / 7000.0::DOUBLE, 2)
    WHEN p_partkey % 3 <> 0 THEN 3.5::DOUBLE END AS multiple, p_partkey % 3 = 0 AS seller_financing"""

BIZBUYSELL = page(f"""'<head>', CASE p_partkey % 5 WHEN 0 THEN concat('<script type="application/ld+json">{{{{"name":"LD ', p_name,
    '","description":"LD about","offers":{{{{"price":"', {S}, '000","availableAtOrFrom":{{{{"address":{{{{"addressLocality":"Austin","addressRegion":"TX"}}}}}}}}}}}}}}}}</script>')
    WHEN 1 THEN '<script type="application/ld+json">{{{{bad</script>' ELSE '' END, '</head><body><h1>other</h1><h1 class="a font-h1-new"> ', p_name, ' </h1>',
  '<div class="description"> Deal ', {K}, ' </div>', CASE WHEN p_partkey % 5 = 2 THEN concat('<div class="asking-price">$', {S}, 'k</div><div>Gross Revenue $', {S},
    ',111 Cash Flow (SDE): $', {S}, ',222</div><p>Established 2001') ELSE concat('<div class="financials"><p><span class="title">Asking Price:</span> $', {S},
    ',500</p><p><span class="title">Cash Flow (SDE):</span> ', CASE WHEN p_partkey % 3 = 0 THEN 'Not Disclosed' ELSE concat('$', {S}, ',000') END,
    '</p><p><span class="title">Gross Revenue:</span> $', {S}, ',900</p><p><span class="title">EBITDA:</span> ',
    CASE WHEN p_partkey % 4 = 0 THEN 'Not Disclosed' ELSE concat('$', {S}, '00') END,
    '</p><p>no title</p><p><span class="title">Established:</span> ', CAST(1950 + p_size AS STRING), '</p></div>') END,
  '<span class="category"> ', p_type, ' </span><div class="business-type">later</div></body>'""")
BIZBUYSELL_FIELDS = """CASE WHEN p_partkey % 5 = 0 THEN concat('LD ', p_name) ELSE p_name END AS title,
  CASE WHEN p_partkey % 5 = 0 THEN 'LD about' ELSE concat('Deal ', p_partkey) END AS description,
  CASE p_partkey % 5 WHEN 0 THEN p_size * 1000.0::DOUBLE WHEN 2 THEN p_size * 1000.0::DOUBLE ELSE p_size * 1000.0::DOUBLE + 500 END AS price,
  CASE p_partkey % 5 WHEN 2 THEN p_size * 1000.0::DOUBLE + 111 ELSE p_size * 1000.0::DOUBLE + 900 END AS revenue,
  CASE WHEN p_partkey % 5 = 2 THEN p_size * 1000.0::DOUBLE + 222 WHEN p_partkey % 3 = 0 THEN p_size * 1000.0::DOUBLE + 900
    ELSE p_size * 1000.0::DOUBLE END AS cash_flow,
  CASE WHEN p_partkey % 5 <> 2 AND p_partkey % 4 <> 0 THEN p_size * 100.0::DOUBLE END AS ebitda,
  CASE WHEN p_partkey % 5 = 0 THEN 'Austin, TX' END AS location, p_type AS industry,
  CASE WHEN p_partkey % 5 = 2 THEN 2001 ELSE 1950 + p_size END AS established_year"""

_BQ_PARTS = {
    "p_title": "p_name",
    "p_price": f"""CASE p_partkey % 3 WHEN 0 THEN concat('$', {S}, ',500') WHEN 1 THEN concat('Asking Price: $', {S}, '.5Million')
      ELSE concat('$', {S}, ',000 asking') END""",
    "p_cash": f"""CASE p_partkey % 4 WHEN 0 THEN concat('Cash Flow: $', {S}, ',000') WHEN 1 THEN concat('Net Income $', {S}, 'K')
      WHEN 2 THEN concat('SDE: ', {S}, ',100') ELSE 'Figures on request' END""",
    "p_revenue": f"""CASE p_partkey % 5 WHEN 0 THEN concat('Gross Revenue: $', {S}, ',300') WHEN 1 THEN concat('Yearly Sales: ', {S}, '00k')
      WHEN 2 THEN concat('$', {S}, ',400 in revenue.') WHEN 3 THEN 'about 20 % margin' ELSE 'ask us' END""",
    "p_place": """CASE p_partkey % 3 WHEN 0 THEN 'located in Cedar Park, TX' WHEN 1 THEN 'near Salt Lake City, UT' ELSE 'anywhere' END""",
    "p_kind": """CASE p_partkey % 6 WHEN 0 THEN 'a pizza place' WHEN 1 THEN 'a boutique' WHEN 2 THEN 'Dental CLINIC' WHEN 3 THEN 'vehicle hub'
      ELSE 'none' END""",
    "p_year": """CASE p_partkey % 4 WHEN 0 THEN 'Established: 1995' WHEN 1 THEN '2011 founded' WHEN 2 THEN 'Founded 1776' ELSE 'old' END""",
    "p_staff": f"""CASE WHEN p_partkey % 2 = 0 THEN concat({S}, ' employees') ELSE 'family run' END""",
    "p_stock": f"""CASE WHEN p_partkey % 3 = 0 THEN concat('Inventory: $', {S}, 'k') ELSE 'no goods' END""",
    "p_estate": """CASE p_partkey % 3 WHEN 0 THEN 'Real Estate Included' WHEN 1 THEN 'under lease' ELSE 'ground' END""",
    "p_reason": """CASE WHEN p_partkey % 2 = 0 THEN 'Reason for selling: retirement plans. End' ELSE 'no why' END""",
    "p_terms": """CASE WHEN p_partkey % 3 = 0 THEN 'SBA' WHEN p_partkey % 3 = 1 THEN 'will train' ELSE 'cash' END""",
}
BIZQUEST_PARTS = "SELECT *, " + ", ".join(f"{sql} AS {name}" for name, sql in _BQ_PARTS.items()) + " FROM {part}"
BIZQUEST = f"""SELECT p_partkey, concat('<!DOCTYPE html><html><head>', CASE WHEN p_partkey % 4 = 0 THEN
    concat('<meta name="description" content=" Meta ', p_name, ' ">') ELSE '' END, '</head><body>',
  CASE p_partkey % 3 WHEN 0 THEN concat('<h1> ', p_title, ' </h1>') WHEN 1 THEN concat('<h2 class="business-title">', p_title, '</h2>')
    ELSE concat('<h4>', p_title, '</h4>') END,
  CASE WHEN p_partkey % 3 = 0 THEN concat('<div class="top price"> ', p_price, ' </div>') ELSE concat('<p>', p_price) END,
  '<p>', p_cash, '<p>', p_revenue, '<p>', p_place, '</p>', CASE WHEN p_partkey % 4 = 1 THEN '<div class="description">' ELSE '<div>' END,
  '<i>', p_kind, '</i></div><ul><li>', p_year, '<li>', p_staff, '<li>', p_stock, '</ul><p>', p_estate, '<p>', p_reason, '<p> ', p_terms,
  ' </body></html>') AS html FROM ({BIZQUEST_PARTS}) t"""
BIZQUEST_TEXT = "concat_ws(' ', " + ", ".join(_BQ_PARTS) + ")"
_BQ_CASH = ("CASE p_partkey % 4 WHEN 0 THEN p_size * 1000.0::DOUBLE WHEN 1 THEN p_size * 1000.0::DOUBLE "
            "WHEN 2 THEN p_size * 1000.0::DOUBLE + 100 END")
_BQ_PRICE = ("CASE p_partkey % 3 WHEN 0 THEN p_size * 1000.0::DOUBLE + 500 WHEN 1 THEN p_size * 1000000.0::DOUBLE + 500000 "
             "ELSE p_size * 1000.0::DOUBLE END")
BIZQUEST_FIELDS = f"""CASE WHEN p_partkey % 3 < 2 THEN p_name ELSE concat('Deal ', p_partkey) END AS title, {_BQ_PRICE} AS price,
  p_price AS asking_price_raw, {_BQ_CASH} AS cash_flow,
  CASE WHEN p_partkey % 4 < 3 THEN p_cash END AS cash_flow_raw, {_BQ_CASH} AS profit,
  CASE p_partkey % 5 WHEN 0 THEN p_size * 1000.0::DOUBLE + 300 WHEN 1 THEN p_size * 100000.0::DOUBLE WHEN 2 THEN p_size * 1000.0::DOUBLE + 400
    WHEN 3 THEN ({_BQ_CASH}) / 0.2::DOUBLE END AS revenue,
  CASE p_partkey % 5 WHEN 0 THEN p_revenue WHEN 1 THEN p_revenue WHEN 2 THEN replace(p_revenue, '.', '')
    WHEN 3 THEN CASE WHEN p_partkey % 4 < 3 THEN 'Estimated from 20.0% margin' END END AS revenue_raw,
  CASE p_partkey % 3 WHEN 0 THEN 'Cedar Park, TX' WHEN 1 THEN 'Salt Lake City, UT' END AS location,
  CASE p_partkey % 3 WHEN 0 THEN 'Cedar Park' WHEN 1 THEN 'Salt Lake City' END AS city,
  CASE p_partkey % 3 WHEN 0 THEN 'TX' WHEN 1 THEN 'UT' END AS state,
  CASE p_partkey % 4 WHEN 0 THEN 1995 WHEN 1 THEN 2011 END AS established_year,
  CASE p_partkey % 4 WHEN 0 THEN concat('Meta ', p_name) WHEN 1 THEN p_kind ELSE left({BIZQUEST_TEXT}, 500) END AS description,
  CASE WHEN p_partkey % 2 = 0 THEN p_size END AS employees,
  CASE WHEN p_partkey % 3 = 0 THEN p_size * 1000.0::DOUBLE END AS inventory_value,
  CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS real_estate_included,
  CASE WHEN p_partkey % 2 = 0 THEN 'retirement plans' END AS reason_for_selling,
  CASE WHEN p_partkey % 3 = 0 THEN true END AS financing_available, CASE WHEN p_partkey % 3 = 1 THEN true END AS training_provided"""

WEBSITEPROPERTIES = page(f"""'<body><h2 class="blog-single-title big"> ', p_name, '</h2><h5 class="mt-4">Asking Price: ',
  CASE WHEN p_partkey % 5 = 0 THEN 'accepting offers' ELSE concat('$', {S}, '.75M') END, '</h5><table class="listing-data-table">',
  '<tr><th>Gross Revenue</th><td> $', {S}, ',000 </td></tr><tr><th>Annual Cash Flow<td>', CASE WHEN p_partkey % 4 = 0 THEN '0' ELSE '$250,000' END,
  '<tr><td>Year Established</td><td>Since ', CAST(1990 + p_size % 30 AS STRING), '</td></tr><tr><th>Employees</th><td>',
  CASE WHEN p_partkey % 3 = 0 THEN 'none' ELSE concat('about ', {S}, ' people') END, '</td></tr><tr><th>Industry</th><td>', p_type,
  '</td></tr><tr><th>Location</th><td>Austin, TX</td></tr><tr><td>lonely location</td></tr><tr><td>industry</td><td>b</td><td>c</td></tr></table>',
  '<div class="listing-single-content">', CASE WHEN p_partkey % 6 = 0 THEN '' ELSE concat('<p> About ', p_brand, '<p>second') END, '</div></body>'""")
WEBSITEPROPERTIES_FIELDS = """p_name AS title, CASE WHEN p_partkey % 5 = 0 THEN 0.0::DOUBLE ELSE p_size * 1000000.0::DOUBLE + 750000 END AS price,
  p_size * 1000.0::DOUBLE AS revenue, CASE WHEN p_partkey % 4 = 0 THEN 0.0::DOUBLE ELSE 250000.0::DOUBLE END AS cash_flow,
  CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 4 <> 0 THEN round((p_size * 1000000.0::DOUBLE + 750000) / 250000.0::DOUBLE, 2) END AS multiple,
  CASE WHEN p_partkey % 6 = 0 THEN 'Description not found' ELSE concat('About ', p_brand) END AS description,
  1990 + p_size % 30 AS established_year, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS employees, p_type AS industry, 'Austin, TX' AS location"""

FLIPPA = page(f"""'<head><meta property="og:title" content="OG ', p_name, '"><meta ', CASE WHEN p_partkey % 2 = 0 THEN 'name="description"'
    ELSE 'property="og:description"' END, ' content="Meta ', p_brand, '"></head><body>',
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat('<h1>', p_name, ' </h1>') END,
  CASE p_partkey % 3 WHEN 0 THEN concat('<div class="big-price-box">Now USD $', {S}, ',000 and USD $1</div>') WHEN 1 THEN '<div class="price">on request</div>'
    ELSE '<div>' END, '<p>Buy It Now: $', {S}, ',900</p><p>Net Revenue: $', {S}, '.5k a year</p><p>', CASE WHEN p_partkey % 2 = 0 THEN 'Cash Flow' ELSE 'net profit' END,
  ' $', {S}, ',010</p><p>Niche: ', p_type, ', rest</p></body>'""")
FLIPPA_FIELDS = """CASE WHEN p_partkey % 4 = 0 THEN concat('OG ', p_name) ELSE p_name END AS title, concat('Meta ', p_brand) AS description,
  CASE p_partkey % 3 WHEN 0 THEN p_size * 1000.0::DOUBLE WHEN 2 THEN p_size * 1000.0::DOUBLE + 900 END AS price,
  (p_size + 0.5::DOUBLE) * 1000 AS revenue, p_size * 1000.0::DOUBLE + 10 AS cash_flow, p_type AS industry"""

EMPIREFLIPPERS = page(f"""'<head>', CASE WHEN p_partkey % 4 = 1 THEN concat('<meta name="description" content="Meta ', p_brand, '">') ELSE '' END,
  '</head><body><h1> ', p_name, ' </h1>', CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('<div class="info-price x"><b>Listing Price</b> <i>$', {S}, ',354</i></div>') END,
  '<p>Listing Price: $', {S}, ',999</p><ul><li>Avg. Monthly Revenue $', {S}, '</li>\n<li>Avg. Monthly   Profit ', CASE WHEN p_partkey % 5 = 0 THEN '$0' ELSE concat('$', {S}, ',234') END,
  '</li>\n<li>Multiple: ', CASE WHEN p_partkey % 4 = 0 THEN '.' ELSE '41.5x' END, '</li>\n<li>Monetization: ', p_type, ' store\n</li><li>Business Created ',
  CAST(1990 + p_size % 30 AS STRING), '</li></ul>\n', CASE p_partkey % 4 WHEN 0 THEN concat('<div class="business-description"> Full ', p_brand, '</div>')
    WHEN 2 THEN concat('<p>Overview: ', repeat(concat(p_name, ' '), 12), 'end\n</p>') ELSE '' END, '</body>'""")
EMPIREFLIPPERS_FIELDS = """p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN p_size * 1000.0::DOUBLE + 999 ELSE p_size * 1000.0::DOUBLE + 354 END AS price,
  p_size * 12.0::DOUBLE AS revenue, CASE WHEN p_partkey % 5 <> 0 THEN (p_size * 1000.0::DOUBLE + 234) * 12 END AS cash_flow,
  CASE WHEN p_partkey % 4 <> 0 THEN 41.5::DOUBLE END AS multiple, concat(p_type, ' store') AS industry, 1990 + p_size % 30 AS established_year,
  CASE p_partkey % 4 WHEN 0 THEN concat('Full ', p_brand) WHEN 1 THEN concat('Meta ', p_brand)
    WHEN 2 THEN concat(repeat(concat(p_name, ' '), 12), 'end') ELSE 'See listing for details' END AS description"""

ACQUIRE = page(f"""'<body><script id="__NEXT_DATA__" type="application/json">', CASE WHEN p_partkey % 7 = 0 THEN '{{{{"props":{{{{"pageProps":{{{{"listing":{{{{}}}}}}}}}}}}}}}}'
    WHEN p_partkey % 7 = 1 THEN '{{{{bad' ELSE concat('{{{{"props":{{{{"pageProps":{{{{"listing":{{{{"headline":"', p_name, '","about":"About &amp; ', p_brand,
    '","askingPrice":', CAST(p_size * 14000 AS STRING), ',"financialSummary":{{{{"revenue":"', {S}, 'k","profit":',
    CASE WHEN p_partkey % 3 = 0 THEN 'null' ELSE '7000' END, '}}}},"foundedIn":', CAST(1990 + p_size % 30 AS STRING), ',"category":"', p_type, '"}}}}}}}}}}}}}}}}') END,
  '</script><h1>decoy</h1></body>'""")
ACQUIRE_FIELDS = """p_name AS title, concat('About &amp; ', p_brand) AS description, p_size * 14000.0::DOUBLE AS price, p_size * 1000.0::DOUBLE AS revenue,
  CASE WHEN p_partkey % 3 <> 0 THEN 7000.0::DOUBLE END AS cash_flow, CASE WHEN p_partkey % 3 <> 0 THEN p_size * 2.0::DOUBLE END AS multiple,
  1990 + p_size % 30 AS established_year, p_type AS industry"""
ACQUIRE_WHERE = "WHERE p_partkey % 7 > 1"

FEINTERNATIONAL = page(f"""'<body>', CASE p_partkey % 4 WHEN 0 THEN concat('<h1>decoy</h1><h1 class="listing-title"> ', p_name, '</h1>')
    WHEN 1 THEN concat('<h1>', p_name, ' </h1>') WHEN 2 THEN concat('<h2 class="title">', p_name, '</h2>') ELSE '<h2>no</h2>' END,
  CASE p_partkey % 3 WHEN 0 THEN concat('<section class="metrics">Asking Price: $', {S}, 'k; Revenue: $', {S}, ',500; EBITDA $', {S}, '00; 3.25x multiple</section>')
    WHEN 1 THEN concat('<div class="listing-stats">Net Income: ', {S}, ',000</div>') ELSE '' END,
  '<p>For Sale: $', {S}, ',700.</p><p>TTM Revenue: $', {S}, '.5M</p>', CASE WHEN p_partkey % 2 = 0 THEN concat('<span class="category">', p_type, '</span>') ELSE '' END,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '<div class="business-location"> Austin </div>' END, '<p>Established: ', CAST(1990 + p_size % 30 AS STRING),
  '<div class="overview"> ', repeat(concat(p_name, ' '), 150), '</div></body>'""")
FEINTERNATIONAL_FIELDS = """p_name AS title, CASE p_partkey % 3 WHEN 0 THEN p_size * 1000.0::DOUBLE ELSE p_size * 1000.0::DOUBLE + 700 END AS price,
  CASE p_partkey % 3 WHEN 0 THEN p_size * 1000.0::DOUBLE + 500 ELSE p_size * 1000000.0::DOUBLE + 500000 END AS revenue,
  CASE p_partkey % 3 WHEN 0 THEN p_size * 100.0::DOUBLE WHEN 1 THEN p_size * 1000.0::DOUBLE END AS cash_flow,
  CASE p_partkey % 3 WHEN 0 THEN 3.25::DOUBLE END AS multiple, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'SaaS' END AS industry,
  CASE WHEN p_partkey % 5 <> 0 THEN 'Austin' END AS location, 1990 + p_size % 30 AS established_year,
  left(trim(repeat(concat(p_name, ' '), 150)), 1000) AS description"""
FEINTERNATIONAL_WHERE = "WHERE p_partkey % 4 < 3"

WEBSITECLOSERS = page(f"""'<body>', CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 5 = 1 THEN '<h1> </h1>' ELSE concat('<h1> ', p_name, ' </h1>') END,
  '<div class="cfx big wysiwyg"> ', repeat(concat(p_brand, ' &amp; '), 200), '</div><div class="sb-table"><div class="line"><div class="left"> Asking Price </div>',
  '<div class="right"> $', {S}, ',500 </div></div><div class="line"><div class="left">Cash Flow</div><div class="right">', CASE WHEN p_partkey % 3 = 0 THEN 'N/A' ELSE '$1.5M' END,
  '</div></div><div class="line"><div class="left">Gross Income</div><div class="right">$', {S}, 'mm</div></div>',
  '<div class="line"><div class="left">Year Established</div><div class="right">in ', CASE WHEN p_partkey % 4 = 0 THEN '99' ELSE CAST(1990 + p_size % 30 AS STRING) END,
  '</div></div><div class="line"><div class="left">Asking Price alone</div></div></div></body>'""")
WEBSITECLOSERS_FIELDS = """p_name AS title, left(trim(repeat(concat(p_brand, ' & '), 200)), 2000) AS description, p_size * 1000.0::DOUBLE + 500 AS price,
  CASE WHEN p_partkey % 3 <> 0 THEN 1500000.0::DOUBLE END AS cash_flow, p_size * 1000000.0::DOUBLE AS revenue,
  CASE WHEN p_partkey % 4 <> 0 THEN 1990 + p_size % 30 END AS established_year"""
WEBSITECLOSERS_WHERE = "WHERE p_partkey % 5 > 1"

LISTING_PAGES = {
    "QuietLight": (QUIETLIGHT, QUIETLIGHT_FIELDS, ""),
    "BizBuySell": (BIZBUYSELL, BIZBUYSELL_FIELDS, ""),
    "BizQuest": (BIZQUEST, BIZQUEST_FIELDS, ""),
    "WebsiteProperties": (WEBSITEPROPERTIES, WEBSITEPROPERTIES_FIELDS, ""),
    "Flippa": (FLIPPA, FLIPPA_FIELDS, ""),
    "EmpireFlippers": (EMPIREFLIPPERS, EMPIREFLIPPERS_FIELDS, ""),
    "Acquire": (ACQUIRE, ACQUIRE_FIELDS, ACQUIRE_WHERE),
    "FEInternational": (FEINTERNATIONAL, FEINTERNATIONAL_FIELDS, FEINTERNATIONAL_WHERE),
    "WebsiteClosers": (WEBSITECLOSERS, WEBSITECLOSERS_FIELDS, WEBSITECLOSERS_WHERE),
}


def mixed_listing_pages() -> str:
    """Every part as one listing page, its site going by the key."""
    def html_of(select: str) -> str:
        return select[len("SELECT p_partkey, "):select.rindex(" AS html")]
    names = " ".join(f"WHEN {n} THEN '{site}'" for n, site in enumerate(LISTING_PAGES))
    pages = " ".join(f"WHEN {n} THEN {html_of(html)}" for n, (html, _, _) in enumerate(LISTING_PAGES.values()))
    return (f"SELECT p_partkey, CASE p_partkey % 9 {names} END AS source_site, CASE p_partkey % 9 {pages} END AS html "
            f"FROM ({BIZQUEST_PARTS}) t")


LISTING_URL = "concat('https://x.example/business-for-sale/deal-', CAST(p_partkey AS STRING), '/saas/')"

# --- results pages ------------------------------------------------------------------
# nine sites x five searches; page p links to items 2p, 2p+1, 2p+2, which stop growing at 60
RESULT_KEYS = """SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'QuietLight' WHEN 1 THEN 'BizBuySell' WHEN 2 THEN 'BizQuest'
    WHEN 3 THEN 'WebsiteProperties' WHEN 4 THEN 'Flippa' WHEN 5 THEN 'EmpireFlippers' WHEN 6 THEN 'Acquire'
    WHEN 7 THEN 'FEInternational' ELSE 'WebsiteClosers' END AS source_site,
  concat('search', CAST(CAST(floor(p_partkey / 9) AS BIGINT) % 5 AS STRING)) AS search_url,
  CAST(floor(p_partkey / 45) + 1 AS INT) AS page FROM {part}"""
_ITEM = [f"CAST(least(page * 2 + {n}, 60) AS STRING)" for n in range(3)]


def _each(template: str) -> str:
    """The template once per item, ``@`` being the item number."""
    return ", ".join("'" + template.replace("@", f"', {item}, '") + "'" for item in _ITEM)


_NEXT = "CASE WHEN page < 25 THEN '<a class=\"next page-numbers\" href=\"/n\">x</a><a class=\"next-page-link\">y</a>' ELSE '' END"
RESULT_PAGES = f"""SELECT p_partkey, source_site, search_url, page, CASE source_site
  WHEN 'QuietLight' THEN concat('<div class="listing-card">', {_each('<a class="listing-card__link" href="/listings/@">t</a>')},
    '<a class="listing-card__link" href="/other/">no</a><a href="/listings/no">n</a></div>', {_NEXT})
  WHEN 'BizBuySell' THEN concat(CASE WHEN page % 4 = 3 THEN '<script type="application/ld+json">{{{{bad</script>' ELSE
    concat('<script type="application/ld+json">{{{{"about":[', {_each('{{"item":{{"url":"https://www.bizbuysell.com/b/@"}}}},')}, '{{{{"item":{{{{}}}}}}}}]}}}}</script>') END,
    {_each('<div class="search-result-card"><a href="/css/@"></a><a>no href</a></div>')})
  WHEN 'BizQuest' THEN concat({_each('<a href="/business-for-sale/d@/">t</a>')},
    '<a href="/business-for-sale/">all</a><a href="/business-for-sale/x">no</a><a href="https://www.bizquest.com/business-for-sale/abs/">abs</a>')
  WHEN 'WebsiteProperties' THEN concat({_each('<article class="listing-card"><div><h3 class="mb-2 t"><a href="https://wp.example/@">t</a></h3><a href="/no">n</a></div></article>')}, {_NEXT})
  WHEN 'Flippa' THEN concat({_each('<a href="/10000@0">t</a><a href="https://flippa.com/20000@0">t</a>')},
    '<a href="https://else.example/1234567">no</a><a href="/123">no</a><a href="/1234567/x">no</a>')
  WHEN 'EmpireFlippers' THEN concat({_each('<div class="listing-item"><p><a href="/listing/@/">t</a><a href="/blog/">n</a></p></div>')}, {_NEXT})
  WHEN 'Acquire' THEN concat('<script id="__NEXT_DATA__">{{{{"props":{{{{"pageProps":{{{{"listings":[', {_each('{{"slug":"s@"}},')}, '{{{{"slug":""}}}},{{{{"x":1}}}}]}}}}}}}}}}}}</script>')
  WHEN 'FEInternational' THEN concat({_each('<a class="card_businesses_item" href="/b/@">t</a>')}, '<a href="/b/no">n</a>')
  ELSE concat({_each('<div class="post_item"><a class="post_title" href="/d/@">t</a></div>')}, '<a class="post_title" href="/out">n</a>') END AS html
FROM ({RESULT_KEYS}) k"""

# what each results page offers, as rows: page key, url, and whether it is a spare (CSS) link
RESULT_LINKS = f"""items AS (SELECT k.*, n, least(page * 2 + n, 60) AS item FROM ({RESULT_KEYS}) k, range(0, 3) r(n)),
offered AS (
  SELECT source_site, search_url, page, false AS spare, CASE source_site WHEN 'QuietLight' THEN concat('https://quietlight.com/listings/', item)
    WHEN 'BizBuySell' THEN concat('https://www.bizbuysell.com/b/', item) WHEN 'BizQuest' THEN concat('https://www.bizquest.com/business-for-sale/d', item, '/')
    WHEN 'WebsiteProperties' THEN concat('https://wp.example/', item) WHEN 'Flippa' THEN concat('https://flippa.com/10000', item, '0')
    WHEN 'EmpireFlippers' THEN concat('https://empireflippers.com/listing/', item, '/') WHEN 'Acquire' THEN concat('https://acquire.com/app/listing/s', item)
    WHEN 'FEInternational' THEN concat('https://feinternational.com/b/', item) ELSE concat('https://www.websiteclosers.com/d/', item) END AS url
  FROM items WHERE NOT (source_site = 'BizBuySell' AND page % 4 = 3)
  UNION ALL SELECT source_site, search_url, page, false, concat('https://flippa.com/20000', item, '0') FROM items
    WHERE source_site = 'Flippa'
  UNION ALL SELECT source_site, search_url, page, false, 'https://www.bizquest.com/business-for-sale/abs/' FROM items
    WHERE source_site = 'BizQuest' AND n = 0
  UNION ALL SELECT source_site, search_url, page, true, concat('https://www.bizbuysell.com/css/', item) FROM items
    WHERE source_site = 'BizBuySell')"""

# --- results-page cards -------------------------------------------------------------
_J = range(6)


def _cards(per_card: dict[int, str]) -> str:
    return page("'<body>', " + ", ".join(per_card[j] for j in sorted(per_card)) + ", '</body>'")


def _n(j: int) -> str:
    return f"CAST(p_size + {j} AS STRING)"


CARD_PAGES = {
    "BizQuest": _cards({j: (
        f"""'<div class="listing big">', """
        + ("'<em>no link</em>'" if j == 2 else
           f"""concat('<a href="/business-for-sale/tiny-deal-', {K}, '-x{j}/BW1/">{'Great value shop' if j % 2 == 0 else 'short'}</a>')""")
        + f""", '<b> $', {_n(j)}, ',500 </b> Cash Flow: $', {S}, ',0{j}0 <i>in Cedar Park, TX</i></div>'""") for j in _J}),
    "EmpireFlippers": _cards({j: (
        f"""'<div class="x-listing">{'<h3>Store </h3>' if j < 2 else ''}<a href="/listing/', {K}, '-x{j}/">View</a><span>$', {_n(j)},
        ',500</span> Monthly Profit: $', {S}, '00 Monthly Revenue: $', {S}, ',000 {('Amazon', 'SaaS', 'blog', 'fba')[j]}</div>'""")
        for j in range(4)}),
    "WebsiteProperties": _cards({j: (
        f"""'<{'article class="listing"' if j % 2 else 'div class="listing-item"'}><h2>', p_name, '</h2><a href="/listing-', {K}, '-x{j}">x</a> $', {_n(j)},
        '.5k Cash Flow $', {S}, '00 Sales: $', {S}, ',000</{'article' if j % 2 else 'div'}>'""") for j in range(4)}),
    "QuietLight": _cards({j: (
        f"""'<div class="listing-card"><span class="listing-title">', p_name, '</span><a href="https://quietlight.com/listings/', {K}, '-x{j}">x</a> $', {_n(j)},
        '.25M SDE: $', {S}, ',000 Revenue $', {S}, ',900 {('SaaS', 'ecommerce', 'other', 'more')[j]}</div>'""") for j in range(4)}),
    "BizBuySell": _cards({j: (
        f"""'<div class="{'listing' if j % 2 else 'my-listing-card'}"><h3>', p_name, '</h3><a href="/Business-', {K}, '-x{j}/">x</a> <b>$', {_n(j)},
        '</b> {'Asking Price: $' if j == 0 else 'for '}', {S}, ',500 Cash Flow: $', {S}, ',000 Gross Revenue: $', {S}, ',900 Cedar Park, TX {('Restaurant', 'Retail', 'service', 'x')[j]}</div>'""")
        for j in range(4)}),
}
_MONEY_LABEL = "concat('$', format('{{:,}}', {0}), '/month')"
CARD_FIELDS = {
    "BizQuest": (5, "WHERE j <> 2", """CASE WHEN j % 2 = 0 THEN 'Great value shop' ELSE concat('Tiny Deal ', p_partkey, ' X', j) END AS title,
      concat('https://www.bizquest.com/business-for-sale/tiny-deal-', p_partkey, '-x', j, '/BW1/') AS listing_url,
      (p_size + j) * 1000.0::DOUBLE + 500 AS asking_price, concat('$', p_size + j, ',500') AS asking_price_raw,
      p_size * 1000.0::DOUBLE + j * 10 AS cash_flow, concat('Cash Flow: $', p_size, ',0', j, '0') AS cash_flow_raw,
      p_size * 1000.0::DOUBLE + j * 10 AS profit, concat('Cash Flow: $', p_size, ',0', j, '0') AS profit_raw, CAST(NULL AS DOUBLE) AS revenue,
      CAST(NULL AS VARCHAR) AS revenue_raw, 'Cedar Park, TX' AS location, 'Cedar Park' AS city, 'TX' AS state, 'Business' AS category, 'General' AS business_type"""),
    "EmpireFlippers": (3, "", f"""CASE WHEN j < 2 THEN 'Store' ELSE 'View' END AS title,
      concat('https://empireflippers.com/listing/', p_partkey, '-x', j, '/') AS listing_url,
      (p_size + j) * 1000.0::DOUBLE + 500 AS asking_price, concat('$', p_size + j, ',500') AS asking_price_raw, CAST(NULL AS DOUBLE) AS cash_flow,
      CAST(NULL AS VARCHAR) AS cash_flow_raw, p_size * 1200.0::DOUBLE AS profit, {_MONEY_LABEL.format('p_size * 100')} AS profit_raw,
      p_size * 12000.0::DOUBLE AS revenue, {_MONEY_LABEL.format('p_size * 1000')} AS revenue_raw, CAST(NULL AS VARCHAR) AS location,
      CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
      CASE j WHEN 0 THEN 'E-commerce' WHEN 1 THEN 'Technology' ELSE 'Online' END AS category,
      CASE j WHEN 0 THEN 'E-commerce' WHEN 1 THEN 'Technology' ELSE 'Online Business' END AS business_type"""),
    "WebsiteProperties": (3, "", f"""p_name AS title, concat('https://websiteproperties.com/listing-', p_partkey, '-x', j) AS listing_url,
      (p_size + j + 0.5::DOUBLE) * 1000 AS asking_price, concat('$', p_size + j, '.5k') AS asking_price_raw, p_size * 1200.0::DOUBLE AS cash_flow,
      CAST(NULL AS VARCHAR) AS cash_flow_raw, p_size * 1200.0::DOUBLE AS profit, {_MONEY_LABEL.format('p_size * 100')} AS profit_raw,
      p_size * 1000.0::DOUBLE AS revenue, concat('Sales: $', p_size, ',000') AS revenue_raw, CAST(NULL AS VARCHAR) AS location,
      CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, 'Online' AS category, 'Online Business' AS business_type"""),
    "QuietLight": (3, "", """p_name AS title, concat('https://quietlight.com/listings/', p_partkey, '-x', j) AS listing_url,
      (p_size + j + 0.25::DOUBLE) * 1000000 AS asking_price, concat('$', p_size + j, '.25M') AS asking_price_raw, p_size * 1000.0::DOUBLE AS cash_flow,
      CAST(NULL AS VARCHAR) AS cash_flow_raw, p_size * 1000.0::DOUBLE AS profit, concat('SDE: $', p_size, ',000') AS profit_raw,
      p_size * 1000.0::DOUBLE + 900 AS revenue, concat('Revenue $', p_size, ',900') AS revenue_raw, CAST(NULL AS VARCHAR) AS location,
      CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
      CASE j WHEN 0 THEN 'Technology' WHEN 1 THEN 'E-commerce' ELSE 'Online' END AS category,
      CASE j WHEN 0 THEN 'SaaS' WHEN 1 THEN 'E-commerce' ELSE 'Online Business' END AS business_type"""),
    "BizBuySell": (3, "", """p_name AS title, concat('https://www.bizbuysell.com/Business-', p_partkey, '-x', j, '/') AS listing_url,
      CASE WHEN j = 0 THEN p_size * 1000.0::DOUBLE + 500 ELSE CAST(p_size + j AS DOUBLE) END AS asking_price,
      CASE WHEN j = 0 THEN concat('Asking Price: $', p_size, ',500') ELSE concat('$', p_size + j) END AS asking_price_raw,
      p_size * 1000.0::DOUBLE AS cash_flow, concat('Cash Flow: $', p_size, ',000') AS cash_flow_raw, p_size * 1000.0::DOUBLE AS profit,
      CAST(NULL AS VARCHAR) AS profit_raw, p_size * 1000.0::DOUBLE + 900 AS revenue, concat('Gross Revenue: $', p_size, ',900') AS revenue_raw,
      'Cedar Park, TX' AS location, 'Cedar Park' AS city, 'TX' AS state,
      CASE j WHEN 0 THEN 'Restaurant' WHEN 1 THEN 'Retail' ELSE 'Service' END AS category,
      CASE j WHEN 0 THEN 'Restaurant' WHEN 1 THEN 'Retail' ELSE 'Service' END AS business_type"""),
}

# --- one page with everything the quality checks look at ---------------------------
QUALITY = page(f"""'<head><title>', CASE p_partkey % 7 WHEN 0 THEN 'Error 404' WHEN 1 THEN 'Page Not Found' ELSE p_name END, '</title>',
  '<meta property="og:title" content="', p_name, '"><meta property="product:Price" content="', {S}, '"><meta property="og:image" content="x">',
  '<meta name="description" content="z"><script src="/a.js"></script><script id="state">{{{{}}}}</script><script>var k=', {K}, ';</script></head><body>',
  '<dl><dt>Asking Price</dt><dd> $', {S}, ',500 </dd><dt>Cash Flow</dt><dd>$', {S}, ',000</dd><dt>Other<dd>x<dt>last</dl>',
  '<table><tr><th>Year</th><th>Sales</th></tr><tr><td>2020</td><td> $', {S}, '</td></tr><tr></tr></table>',
  '<section class="box"><span class="v">about $', {S}, ',354 now</span></section><article><p>Price $', {S}, ',900 <i>revenue</i> $', {S}, '00k profit: $', {S},
  ',111 <a href="/business-for-sale/', {K}, '/">go</a></article></body>'""")

#: Prices and links in containers within containers.
CONTAINERS = page(f"""'<body><div class="grid"><div class="card a"><h3><a href="/l/', {K}, '">t</a></h3><p>Price: <b>$', {S}, ',000</b></p></div>',
  '<div class="card b"><span>$', {S}, '</span></div>', CASE WHEN p_partkey % 2 = 0 THEN concat('<section><p>$1 and <i>$2</i></p><a>no</a><em><a href="/m/', {K},
  '">m</a></em></section>') ELSE '<section><p>$1</p></section>' END, '</div><p>$9 alone</p><script>var a = "$5";</script></body>'""")

#: Fields that a BizQuest record has, beside its URL, and how many of them are filled.
_BQ_COUNT = """8 + CASE WHEN p_partkey % 4 < 3 THEN 6 ELSE 0 END + CASE WHEN p_partkey % 5 < 3 OR (p_partkey % 5 = 3 AND p_partkey % 4 < 3) THEN 3 ELSE 0 END
  + CASE WHEN p_partkey % 3 < 2 THEN 4 ELSE 0 END + CASE WHEN p_partkey % 4 < 2 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 0 END
  + CASE p_partkey % 3 WHEN 0 THEN 3 WHEN 1 THEN {estate} + 1 ELSE 0 END - 1"""


def record_sizes() -> str:
    """Per mixed listing page, the fields its site's record has and how many are filled, from the page's columns."""
    branches = []
    # amounts or numbers that are there but unreadable are fields without a value
    unread = {"QuietLight": "CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END", "WebsiteClosers": "CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END",
              "WebsiteProperties": "CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END", "FEInternational": "1",
              "Acquire": "CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END"}
    for n, (site, (_, fields, where)) in enumerate(LISTING_PAGES.items()):
        keep = f"{where} AND" if where else "WHERE"
        names = re.findall(r" AS ([a-z_]+)(?:,|$)", fields)
        filled = "1 + " + " + ".join(f"CASE WHEN CAST({c} AS STRING) NOT IN ('', '0', '0.0', 'false') THEN 1 ELSE 0 END" for c in names)
        total = "1 + " + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in names) + f" + {unread.get(site, '0')}"
        filled += " + 1" if site == "FEInternational" else ""  # its record names the site
        if site == "BizQuest":
            total, filled = "1 + " + _BQ_COUNT.format(estate=1), "1 + " + _BQ_COUNT.format(estate=0)
        branches.append(f"SELECT '{site}' AS source_site, p_partkey, {filled} AS filled_fields, {total} AS total_fields "
                        f"FROM (SELECT p_partkey{'' if site == 'BizQuest' else ', ' + fields} FROM part {keep} p_partkey % 9 = {n}) q{n}")
    return " UNION ALL ".join(branches)
