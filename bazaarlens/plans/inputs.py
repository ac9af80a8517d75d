"""Engine inputs derived from the given tables.

Each input is one SELECT over whole tables. Spark runs it with the tables bound to ``{name}``;
the checking SQL uses the same text as a common table expression, so both sides start equal.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.plans.registry import table

RAW_LISTINGS = """
SELECT CASE k % 6 WHEN 0 THEN 'QuietLight' WHEN 1 THEN 'BizBuySell' WHEN 2 THEN 'BizQuest'
         WHEN 3 THEN 'WebsiteProperties' WHEN 4 THEN 'EmpireFlippers' ELSE 'WebsiteClosers' END AS source_site,
       concat('https://site', CAST(k % 6 AS STRING), '.example/listing/',
              CASE WHEN k % 11 = 0 THEN 'amazon-' WHEN k % 13 = 0 THEN 'fba-' ELSE '' END,
              CAST(k AS STRING), '/') AS listing_url,
       p_partkey AS seq, p_name AS title,
       CASE p_partkey % 9 WHEN 0 THEN concat('$', CAST(p_size AS STRING), ',500')
         WHEN 1 THEN concat('$', CAST(p_size AS STRING), 'k')
         WHEN 2 THEN concat(CAST(p_size AS STRING), '.25M')
         WHEN 3 THEN concat(CAST(p_size AS STRING), '.5 million')
         WHEN 4 THEN concat(CAST(p_size AS STRING), 'mm')
         WHEN 5 THEN 'Not Disclosed' WHEN 6 THEN ',' WHEN 7 THEN '' ELSE NULL END AS price_text,
       CASE WHEN p_partkey % 4 = 0 THEN NULL
         ELSE concat('$', CAST(p_size * 3 AS STRING), ',000') END AS cash_flow_text,
       CASE p_partkey % 12 WHEN 0 THEN 'Private Label amazon brand' WHEN 1 THEN 'Amazon Wholesale account'
         WHEN 2 THEN 'amazon dropship store' WHEN 3 THEN 'amazon affiliate blog' WHEN 4 THEN 'Kindle catalogue'
         WHEN 5 THEN 'audible titles' WHEN 6 THEN 'bulk purchasing office'
         WHEN 7 THEN 'seller financing available, sba' WHEN 8 THEN '' WHEN 9 THEN NULL
         ELSE concat(p_type, ' workshop, Austin, TX established ', CAST(1890 + p_size * 3 AS STRING)) END AS description,
       CASE WHEN p_partkey % 5 = 0 THEN 'E-commerce' WHEN p_partkey % 5 = 1 THEN NULL ELSE p_type END AS industry
FROM (SELECT *, CASE WHEN p_partkey % 20 = 19 THEN p_partkey - 6 ELSE p_partkey END AS k FROM {part}) t
"""

RUNS = """
SELECT concat('run_', CAST(user_id AS STRING)) AS run_id,
       CASE user_id % 3 WHEN 0 THEN 'QuietLight' WHEN 1 THEN 'BizQuest' ELSE 'Flippa' END AS site_name,
       event_id, ts, event_type
FROM {events}
"""

FRONTIER = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'BizQuest' WHEN o_orderkey % 3 = 1 THEN 'QuietLight'
         ELSE 'WebsiteProperties' END AS source_site,
       o_orderpriority AS search_url, CAST(ascii(o_orderpriority) - 49 AS INT) AS search_pos,
       CAST(o_orderkey % 40 + 1 AS INT) AS page, o_orderkey AS pos,
       concat('/listing/', CAST(o_custkey % 150 AS STRING), '/') AS url
FROM {orders}
"""

JSONLD = """
SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN '{{bad'
  ELSE concat('{{"name":"', c_name, '","offers":{{"price":"', CAST(c_custkey * 1000 AS STRING),
       '","availableAtOrFrom":{{"address":{{',
       CASE c_custkey % 4 WHEN 0 THEN '"addressLocality":"Austin","addressRegion":"TX"'
         WHEN 1 THEN '"addressLocality":"Austin"' WHEN 2 THEN '"addressRegion":"TX"' ELSE '' END, '}}}}}}}}') END AS body
FROM {customer}
"""

NEXTDATA = """
SELECT c_custkey, CASE WHEN c_custkey % 19 = 0 THEN '{{"props":{{"pageProps":{{"listing":{{}}}}}}}}'
  WHEN c_custkey % 17 = 0 THEN '[1' WHEN c_custkey % 13 = 0 THEN '{{"props":{{}}}}'
  ELSE concat('{{"props":{{"pageProps":{{"listing":{{"headline":"', c_name, '","about":"About ', c_mktsegment,
       '","askingPrice":', CAST(c_custkey * 21 AS STRING), ',"financialSummary":{{"revenue":"',
       CAST(c_custkey + 5 AS STRING), 'k","profit":', CASE WHEN c_custkey % 5 = 0 THEN 'null'
       ELSE CAST(c_custkey * 7 AS STRING) END, '}},"foundedIn":', CAST(1990 + c_nationkey AS STRING),
       ',"category":"', c_mktsegment, '"}}}}}}}}') END AS body
FROM {customer}
"""

REQUESTS = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '{{}}' WHEN 2 THEN '{{"trigger_type":"manual"}}'
  WHEN 3 THEN '{{"trigger_type":{{"type":"api"}}}}' ELSE '{{"trigger_type":{{}}}}' END AS body, ts
FROM {events}
"""

# site settings of every shape, one per supplier
SITE_CONFIGS = """
SELECT s_suppkey, CASE s_suppkey % 9 WHEN 0 THEN 'QuietLight' WHEN 1 THEN 'BizBuySell' WHEN 2 THEN 'BizQuest'
         WHEN 3 THEN 'WebsiteProperties' WHEN 4 THEN 'Flippa' WHEN 5 THEN 'EmpireFlippers' WHEN 6 THEN 'Acquire'
         WHEN 7 THEN 'FEInternational' ELSE 'WebsiteClosers' END AS name,
       CASE WHEN s_suppkey % 4 = 0 THEN concat('https://shop.example/e/', CAST(s_suppkey AS STRING), '/') END AS ecommerce_url,
       CASE WHEN s_suppkey % 6 < 2 THEN concat('https://shop.example/a/', CAST(s_suppkey AS STRING), '/') END AS amazon_url,
       CASE WHEN s_suppkey % 5 = 2 THEN concat('https://shop.example/l/', CAST(s_suppkey AS STRING), '/') END AS list_url,
       CASE WHEN s_suppkey % 7 <> 3 THEN concat('https://shop.example/s/', CAST(s_suppkey AS STRING),
         CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '/?q=1' END) END AS search_url,
       CASE WHEN s_suppkey % 8 = 5 THEN NULL ELSE s_suppkey % 8 <> 6 END AS enabled
FROM {supplier}
"""

# two captures of each page, plain and rendered, some of them failed
CAPTURES = """
SELECT page_id, url, CASE WHEN page_id % 7 = 0 THEN NULL ELSE html END AS html, false AS rendered, 1 AS fetch_no FROM {pages}
UNION ALL
SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN NULL ELSE concat(html, '<!-- rendered -->') END AS html,
  true AS rendered, 2 AS fetch_no FROM {pages}
"""


def cte(sql: str, **names: str) -> str:
    """The input as checking SQL, tables under their own names."""
    tables = {t: t for t in ("part", "events", "orders", "customer", "supplier", "pages")}
    return sql.format(**(tables | names)).strip()


def bind(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    """The input as a DataFrame. ``spread`` is for inputs whose rows are parsed right after."""
    names = [t for t in ("part", "events", "orders", "customer", "supplier", "pages") if "{" + t + "}" in sql]
    frames = {t: table(spark, sf_dir, t) for t in names}
    return spark.sql(sql, **{t: _dealt(f) if spread else f for t, f in frames.items()})


def _dealt(df: DataFrame) -> DataFrame:
    """Narrow table rows dealt out by their key, before pages are rendered from them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.columns[0])


# --- checking SQL for the two amount parsers, stated case by case -----------------------
def sql_number(x: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({x}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END")


def sql_price_base(c: str) -> str:
    t = f"trim(replace(replace(lower({c}), '$', ''), ',', ''))"
    return (f"CASE WHEN contains({t}, 'm') THEN {sql_number(f'''replace({t}, 'm', '')''')} * 1000000.0::DOUBLE "
            f"WHEN contains({t}, 'k') THEN {sql_number(f'''replace({t}, 'k', '')''')} * 1000.0::DOUBLE "
            f"ELSE {sql_number(t)} END")


def sql_price_suffix(c: str) -> str:
    t = f"trim(replace(replace({c}, '$', ''), ',', ''))"
    tries = []
    for suffix, factor in (("k", "1000"), ("thousand", "1000"), ("m", "1000000"), ("mil", "1000000"),
                           ("million", "1000000"), ("mm", "1000000"), ("b", "1000000000"), ("billion", "1000000000")):
        cut = sql_number(f"left({t}, greatest(length({t}) - {len(suffix)}, 0))")
        tries.append(f"CASE WHEN suffix(lower({t}), '{suffix}') THEN ({cut}) * {factor}.0::DOUBLE END")
    return f"COALESCE({', '.join(tries)}, {sql_number(t)}, 0.0::DOUBLE)"
