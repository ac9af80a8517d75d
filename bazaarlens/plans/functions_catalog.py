"""Registered checks of the column functions (C text rules, D)."""
from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions import classify, money, text as tx
from bazaarlens.operators import extract
from bazaarlens.plans import inputs as i
from bazaarlens.plans.registry import query, table

C = F.col
LISTINGS = f"WITH listings AS ({i.cte(i.RAW_LISTINGS)})"


def _listings(spark, sf_dir):
    return i.bind(spark, sf_dir, i.RAW_LISTINGS)


def _quoted(words):
    return [w.replace("'", "''") for w in words]


def _contains_any(t, words):
    return "(" + " OR ".join(f"contains({t}, '{w}')" for w in _quoted(words)) + ")"


@query("d1_parse_price_base", f"""{LISTINGS}
SELECT seq, {i.sql_price_base('price_text')} AS price, {i.sql_price_base('cash_flow_text')} AS cash_flow,
  {i.sql_price_base('description')} AS description_price FROM listings""")
def d1(spark, sf_dir):
    return _listings(spark, sf_dir).select(
        "seq", money.parse_price_base(C("price_text")).alias("price"),
        money.parse_price_base(C("cash_flow_text")).alias("cash_flow"),
        money.parse_price_base(C("description")).alias("description_price"))


@query("d2_parse_price_suffix", f"""{LISTINGS}
SELECT seq, {i.sql_price_suffix('price_text')} AS price, {i.sql_price_suffix('cash_flow_text')} AS cash_flow,
  {i.sql_price_suffix("concat(CAST(seq % 90 AS VARCHAR), CASE seq % 8 WHEN 0 THEN 'b' WHEN 1 THEN ' Billion' "
                      "WHEN 2 THEN ' thousand' WHEN 3 THEN 'mil' WHEN 4 THEN 'K' WHEN 5 THEN 'kk' WHEN 6 THEN '.5M' ELSE 'e3' END)")} AS scaled
FROM listings""")
def d2(spark, sf_dir):
    word = F.get(F.array(*[F.lit(w) for w in ("b", " Billion", " thousand", "mil", "K", "kk", ".5M", "e3")]),
                 (C("seq") % 8).cast("int"))
    return _listings(spark, sf_dir).select(
        "seq", money.parse_price_suffix(C("price_text")).alias("price"),
        money.parse_price_suffix(C("cash_flow_text")).alias("cash_flow"),
        money.parse_price_suffix(F.concat((C("seq") % 90).cast("string"), word)).alias("scaled"))


@query("d3_annualise", f"""{LISTINGS}, m AS (SELECT seq, {i.sql_price_suffix('cash_flow_text')} AS monthly FROM listings)
SELECT seq, monthly * 12 AS annual, CASE WHEN monthly <> 0 THEN monthly * 12 END AS annual_if_any,
  concat('$', format('{{:,}}', CAST(monthly AS BIGINT)), '/month') AS label FROM m""")
def d3(spark, sf_dir):
    m = _listings(spark, sf_dir).select("seq", money.parse_price_suffix(C("cash_flow_text")).alias("monthly"))
    return m.select("seq", money.annualise(C("monthly")).alias("annual"),
                    money.annualise(tx.present(C("monthly"))).alias("annual_if_any"),
                    money.per_month_label(C("monthly")).alias("label"))


@query("d4_multiple", f"""{LISTINGS}, a AS (SELECT seq, seq % 50 * 1000.0::DOUBLE + 700 AS price,
  CASE WHEN seq % 4 = 0 THEN NULL WHEN seq % 4 = 1 THEN 0.0::DOUBLE ELSE 7000.0::DOUBLE END AS cash_flow FROM listings)
SELECT seq, CASE WHEN price <> 0 AND cash_flow <> 0 THEN round(price / cash_flow, 2) END AS multiple FROM a""")
def d4(spark, sf_dir):
    a = _listings(spark, sf_dir).select(
        "seq", (C("seq") % 50 * 1000.0 + 700).alias("price"),
        F.when(C("seq") % 4 == 1, 0.0).when(C("seq") % 4 > 1, 7000.0).alias("cash_flow"))
    return a.select("seq", money.multiple(C("price"), C("cash_flow")).alias("multiple"))


@query("d5_revenue_from_margin", f"""{LISTINGS}, a AS (
  SELECT seq, {i.sql_price_base('cash_flow_text')} AS cash_flow, CAST(seq % 41 AS DOUBLE) AS margin FROM listings)
SELECT seq, CASE WHEN margin > 0 THEN cash_flow / (margin / 100) END AS revenue,
  CASE WHEN margin > 0 THEN concat('Estimated from ', CAST(margin / 100 * 100 AS VARCHAR), '% margin') END AS revenue_raw FROM a""")
def d5(spark, sf_dir):
    margin = (C("seq") % 41).cast("double")
    return _listings(spark, sf_dir).select(
        "seq", money.revenue_from_margin(money.parse_price_base(C("cash_flow_text")), margin).alias("revenue"),
        money.revenue_from_margin_label(margin).alias("revenue_raw"))


@query("d6_strip_price_label", f"""{LISTINGS}, a AS (SELECT seq, CASE WHEN seq % 6 = 0 THEN 'Asking Price: Accepting Offers'
  ELSE concat('Asking Price: ', coalesce(price_text, ''), ' + Inventory') END AS t FROM listings),
b AS (SELECT seq, trim(replace(replace(lower(t), 'asking price:', ''), '+ inventory', '')) AS s FROM a)
SELECT seq, s AS label_free, CASE WHEN contains(s, 'accepting offers') THEN 0.0::DOUBLE ELSE {i.sql_price_base('s')} END AS price FROM b""")
def d6(spark, sf_dir):
    t = F.when(C("seq") % 6 == 0, "Asking Price: Accepting Offers").otherwise(
        F.concat(F.lit("Asking Price: "), F.coalesce(C("price_text"), F.lit("")), F.lit(" + Inventory")))
    labels = ("asking price:", "+ inventory")
    return _listings(spark, sf_dir).select("seq", t.alias("t")).select(
        "seq", money.strip_price_label(C("t"), *labels).alias("label_free"),
        money.labelled_price(C("t"), *labels).alias("price"))


_YEAR_TEXT = ("concat(coalesce(description, ''), CASE seq % 4 WHEN 0 THEN ' founded 1776, operating since 1999' "
              "WHEN 1 THEN ' 2010 founded' WHEN 2 THEN ' in business since: 2024' ELSE '' END)")


def _sql_year(pattern):
    y = f"TRY_CAST(nullif(regexp_extract(t, '(?i){pattern}', 1), '') AS INTEGER)"
    return f"CASE WHEN {y} BETWEEN 1900 AND 2025 THEN {y} END"


@query("d7_year_in_range", f"""{LISTINGS}, a AS (SELECT seq, {_YEAR_TEXT} AS t FROM listings)
SELECT seq, COALESCE({', '.join(_sql_year(p) for p in fv.BQ_YEAR)}) AS established_year FROM a""")
def d7(spark, sf_dir):
    return _listings(spark, sf_dir).select("seq", F.expr(_YEAR_TEXT).alias("t")).select(
        "seq", money.year_in_range(C("t"), fv.BQ_YEAR).alias("established_year"))


@query("d8_first_int", f"""{LISTINGS}
SELECT seq, TRY_CAST(nullif(regexp_extract(description, '[0-9]{{4}}', 0), '') AS INTEGER) AS year,
  TRY_CAST(nullif(regexp_extract(concat(price_text, ' by ', title, seq), '[0-9]+', 0), '') AS INTEGER) AS number FROM listings
""")
def d8(spark, sf_dir):
    return _listings(spark, sf_dir).select(
        "seq", money.first_int(C("description"), r"\d{4}").alias("year"),
        # a NULL text counts as empty here, as in the checking SQL
        money.first_int(F.concat(F.coalesce("price_text", F.lit("")), F.lit(" by "), "title", C("seq").cast("string")))
        .alias("number"))


@query("d9_title_from_slug", """
WITH u AS (SELECT p_partkey, concat('https://x.example/business-for-sale/', replace(p_name, ' ', '-'), '-', p_size,
  'k-', lower(p_type), CASE WHEN p_partkey % 9 = 0 THEN '' ELSE '/BW1/' END) AS url FROM part),
w AS (SELECT p_partkey, unnest(string_split(replace(regexp_extract(url, '/business-for-sale/([^/]+)/', 1), '-', ' '), ' ')) AS word,
  generate_subscripts(string_split(regexp_extract(url, '/business-for-sale/([^/]+)/', 1), '-'), 1) AS nth FROM u)
SELECT p_partkey, nullif(string_agg(CASE WHEN regexp_matches(word, '^[0-9]') THEN upper(word)
  ELSE concat(upper(left(word, 1)), lower(substr(word, 2))) END, ' ' ORDER BY nth), '') AS title FROM w GROUP BY p_partkey""")
def d9(spark, sf_dir):
    url = F.concat(F.lit("https://x.example/business-for-sale/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"),
                   C("p_size").cast("string"), F.lit("k-"), F.lower("p_type"),
                   F.when(C("p_partkey") % 9 == 0, "").otherwise("/BW1/"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.title_from_slug(url).alias("title"))


@query("d10_card_title", """
SELECT p_partkey, CASE WHEN length(p_name) > 10 THEN p_name
  ELSE concat('Deal ', upper(left(p_type, 1)), lower(substr(p_type, 2))) END AS title FROM part""")
def d10(spark, sf_dir):
    url = F.concat(F.lit("/business-for-sale/deal-"), F.lower("p_type"), F.lit("/BW1/"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.card_title(C("p_name"), url).alias("title"))


@query("d11_truncate", """SELECT doc_id, md5(left(text, 200)) AS t200, md5(left(text, 500)) AS t500,
  length(left(text, 1000)) AS n1000, length(left(text, 2000)) AS n2000 FROM documents""")
def d11(spark, sf_dir):
    t = C("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(tx.truncate(t, 200).cast("binary")).alias("t200"),
        F.md5(tx.truncate(t, 500).cast("binary")).alias("t500"),
        F.length(tx.truncate(t, 1000)).cast("long").alias("n1000"),
        F.length(tx.truncate(t, 2000)).cast("long").alias("n2000"))


@query("d12_collapse_ws", r"""
SELECT doc_id, regexp_replace(left(text, 500), '\s+', ' ', 'g') AS snippet FROM documents""")
def d12(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.collapse_ws(C("text")).alias("snippet"))


_PHRASES = ("concat(coalesce(description, ''), CASE seq % 5 WHEN 0 THEN ' Real Estate Included' WHEN 1 THEN ' with a lease' "
            "WHEN 2 THEN ' Will Train the buyer' ELSE '' END)")


@query("d13_has_phrase", f"""{LISTINGS}, a AS (SELECT seq, {_PHRASES} AS t FROM listings)
SELECT seq, contains(lower(t), 'seller financing') AS seller_financing,
  CASE WHEN regexp_matches(t, '(?i){fv.BQ_FINANCING}') THEN true END AS financing_available,
  CASE WHEN regexp_matches(t, '(?i){fv.BQ_TRAINING}') THEN true END AS training_provided,
  CASE WHEN regexp_matches(t, '(?i){fv.BQ_ESTATE_YES}') THEN true
       WHEN regexp_matches(t, '(?i){fv.BQ_ESTATE_NO}') THEN false END AS real_estate_included FROM a""")
def d13(spark, sf_dir):
    t = C("t")
    return _listings(spark, sf_dir).select("seq", F.expr(_PHRASES).alias("t")).select(
        "seq", classify.seller_financing(F.lower(t)).alias("seller_financing"),
        classify.flag_or_null(t, fv.BQ_FINANCING).alias("financing_available"),
        classify.flag_or_null(t, fv.BQ_TRAINING).alias("training_provided"),
        classify.real_estate_included(t).alias("real_estate_included"))


def _sql_category(t):
    whens = " ".join(f"WHEN {_contains_any(f'lower({t})', words)} THEN '{name}'" for name, words in fv.CATEGORIES)
    return f"CASE {whens} END"


@query("d14_category", f"""
SELECT doc_id, COALESCE({_sql_category('text')}, 'General') AS category,
  COALESCE({_sql_category('text')}, 'Business') AS business_type FROM documents""")
def d14(spark, sf_dir):
    low = F.lower("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", low.alias("low")).select(
        "doc_id", F.coalesce(classify.category(C("low")), F.lit(fv.DEFAULT_CATEGORY)).alias("category"),
        F.coalesce(classify.category(C("low")), F.lit(fv.DEFAULT_BUSINESS_TYPE)).alias("business_type"))


_CARD_TEXT = ("concat(title, ' ', coalesce(description, ''), CASE seq % 7 WHEN 0 THEN ' SaaS' WHEN 1 THEN ' Software' "
              "WHEN 2 THEN ' ecommerce' WHEN 3 THEN ' Restaurant' WHEN 4 THEN ' RETAIL service' ELSE '' END)")


@query("d15_card_type", f"""{LISTINGS}, a AS (SELECT seq, lower({_CARD_TEXT}) AS t FROM listings)
SELECT seq,
  CASE WHEN contains(t, 'amazon') OR contains(t, 'fba') THEN 'E-commerce' WHEN contains(t, 'saas') OR contains(t, 'software')
    THEN 'Technology' ELSE 'Online Business' END AS ef_type,
  CASE WHEN contains(t, 'amazon') OR contains(t, 'fba') THEN 'E-commerce' WHEN contains(t, 'saas') OR contains(t, 'software')
    THEN 'Technology' ELSE 'Online' END AS ef_category,
  CASE WHEN contains(t, 'saas') THEN 'SaaS' WHEN contains(t, 'ecommerce') OR contains(t, 'e-commerce') THEN 'E-commerce'
    ELSE 'Online Business' END AS ql_type,
  CASE WHEN contains(t, 'saas') THEN 'Technology' WHEN contains(t, 'ecommerce') OR contains(t, 'e-commerce') THEN 'E-commerce'
    ELSE 'Online' END AS ql_category,
  CASE WHEN contains(t, 'restaurant') THEN 'Restaurant' WHEN contains(t, 'retail') THEN 'Retail'
    WHEN contains(t, 'service') THEN 'Service' ELSE 'Business' END AS bbs_type,
  CASE WHEN contains(t, 'restaurant') THEN 'Restaurant' WHEN contains(t, 'retail') THEN 'Retail'
    WHEN contains(t, 'service') THEN 'Service' ELSE 'General' END AS bbs_category,
  'Online Business' AS wp_type, 'Online' AS wp_category, 'General' AS bq_type, 'Business' AS bq_category FROM a""")
def d15(spark, sf_dir):
    short = {"ef": "EmpireFlippers", "ql": "QuietLight", "bbs": "BizBuySell", "wp": "WebsiteProperties", "bq": "BizQuest"}
    columns = []
    for s, source in short.items():
        kind, category = classify.card_type(source, C("t"))
        columns += [kind.alias(f"{s}_type"), category.alias(f"{s}_category")]
    return _listings(spark, sf_dir).select("seq", F.expr(_CARD_TEXT).alias("t")).select("seq", *columns)


_INDUSTRY_URL = ("concat('https://x.example/', CASE seq % 6 WHEN 0 THEN 'Amazon-FBA-ecommerce' WHEN 1 THEN 'ecommerce' "
                 "WHEN 2 THEN 'saas-content' WHEN 3 THEN 'CONTENT' ELSE title END)")


@query("d16_industry_from_url", f"""{LISTINGS}, a AS (SELECT seq, lower({_INDUSTRY_URL}) AS u FROM listings)
SELECT seq, CASE WHEN contains(u, 'amazon-fba') THEN 'Amazon FBA' WHEN contains(u, 'ecommerce') THEN 'E-commerce'
  WHEN contains(u, 'saas') THEN 'SaaS' WHEN contains(u, 'content') THEN 'Content/Publishing' END AS industry FROM a""")
def d16(spark, sf_dir):
    return _listings(spark, sf_dir).select("seq", classify.industry_from_url(F.expr(_INDUSTRY_URL)).alias("industry"))


_SQL_TEXT = "lower(concat_ws(' ', nullif(title, ''), nullif(description, ''), nullif(industry, '')))"
_SQL_SCORE = (" + ".join(f"CASE WHEN contains({_SQL_TEXT}, '{k}') THEN 1.0 ELSE 0.0 END" for k in fv.FBA_KEYWORDS)
              + " + CASE WHEN contains(lower(listing_url), 'amazon') OR contains(lower(listing_url), 'fba') THEN 2.0 ELSE 0.0 END"
              + f" + CASE WHEN {_contains_any('''lower(coalesce(industry, ''))''', fv.ECOMMERCE_TERMS)} THEN 0.5 ELSE 0.0 END")
SQL_FBA = f"(({_SQL_SCORE}) >= 1)"
SQL_TYPE = f"""CASE WHEN {SQL_FBA} THEN CASE WHEN contains({_SQL_TEXT}, 'private label') THEN 'amazon_fba_private_label'
    WHEN contains({_SQL_TEXT}, 'wholesale') THEN 'amazon_fba_wholesale'
    WHEN contains({_SQL_TEXT}, 'dropship') THEN 'amazon_fba_dropship' ELSE 'amazon_fba' END
  WHEN {_contains_any(_SQL_TEXT, fv.AMAZON_RELATED)} THEN
    CASE WHEN contains({_SQL_TEXT}, 'affiliate') OR contains({_SQL_TEXT}, 'associates') THEN 'amazon_affiliate'
    WHEN contains({_SQL_TEXT}, 'kdp') OR contains({_SQL_TEXT}, 'kindle') THEN 'amazon_kdp' ELSE 'amazon_other' END
  ELSE 'non_amazon' END"""


@query("d17_combined_text", f"{LISTINGS} SELECT seq, {_SQL_TEXT} AS text FROM listings")
def d17(spark, sf_dir):
    return _listings(spark, sf_dir).select(
        "seq", classify.combined_text(C("title"), C("description"), C("industry")).alias("text"))


@query("d18_is_amazon_fba", f"""{LISTINGS}
SELECT seq, CAST({_SQL_SCORE} AS DOUBLE) AS score, {SQL_FBA} AS is_amazon_fba FROM listings""")
def d18(spark, sf_dir):
    text = classify.combined_text(C("title"), C("description"), C("industry"))
    staged = _listings(spark, sf_dir).withColumn("_text", text)
    score = classify.fba_score(C("_text"), C("listing_url"), C("industry"))
    return staged.select("seq", score.alias("score"), (score >= fv.FBA_THRESHOLD).alias("is_amazon_fba"))


@query("d19_amazon_business_type", f"""{LISTINGS}
SELECT {SQL_TYPE} AS amazon_business_type, count(*) AS n FROM listings GROUP BY 1""")
def d19(spark, sf_dir):
    return classify.enhance_listing(_listings(spark, sf_dir)).groupBy("amazon_business_type").agg(F.count("*").alias("n"))


@query("d20_enhance_listing", f"""{LISTINGS}
SELECT source_site, listing_url, seq, {SQL_FBA} AS is_amazon_fba, {SQL_TYPE} AS amazon_business_type FROM listings""")
def d20(spark, sf_dir):
    return classify.enhance_listing(_listings(spark, sf_dir)).select(
        "source_site", "listing_url", "seq", "is_amazon_fba", "amazon_business_type")


@query("d21_listing_id", f"""{LISTINGS}
SELECT seq, listing_url, CAST(concat('0x', substr(md5(listing_url), 1, 15)) AS BIGINT) AS id FROM listings""")
def d21(spark, sf_dir):
    return _listings(spark, sf_dir).select("seq", "listing_url", tx.listing_id(C("listing_url")).alias("id"))


@query("d22_iso_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM events")
def d22(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.iso_timestamp(C("ts")).alias("at"))


@query("d23_trigger_type", """
SELECT event_id, CASE event_id % 5 WHEN 2 THEN 'manual' WHEN 3 THEN 'api' ELSE 'scheduler' END AS trigger_type FROM events""")
def d23(spark, sf_dir):
    return i.bind(spark, sf_dir, i.REQUESTS).select("event_id", classify.trigger_type(C("body")).alias("trigger_type"))


@query("d24_numeric_aliases", f"""{LISTINGS}, a AS (SELECT seq, {i.sql_price_suffix('price_text')} AS price,
  {i.sql_price_suffix('cash_flow_text')} AS cash_flow FROM listings)
SELECT seq, price AS asking_price_numeric, cash_flow AS cash_flow_numeric, cash_flow AS profit, cash_flow AS profit_numeric FROM a""")
def d24(spark, sf_dir):
    cash = money.parse_price_suffix(C("cash_flow_text")).alias("cash_flow")
    return (
        _listings(spark, sf_dir).select("seq", money.parse_price_suffix(C("price_text")).alias("asking_price"), cash)
        .transform(extract.numeric_aliases)
        .select("seq", "asking_price_numeric", "cash_flow_numeric", "profit", "profit_numeric"))


_MULTIPLE_TEXT = ("CASE seq % 7 WHEN 0 THEN '3.5' WHEN 1 THEN '.' WHEN 2 THEN ' 2.75 ' WHEN 3 THEN '4x' WHEN 4 THEN '1.2.3' "
                  "WHEN 5 THEN NULL ELSE CAST(seq AS STRING) END")


@query("d25_float_or_null", f"""{LISTINGS}, a AS (SELECT seq, {_MULTIPLE_TEXT} AS t FROM listings)
SELECT seq, {i.sql_number('t')} AS multiple FROM a""")
def d25(spark, sf_dir):
    return _listings(spark, sf_dir).select("seq", money.number_or_null(F.expr(_MULTIPLE_TEXT)).alias("multiple"))


# --- C: text rules ------------------------------------------------------------------
_FACTS = ("concat(CASE seq % 4 WHEN 0 THEN concat('Asking Price: $', CAST(seq + 1 AS STRING), ',000') "
          "WHEN 1 THEN concat('$', CAST(seq + 1 AS STRING), 'K asking') WHEN 2 THEN concat('for sale ', CAST(seq + 1 AS STRING)) "
          "ELSE 'call us' END, '; EBITDA $', coalesce(cash_flow_text, 'n/a'), '; Sales: ', CAST(seq % 77 AS STRING), '.5M')")


def _sql_first(t, patterns, flag="(?i)"):
    return "COALESCE(" + ", ".join(f"nullif(regexp_extract({t}, '{flag}{p}', 1), '')" for p in patterns) + ")"


@query("c2_first_regex", f"""{LISTINGS}, a AS (SELECT seq, {_FACTS} AS t FROM listings)
SELECT seq, {_sql_first('t', fv.BQ_PRICE)} AS price, {_sql_first('t', fv.BQ_CASH_FLOW)} AS cash_flow,
  {_sql_first('t', fv.BQ_REVENUE)} AS revenue FROM a""")
def c2(spark, sf_dir):
    return _listings(spark, sf_dir).select("seq", F.expr(_FACTS).alias("t")).select(
        "seq", tx.first_regex(C("t"), fv.BQ_PRICE).alias("price"),
        tx.first_regex(C("t"), fv.BQ_CASH_FLOW).alias("cash_flow"),
        tx.first_regex(C("t"), fv.BQ_REVENUE).alias("revenue"))


@query("c4_label_guard", f"""{LISTINGS}
SELECT seq, CASE WHEN NOT contains(lower(price_text), 'not disclosed') THEN {i.sql_price_base('price_text')} END AS price FROM listings""")
def c4(spark, sf_dir):
    return _listings(spark, sf_dir).select(
        "seq", F.when(extract.disclosed(C("price_text")), money.parse_price_base(C("price_text"))).alias("price"))


@query("c6_jsonld_fields", f"""WITH b AS ({i.cte(i.JSONLD)}), j AS (SELECT c_custkey, CASE WHEN json_valid(body) THEN body END AS body FROM b),
f AS (SELECT c_custkey, json_extract_string(body, '$.name') AS title, CAST(json_extract_string(body, '$.offers.price') AS DOUBLE) AS price,
  json_extract_string(body, '$.offers.availableAtOrFrom.address.addressLocality') AS city,
  json_extract_string(body, '$.offers.availableAtOrFrom.address.addressRegion') AS state FROM j)
SELECT c_custkey, title, price, CASE WHEN city IS NOT NULL AND state IS NOT NULL THEN concat(city, ', ', state)
  ELSE coalesce(city, state) END AS location FROM f""")
def c6(spark, sf_dir):
    f = extract.jsonld_fields(C("json"))
    return i.bind(spark, sf_dir, i.JSONLD).withColumn("json", extract.parsed(C("body"))).select(
        "c_custkey", f["title"].alias("title"), money.number_or_null(f["price"]).alias("price"), f["location"].alias("location"))


@query("c7_nextdata_fields", """SELECT c_custkey, c_name AS title, concat('About ', c_mktsegment) AS description,
  CAST(c_custkey * 21 AS DOUBLE) AS price, CAST(c_custkey + 5 AS DOUBLE) * 1000 AS revenue,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey * 7 AS DOUBLE) END AS cash_flow, 1990 + c_nationkey AS established_year,
  c_mktsegment AS industry, CASE WHEN c_custkey % 5 <> 0 THEN 3.0::DOUBLE END AS multiple
FROM customer WHERE c_custkey % 19 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 13 <> 0""")
def c7(spark, sf_dir):
    f = extract.nextdata_fields(C("json"))
    found = i.bind(spark, sf_dir, i.NEXTDATA).withColumn("json", extract.parsed(C("body"))).select("c_custkey", *[c.alias(n) for n, c in f.items()]).filter("_keep")
    return found.select(
        "c_custkey", "title", "description", "industry", C("established_year").try_cast("int").alias("established_year"),
        *[money.parse_price_base(C(n)).alias(n) for n in ("price", "revenue", "cash_flow")],
    ).withColumn("multiple", money.multiple(C("price"), C("cash_flow")))


@query("c8_location", f"""{LISTINGS}, a AS (SELECT seq, concat(coalesce(description, ''), CASE seq % 3 WHEN 0
  THEN ' location: New York, NY' WHEN 1 THEN ' near Salt Lake City,  UT' ELSE '' END) AS t FROM listings)
SELECT seq, trim({_sql_first('t', fv.BQ_LOCATION, '')}) AS location FROM a""")
def c8(spark, sf_dir):
    t = F.concat(F.coalesce("description", F.lit("")), F.when(C("seq") % 3 == 0, " location: New York, NY")
                 .when(C("seq") % 3 == 1, " near Salt Lake City,  UT").otherwise(""))
    return _listings(spark, sf_dir).select("seq", t.alias("t")).select(
        "seq", tx.location(C("t"), fv.BQ_LOCATION).alias("location"))


_PLACE = "concat(p_name, CASE p_partkey % 3 WHEN 0 THEN ', TX' WHEN 1 THEN ' , Lake County,  NY ' ELSE '' END)"


@query("c9_split_city_state", f"""WITH a AS (SELECT p_partkey, {_PLACE} AS place FROM part)
SELECT p_partkey, CASE WHEN contains(place, ',') THEN trim(string_split(place, ',')[1]) END AS city,
  CASE WHEN contains(place, ',') THEN trim(string_split(place, ',')[-1]) END AS state FROM a""")
def c9(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(_PLACE).alias("place")).select(
        "p_partkey", tx.city_of(C("place")).alias("city"), tx.state_of(C("place")).alias("state"))


@query("c10_join_city_state", """WITH a AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment END AS city,
  CASE WHEN c_custkey % 2 = 0 THEN 'TX' END AS state FROM customer)
SELECT c_custkey, CASE WHEN city <> '' AND state <> '' THEN concat(city, ', ', state)
  ELSE coalesce(nullif(city, ''), nullif(state, '')) END AS location FROM a""")
def c10(spark, sf_dir):
    city = F.when(C("c_custkey") % 3 == 1, "").when(C("c_custkey") % 3 == 2, C("c_mktsegment"))
    state = F.when(C("c_custkey") % 2 == 0, "TX")
    return table(spark, sf_dir, "customer").select("c_custkey", tx.join_city_state(city, state).alias("location"))


@query("c11_default_literals", f"""{LISTINGS} SELECT seq, coalesce(CASE WHEN seq % 8 > 0 THEN title END, 'Title not found') AS title,
  coalesce(nullif(description, ''), 'Description not found') AS description,
  coalesce(industry, 'Industry not found') AS industry FROM listings""")
def c11(spark, sf_dir):
    return _listings(spark, sf_dir).select(
        "seq", F.coalesce(F.when(C("seq") % 8 > 0, C("title")), F.lit(fv.TITLE_NOT_FOUND)).alias("title"),
        F.coalesce(tx.not_blank(C("description")), F.lit(fv.DESCRIPTION_NOT_FOUND)).alias("description"),
        F.coalesce("industry", F.lit(fv.INDUSTRY_NOT_FOUND)).alias("industry"))
