"""Literal tables and properties of the column functions."""
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions import classify, money, text as tx

C = F.col


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(rows)], f"n int, v {kind}")
    return [r[0] for r in df.select("n", column.alias("out")).orderBy("n").select("out").collect()]


MONEY = [
    ("$1,250,000", 1250000.0, 1250000.0), ("$1.2M", 1200000.0, 1200000.0), ("250k", 250000.0, 250000.0),
    ("1.5mm", 1500000.0, 1500000.0), ("1.5 million", None, 1500000.0), ("2b", None, 2e9), ("3 thousand", None, 3000.0),
    ("from 20k", None, 0.0), (",", None, 0.0), ("", None, 0.0), (None, None, 0.0), ("None", None, 0.0),
    ("Not Disclosed", None, 0.0), ("-5", -5.0, -5.0), ("1d", None, 0.0), ("nan", None, 0.0), (" $7 ", 7.0, 7.0),
]


def test_money_parsers(spark):
    texts = [m[0] for m in MONEY]
    assert values(spark, texts, "string", money.parse_price_base(C("v"))) == [m[1] for m in MONEY]
    assert values(spark, texts, "string", money.parse_price_suffix(C("v"))) == [m[2] for m in MONEY]


NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?", re.I)


def plain_number(s):
    return float(s) if NUMBER.fullmatch(s.strip()) else None


def stated_base(s):
    """The base rule, said once more without Spark."""
    s = s.lower().replace("$", "").replace(",", "").strip()
    for letter, factor in (("m", 1e6), ("k", 1e3)):
        if letter in s:
            n = plain_number(s.replace(letter, ""))
            return None if n is None else n * factor
    return plain_number(s)


def stated_suffix(s):
    s = s.replace("$", "").replace(",", "").strip()
    scale = {"k": 1e3, "thousand": 1e3, "m": 1e6, "mil": 1e6, "million": 1e6, "mm": 1e6, "b": 1e9, "billion": 1e9}
    for word, factor in scale.items():
        if s.lower().endswith(word) and plain_number(s[:-len(word)]) is not None:
            return plain_number(s[:-len(word)]) * factor
    return plain_number(s) or 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789.,$kKmMbB +-eilonthusad", max_size=10), min_size=60, max_size=60))
def test_money_parsers_against_the_stated_rules(spark, texts):
    assert values(spark, texts, "string", money.parse_price_base(C("v"))) == [stated_base(t) for t in texts]
    assert values(spark, texts, "string", money.parse_price_suffix(C("v"))) == [stated_suffix(t) for t in texts]


def test_title_from_slug(spark):
    urls = ["/business-for-sale/thriving-amazon-cleaning-products-store-886k-sales-124k-profit/BW2384670/",
            "https://x/business-for-sale/o'x-shop/", "/elsewhere/a/"]
    assert values(spark, urls, "string", tx.title_from_slug(C("v"))) == [
        "Thriving Amazon Cleaning Products Store 886K Sales 124K Profit", "O'X Shop", None]


def test_years_only_in_the_window(spark):
    texts = ["Established 1995", "founded: 1776, 2010 founded", "since 2026", "in business since 2001", "none"]
    assert values(spark, texts, "string", money.year_in_range(C("v"), fv.BQ_YEAR)) == [1995, 2010, None, 2001, None]


@pytest.mark.parametrize("text,url,industry,fba,kind", [
    ("private label brand", "https://x/1", None, True, "amazon_fba_private_label"),
    ("wholesale seller central", "https://x/1", None, True, "amazon_fba_wholesale"),
    ("amazon dropship", "https://x/1", None, True, "amazon_fba_dropship"),
    ("purchasing office", "https://x/1", None, True, "amazon_fba"),        # asin inside purchasing
    ("shop", "https://x/FBA-1", None, True, "amazon_fba"),
    ("shop", "https://x/1", "E-commerce", False, "non_amazon"),           # half a point never decides
    ("amazon affiliate blog", "https://x/1", None, False, "amazon_affiliate"),
    ("kindle shop", "https://x/1", None, False, "amazon_kdp"),
    ("audible titles", "https://x/1", None, False, "amazon_other"),
])
def test_business_tags(spark, text, url, industry, fba, kind):
    df = spark.createDataFrame([(text, None, industry, url)], "title string, description string, industry string, listing_url string")
    row = classify.enhance_listing(df).select("is_amazon_fba", "amazon_business_type").first()
    assert tuple(row) == (fba, kind)


def test_category_order_and_substrings(spark):
    texts = ["a bar and a shop", "barely", "online shop", "realty", "zzz"]
    assert values(spark, texts, "string", classify.category(F.lower("v"))) == [
        "Restaurant", "Restaurant", "Retail", "Real Estate", None]


def test_trigger_type(spark):
    bodies = [None, "{}", '{"trigger_type":"manual"}', '{"trigger_type":{"type":"api"}}', '{"trigger_type":{}}', "{bad"]
    assert values(spark, bodies, "string", classify.trigger_type(C("v"))) == [
        "scheduler", "scheduler", "manual", "api", "scheduler", "scheduler"]


def test_places(spark):
    texts = ["located in Cedar Park, TX now", "near Salt Lake City,  UT", "location: nowhere"]
    places = tx.location(C("v"), fv.BQ_LOCATION)
    assert values(spark, texts, "string", places) == ["Cedar Park, TX", "Salt Lake City,  UT", None]
    assert values(spark, texts, "string", tx.city_of(places)) == ["Cedar Park", "Salt Lake City", None]
    assert values(spark, texts, "string", tx.state_of(places)) == ["TX", "UT", None]


def test_a_pattern_below_a_case_is_searched_once(spark):
    """With ``nullif`` the plan had the search twice, and a text that is no number went through a failing cast."""
    df = spark.createDataFrame([("a 7",), ("b",), ("",), (None,)], "t string")
    found = df.select(F.when(F.col("t") != "x", tx.search(F.col("t"), r"(\d)")).alias("one"),
                      F.when(F.col("t") != "x", tx.search_whole(F.col("t"), r"a \d")).alias("whole"),
                      F.when(F.col("t") != "x", money.number_or_null(F.col("t"))).alias("number"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 3
    assert [tuple(r) for r in found.collect()] == [("7", "a 7", None), (None, None, None), (None, None, None), (None, None, None)]
