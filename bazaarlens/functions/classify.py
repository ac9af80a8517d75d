"""Business tagging by keywords: plain substring tests, no word boundaries."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions.text import contains_any, has_pattern, not_blank


def combined_text(title: Column, description: Column, industry: Column) -> Column:
    """The non-empty texts, lower case, joined by a space."""
    return F.lower(F.concat_ws(" ", not_blank(title), not_blank(description), not_blank(industry)))


def fba_score(text: Column, url: Column, industry: Column) -> Column:
    """Each keyword scores once however often it occurs; the industry alone never decides."""
    hits = reduce(lambda a, b: a + b, [text.contains(k).cast("double") for k in fv.FBA_KEYWORDS])
    url_text = F.lower(F.coalesce(url, F.lit("")))
    industry_text = F.lower(F.coalesce(industry, F.lit("")))
    return (
        hits
        + F.when(contains_any(url_text, fv.FBA_URL_TERMS), fv.FBA_URL_WEIGHT).otherwise(0.0)
        + F.when(contains_any(industry_text, fv.ECOMMERCE_TERMS), fv.ECOMMERCE_WEIGHT).otherwise(0.0)
    )


def is_amazon_fba(text: Column, url: Column, industry: Column) -> Column:
    """D18"""
    return fba_score(text, url, industry) >= fv.FBA_THRESHOLD


def amazon_business_type(text: Column, is_fba: Column) -> Column:
    """D19"""
    return (
        F.when(is_fba & text.contains("private label"), "amazon_fba_private_label")
        .when(is_fba & text.contains("wholesale"), "amazon_fba_wholesale")
        .when(is_fba & text.contains("dropship"), "amazon_fba_dropship")
        .when(is_fba, "amazon_fba")
        .when(~contains_any(text, fv.AMAZON_RELATED), "non_amazon")
        .when(contains_any(text, ("affiliate", "associates")), "amazon_affiliate")
        .when(contains_any(text, ("kdp", "kindle")), "amazon_kdp")
        .otherwise("amazon_other")
    )


def enhance_listing(df: DataFrame) -> DataFrame:
    """Add both tags. The joined text lives in its own projection so it is built once per row."""
    return (
        df.withColumn("_text", combined_text(F.col("title"), F.col("description"), F.col("industry")))
        .withColumn("is_amazon_fba", is_amazon_fba(F.col("_text"), F.col("listing_url"), F.col("industry")))
        .withColumn("amazon_business_type", amazon_business_type(F.col("_text"), F.col("is_amazon_fba")))
        .drop("_text")
    )


def category(low: Column) -> Column:
    """NULL when no keyword list hits. Takes lower-case text, best from an earlier
    projection: up to fifty words are looked up in it."""
    out = None
    for name, words in fv.CATEGORIES:
        hit = contains_any(low, words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def card_type(source: str, text: Column) -> tuple[Column, Column]:
    """(business_type, category) of a results-page card."""
    low = F.lower(text)
    if source == "EmpireFlippers":
        shop, tech = contains_any(low, ("amazon", "fba")), contains_any(low, ("saas", "software"))
        return (F.when(shop, "E-commerce").when(tech, "Technology").otherwise("Online Business"),
                F.when(shop, "E-commerce").when(tech, "Technology").otherwise("Online"))
    if source == "QuietLight":
        saas, shop = low.contains("saas"), contains_any(low, ("ecommerce", "e-commerce"))
        return (F.when(saas, "SaaS").when(shop, "E-commerce").otherwise("Online Business"),
                F.when(saas, "Technology").when(shop, "E-commerce").otherwise("Online"))
    if source == "BizBuySell":
        kinds = ("Restaurant", "Retail", "Service")
        named = F.coalesce(*[F.when(low.contains(k.lower()), k) for k in kinds])
        return F.coalesce(named, F.lit("Business")), F.coalesce(named, F.lit("General"))
    if source == "WebsiteProperties":
        return F.lit("Online Business"), F.lit("Online")
    return F.lit("General"), F.lit("Business")


def industry_from_url(url: Column) -> Column:
    """D16"""
    low = F.lower(url)
    return F.coalesce(*[F.when(low.contains(part), label) for part, label in fv.FE_URL_INDUSTRY])


def seller_financing(low: Column) -> Column:
    """D13, on lower-case text"""
    return low.contains("seller financing")


def flag_or_null(text: Column, pattern: str) -> Column:
    """True or unknown, never false."""
    return F.when(has_pattern(text, pattern), True)


def real_estate_included(text: Column) -> Column:
    """Included, not included, or unknown."""
    return F.when(has_pattern(text, fv.BQ_ESTATE_YES), True).when(has_pattern(text, fv.BQ_ESTATE_NO), False)


def trigger_type(body: Column) -> Column:
    """Who asked for a run. Missing or empty request -> scheduler; an object gives its ``type``."""
    value = F.get_json_object(body, "$.trigger_type")
    nested = F.get_json_object(body, "$.trigger_type.type")
    return (
        F.when(value.startswith("{"), F.coalesce(nested, F.lit(fv.DEFAULT_TRIGGER)))
        .otherwise(F.coalesce(value, F.lit(fv.DEFAULT_TRIGGER)))
    )
