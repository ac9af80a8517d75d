"""The site dimension, which sites to run, their search URLs and page URLs."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bazaarlens import fixed_values as fv

SITE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("base_url", T.StringType(), False),
    T.StructField("search_url", T.StringType()),
    T.StructField("search_urls", T.ArrayType(T.StringType())),
    T.StructField("ecommerce_url", T.StringType()),
    T.StructField("amazon_url", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
])


def site_config(spark: SparkSession) -> DataFrame:
    """A4: nine rows, so a join may broadcast it."""
    return spark.createDataFrame(list(fv.SITES), SITE_SCHEMA)


def select_sites(sites: DataFrame, names: Sequence[str] | None = None,
                 with_extractor: Sequence[str] | None = None) -> DataFrame:
    """B1: enabled sites, optionally only the named ones, and only those we can extract."""
    out = sites.filter(F.coalesce(F.col("enabled"), F.lit(False)))
    if names is not None:
        out = out.filter(F.col("name").isin(*names))
    if with_extractor is not None:
        out = out.filter(F.col("name").isin(*with_extractor))
    return out


def resolve_search_urls(sites: DataFrame) -> DataFrame:
    """B2: the e-commerce and Amazon URLs; only without both, the general list or URL."""
    special = F.array_compact(F.array("ecommerce_url", "amazon_url"))
    general = F.coalesce(F.col("search_urls"), F.array_compact(F.array("search_url")))
    urls = F.when(F.size(special) > 0, special).otherwise(general)
    return sites.select("*", F.posexplode(urls).alias("search_pos", "resolved_url"))


def page_url(site: Column, search_url: Column, page: Column) -> Column:
    """Address of one results page."""
    n = page.cast("string")
    first = page == 1
    return (
        F.when(site == "BizBuySell", F.concat(search_url, n, F.lit("/")))
        .when(site == "BizQuest", F.when(first, fv.BQ_PAGES_BASE)
              .otherwise(F.concat(F.lit(fv.BQ_PAGES_BASE + "page-"), n, F.lit("/"))))
        .when(site == "QuietLight", F.when(first, search_url)
              .otherwise(F.concat(F.regexp_replace(search_url, "/+$", ""), F.lit("/page/"), n, F.lit("/"))))
        .when(site == "WebsiteProperties", F.when(first, search_url)
              .otherwise(F.concat(search_url, F.lit("/page/"), n, F.lit("/"))))
        .when(site == "Flippa",
              F.concat(search_url, F.lit("&offset="), ((page - 1) * fv.FLIPPA_PAGE_SIZE).cast("string")))
        .when(site == "EmpireFlippers",
              F.concat(search_url, F.when(search_url.contains("?"), "&page=").otherwise("?page="), n))
        .when(site == "WebsiteClosers", F.when(first, search_url)
              .otherwise(F.concat(search_url, F.lit("page/"), n, F.lit("/"))))
        .otherwise(search_url)
    )


def page_urls(searches: DataFrame, site: str, search_url: str, pages: Column) -> DataFrame:
    """One row per results page up to ``pages``; single-page sites give one, no pages none."""
    count = F.when(pages < 1, pages).when(F.col(site).isin(*fv.SINGLE_PAGE_SITES), 1).otherwise(pages)
    return (
        searches.filter(count >= 1).withColumn("page", F.explode(F.sequence(F.lit(1), count)))
        .withColumn("page_url", page_url(F.col(site), F.col(search_url), F.col("page")))
    )
