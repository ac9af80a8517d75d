"""A1, A3: captured pages."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CAPTURE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("rendered", T.BooleanType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("source_site", T.StringType()),
])


def usable(captures: DataFrame) -> DataFrame:
    """A1: a failed fetch has no HTML and drops out."""
    return captures.filter(F.col("html").isNotNull())


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A1: captures from a directory of parquet or JSON files."""
    return usable(spark.read.schema(CAPTURE_SCHEMA).format(fmt).load(path))


def prefer_rendered(captures: DataFrame, *key: str, known: DataFrame | None = None, ties: Column | None = None) -> DataFrame:
    """A3: one capture per URL: rendered before plain, then the latest; of these the largest digest, or the largest ``ties``.

    ``known``: keys to leave out. The choice is made on narrow rows (key and order), keys that are known
    already gone; only then are the chosen captures fetched, by a semi-join that builds on the choice.
    Only captures of one URL that are equal in their order are digested and meet in a maximum, which
    combines on the map side; any other page is not hashed and moves once at most.
    """
    key = key or ("url",)
    order = [c for c in ("rendered", "fetched_at") if c in captures.columns]
    pages = usable(captures)
    ranked = pages.select(*key, *order)
    if known is not None:
        ranked = ranked.join(known, list(key), "left_anti")
    counted = ranked.groupBy(*key, *order).agg(F.count("*").alias("_equals"))
    best = counted.groupBy(*key).agg(F.max(F.struct(*order, "_equals")).alias("_best")).select(*key, "_best.*")
    names = {c: f"_best_{c}" for c in (*key, *order)}
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]

    def fetch(which: Column) -> DataFrame:
        wanted = best.filter(which).select(*(F.col(c).alias(n) for c, n in names.items()))
        return pages.join(wanted.hint("shuffle_hash"), reduce(Column.__and__, same), "left_semi")

    tied = fetch(F.col("_equals") > 1).groupBy(*(F.col(c).alias(n) for c, n in names.items() if c in key)).agg(
        F.max_by(F.struct(*pages.columns), F.md5("html") if ties is None else ties).alias("_row")).select("_row.*")
    return fetch(F.col("_equals") == 1).unionByName(tied)
