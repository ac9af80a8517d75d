"""Reports over listings and cards."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.operators.skew import first_per_group


def count_by_source(listings: DataFrame, with_total: bool = False) -> DataFrame:
    """F1; with the grand total as the row whose source is ``Total``."""
    if not with_total:
        return listings.groupBy("source_site").agg(F.count("*").alias("n"))
    return (
        listings.rollup("source_site").agg(F.count("*").alias("n"), F.grouping("source_site").alias("g"))
        .select(F.when(F.col("g") == 1, "Total").otherwise(F.col("source_site")).alias("source_site"), "n"))


def has_amount(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0)) > 0


def has_text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _coverage(price: str, profit: str) -> list[Column]:
    return [
        F.count("*").alias("total"), F.count_if(has_amount(price)).alias("with_price"),
        F.count_if(has_amount("revenue")).alias("with_revenue"), F.count_if(has_amount(profit)).alias("with_profit"),
        F.count_if(has_text("location") | has_text("city")).alias("with_location")]


def coverage_total(cards: DataFrame, price: str = "asking_price", profit: str = "profit") -> DataFrame:
    """counts and percentages of rows with price, revenue, profit and place; one pass."""
    counts = cards.agg(*_coverage(price, profit))
    parts = ("price", "revenue", "profit", "location")
    return counts.withColumns({
        f"pct_{p}": F.try_divide(F.col(f"with_{p}") * 100.0, F.col("total")) for p in parts})


def coverage_by_source(cards: DataFrame, source: str = "source", profit: str = "profit") -> DataFrame:
    """F3"""
    return cards.groupBy(source).agg(
        F.count("*").alias("listings"), F.count_if(has_amount("revenue")).alias("with_revenue"),
        F.count_if(has_amount(profit)).alias("with_profit"))


def truthy(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    c = F.col(name)
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    if kind == "string":
        return F.coalesce(c != "", F.lit(False))
    if kind in ("double", "float", "integer", "long", "short", "byte") or kind.startswith("decimal"):
        return F.coalesce(c != 0, F.lit(False))
    return c.isNotNull()


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """filled fields out of the fields a site emits."""
    filled = sum((truthy(df, c).cast("int") for c in columns), F.lit(0))
    return df.withColumns({"filled_fields": filled, "total_fields": F.lit(len(columns))})


def record_completeness(records: DataFrame, emitted: str = "emitted") -> DataFrame:
    """F4 over ragged records: filled fields out of those that each row's ``emitted`` names.

    Of the names, ``listing_url`` and ``source_site`` may be columns outside the record; a name without a column counts as empty.
    """
    fields = [c for c in records.columns if c != emitted]
    filled = F.array_compact(F.array(*[F.when(truthy(records, c), c) for c in fields]))
    # by hash: every field's name was looked for in the list of names one by one
    return records.withColumns({"filled_fields": F.array_size(F.array_intersect(filled, emitted)), "total_fields": F.size(emitted)})


def completeness_by_source(records: DataFrame, source: str = "source_site", emitted: str = "emitted") -> DataFrame:
    """F4 per site: records, fields filled and emitted, and the fullest and emptiest record's filled fields."""
    return record_completeness(records, emitted).groupBy(source).agg(
        F.count("*").alias("records"), F.sum("filled_fields").alias("filled_fields"), F.sum("total_fields").alias("total_fields"),
        F.min("filled_fields").alias("least_filled"), F.max("filled_fields").alias("most_filled"))


def site_status(sites: DataFrame, results: DataFrame) -> DataFrame:
    """F8: per site, what worked. Sites without any result still show.

    ``results``: ``site, listings_found, listing_page, data_extracted, saved, error``, one row
    per attempt. Errors are reported as a count and one text (the smallest); ``site_errors`` has them all.
    """
    per_site = results.groupBy("site").agg(
        F.bool_or(F.col("listings_found") > 0).alias("search_page"), F.sum("listings_found").alias("listings_found"),
        F.bool_or("listing_page").alias("listing_page"), F.bool_or("data_extracted").alias("data_extracted"),
        F.bool_or("saved").alias("saved"), F.count("error").alias("n_errors"), F.min("error").alias("an_error"))
    found = F.coalesce(F.col("listings_found"), F.lit(0))
    flags = ("search_page", "listing_page", "data_extracted", "saved")
    return (
        sites.select(F.col("name").alias("site")).join(per_site, "site", "left")
        .select(
            "site", *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags],
            found.cast("long").alias("listings_found"),
            F.coalesce(F.col("n_errors"), F.lit(0)).cast("long").alias("n_errors"), "an_error",
            F.when(found > 0, "OK").when(F.col("an_error").isNotNull(),
                                         F.concat(F.lit("Error: "), F.col("an_error")))
            .otherwise("No listings found").alias("status")))


def site_errors(results: DataFrame) -> DataFrame:
    """F8, the error list: every distinct text per site with its count, as rows."""
    return results.filter(F.col("error").isNotNull()).groupBy("site", "error").agg(F.count("*").alias("n"))


def high_value_sorted(listings: DataFrame, min_price: float = 1_000_000) -> DataFrame:
    """G1: dearest first, ties by URL."""
    return (
        listings.filter(F.col("price") > min_price).orderBy(F.desc("price"), "listing_url")
        .select("title", "price", "source_site", "listing_url"))


def first_n_per_source(rows: DataFrame, n: int, order: Sequence[str], source: str = "source_site") -> DataFrame:
    """G2"""
    cols = [F.col(c) for c in order]
    return first_per_group(rows, [source], cols, n, F.struct(*cols))
