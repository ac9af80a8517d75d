"""The listings store and set operations against it."""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlens import schemas
from bazaarlens.functions import classify, text as tx
from bazaarlens.session import cut

URL_KEY = ["source_site", "listing_url"]


def create_listings_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """A5: one table, one partition per site."""
    _create(spark, name, schemas.LISTINGS, location, "PARTITIONED BY (source_site)")


def create_log_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """A6"""
    _create(spark, name, schemas.RUN_LOG, location, "")


def create_rejects_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Where the rows go that a run could not store."""
    _create(spark, name, schemas.REJECTS, location, "")


def _create(spark, name, schema, location, partitioning):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    at = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioning} {at}")


def to_listings(records: DataFrame, scraped_at: Column, *also: str) -> DataFrame:
    """Extracted records as stored rows: id, time, tags, the fixed columns, and those of ``also``."""
    tagged = classify.enhance_listing(records)
    have = set(tagged.columns)
    fill = {"id": tx.listing_id(F.col("listing_url")), "scraped_at": scraped_at}
    return tagged.select([
        (fill[f.name] if f.name in fill else F.col(f.name) if f.name in have else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in schemas.LISTINGS.fields] + list(also))


def canonical(records: DataFrame) -> DataFrame:
    """One name per fact: price, cash flow and industry also take their sites' other columns."""
    pairs = {"price": "asking_price", "cash_flow": "profit", "industry": "category"}
    return records.withColumns({a: F.coalesce(F.col(a), F.col(b)) for a, b in pairs.items() if b in records.columns})


def missing_required(required: Sequence[str] = ("id", "listing_url", "scraped_at")) -> Column:
    """Name of the first required column that is NULL, else NULL."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required])


def _reason(rows: DataFrame) -> Column:
    """What is wrong with a row: what extraction noted, else what is missing, else NULL."""
    return F.coalesce(F.col("reject_reason"), missing_required()) if "reject_reason" in rows.columns else missing_required()


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(_reason(rows).isNull())


def rejected(rows: DataFrame) -> DataFrame:
    """Bad rows with the reason; they never fail the job."""
    return rows.withColumn("reject_reason", _reason(rows)).filter(F.col("reject_reason").isNotNull())


def append_listings(rows: DataFrame, table: str) -> None:
    """Append, partitioned by site. Rows with a fault are left to ``append_outcomes``.

    Rebalancing by site gives few files per site, and splits a site too large for one task.
    """
    ordered = accepted(rows).select([F.col(f.name).cast(f.dataType) for f in schemas.LISTINGS.fields])
    ordered.hint("rebalance", "source_site").write.insertInto(table)


def append_outcomes(rows: DataFrame, table: str, rejects: str, run: str) -> None:
    """Good rows to the listings table, all others to the rejects table, under the run's name.

    The rows are computed once. A run repeated under its name adds no reject twice.
    """
    rows = cut(rows)
    append_listings(rows, table)
    bad = rejected(rows).withColumn("run", F.lit(run)).select([F.col(f.name).cast(f.dataType) for f in schemas.REJECTS.fields])
    there = rows.sparkSession.table(rejects).filter(F.col("run") == run).select(
        *(F.col(c).alias(f"_{c}") for c in (*URL_KEY, "reject_reason")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*URL_KEY, "reject_reason")]
    bad.join(there, reduce(Column.__and__, same), "left_anti").write.insertInto(rejects)


def write_json(rows: DataFrame, folder: str, at: dt.datetime | None = None) -> str:
    """JSON lines in a new folder below ``folder``, named by the time; timestamps as ISO text. Returns its path.

    An earlier run's rows are never overwritten: a name that is taken fails.
    """
    stamps = [f.name for f in rows.schema.fields if f.dataType.typeName().startswith("timestamp")]
    path = f"{folder.rstrip('/')}/results_{(at or dt.datetime.now(dt.timezone.utc)).strftime('%Y%m%d_%H%M%S_%f')}"
    rows.withColumns({c: tx.iso_timestamp(F.col(c)) for c in stamps}).write.json(path)
    return path


def keys_of(rows: DataFrame) -> DataFrame:
    """Distinct URL keys; duplicates combine before the shuffle, so a repeated URL cannot pile up."""
    return rows.select(*URL_KEY).distinct()


def existing_urls(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidate URLs that are already stored.

    The store is on the left: with few candidates they are broadcast and the semi-join moves
    below the store's ``distinct``, so the store is scanned but not shuffled.
    """
    return keys_of(stored).join(keys_of(candidates), URL_KEY, "left_semi")


def new_urls(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates not stored, with their order columns. Candidates are distinct per URL."""
    return candidates.join(stored.select(*URL_KEY), URL_KEY, "left_anti")


def union_all_sites(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of every site in one set; columns a site lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def high_value(listings: DataFrame, min_price: float = 1_000_000) -> DataFrame:
    """E5"""
    return listings.filter(F.col("price") > min_price)


def by_site(listings: DataFrame, site: str) -> DataFrame:
    """On the stored table this prunes to one partition."""
    return listings.filter(F.col("source_site") == site)
