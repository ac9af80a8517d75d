"""A whole ingestion run: what a crawl found, minus what is stored, extracted, stored, logged."""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlens.operators.extract import Site
from bazaarlens.session import cut
from bazaarlens.sources import runlog, store
from bazaarlens.streaming.incremental import new_listings


def _literal(at: dt.datetime) -> Column:
    return F.lit(at.astimezone(dt.timezone.utc)).cast("timestamp")


def ingest_run(spark: SparkSession, run_id: str, found: DataFrame, captures: DataFrame, listings_table: str,
               log_table: str, searches: Column, pages: int | None = None,
               extractors: dict[str, Site] | None = None, sites: Sequence[str] = (), rejects_table: str | None = None) -> None:
    """Run the ``sites`` and all sites of ``found`` (``source_site``, ``listing_url``) as one job.

    The log gets a ``running`` row per site at the start and a closing row at the end, also for a site
    without a URL. Which URLs were known is stored before anything is appended; success means the row is
    really in the table afterwards. What can't be stored goes to ``rejects_table`` (``<listings>_rejects``)
    and counts as an error. ``searches`` gives the number of search URLs by ``site_name``.
    """
    start = dt.datetime.now(dt.timezone.utc)
    rejects = rejects_table or f"{listings_table}_rejects"
    store.create_rejects_table(spark, rejects)
    urls = cut(store.keys_of(found))
    asked = urls.select(F.col("source_site").alias("site_name")).unionByName(
        spark.createDataFrame([(s,) for s in sites], "site_name string")).distinct()
    runs = asked.select(F.lit(run_id).alias("run_id"), "site_name", _literal(start).alias("start_time"))
    runlog.append_run_log(runlog.initial_run_rows(runs), log_table)
    try:
        known = cut(store.existing_urls(urls, spark.table(listings_table)))
        wanted = captures.join(
            urls.join(known, store.URL_KEY, "left_anti").withColumnRenamed("listing_url", "url"),
            ["source_site", "url"], "left_semi")
        store.append_outcomes(new_listings(wanted, spark.table(listings_table), extractors), listings_table, rejects, run_id)
        raised = store.keys_of(spark.table(rejects).filter(F.col("run") == run_id))
        stored = store.existing_urls(urls, spark.table(listings_table))
        end = _literal(dt.datetime.now(dt.timezone.utc))
        flags = (
            urls.join(known.withColumn("existing", F.lit(True)), store.URL_KEY, "left")
            .join(stored.withColumn("succeeded", F.lit(True)), store.URL_KEY, "left")
            .join(raised.withColumn("raised", F.lit(True)), store.URL_KEY, "left")
            .select(F.lit(run_id).alias("run_id"), F.col("source_site").alias("site_name"),
                    _literal(start).alias("ts"),
                    *[F.coalesce(c, F.lit(False)).alias(c) for c in ("existing", "succeeded", "raised")]))
        counted = runlog.run_accounting(flags, searches, pages, runs).withColumns({
            "end_time": end, "duration_seconds": F.timestamp_diff("MICROSECOND", _literal(start), end) / 1e6})
        runlog.append_run_log(counted.withColumn("error_message", F.lit(None).cast("string")), log_table)
    except Exception as problem:
        end = _literal(dt.datetime.now(dt.timezone.utc))
        runlog.append_run_log(runlog.failed_run_rows(runs, end, str(problem)), log_table)
        raise
