"""H1: new captures to new listings, batch by batch."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarlens.operators.extract import Site, extract_listings
from bazaarlens.sources import store
from bazaarlens.sources.captures import CAPTURE_SCHEMA, prefer_rendered


def new_listings(captures: DataFrame, stored: DataFrame, extractors: dict[str, Site] | None = None) -> DataFrame:
    """Captures to listings rows whose URL is not stored yet, with ``reject_reason`` where one can't be stored.

    What is known is dropped by URL alone, before a page is moved, parsed or extracted.
    """
    named = captures.withColumnRenamed("url", "listing_url")
    fresh = prefer_rendered(named, *store.URL_KEY, known=store.existing_urls(named, stored))
    records = extract_listings(fresh.select(*store.URL_KEY, "fetched_at", "html"), extractors, with_rejects=True)
    return store.to_listings(store.canonical(records), F.col("fetched_at"), "reject_reason")


def ingest_batch(table: str, extractors: dict[str, Site] | None = None, rejects: str | None = None) -> Callable[[DataFrame, int], None]:
    """A batch function. Repeating a batch appends nothing: what it wrote before is stored by then.

    Rejects are filed under the stream and the batch: the id that a stream keeps in its checkpoint, over restarts.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batches"
        bad = rejects or f"{table}_rejects"
        store.create_rejects_table(spark, bad)
        store.append_outcomes(new_listings(batch, spark.table(table), extractors), table, bad, f"{stream} batch {batch_id}")
    return run


def incremental_ingest(spark: SparkSession, capture_dir: str, table: str, checkpoint: str,
                       files_per_batch: int = 1000, extractors: dict[str, Site] | None = None,
                       rejects: str | None = None) -> StreamingQuery:
    """Work off all capture files not seen before, then stop. What can't be stored goes to ``rejects``
    (``<table>_rejects``) with its reason."""
    return (
        spark.readStream.schema(CAPTURE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(capture_dir)
        .writeStream.foreachBatch(ingest_batch(table, extractors, rejects))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
