"""The run log as append-only events, and what it says now."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens import fixed_values as fv, schemas
from bazaarlens.functions import classify


def initial_run_rows(runs: DataFrame) -> DataFrame:
    """The first row of a run (``run_id``, ``site_name``, ``start_time``): running, all counts zero."""
    known = {"run_id", "site_name", "start_time"}
    nulls = {"end_time", "duration_seconds", "error_message"}
    return runs.select([
        (F.col(f.name) if f.name in known else F.lit("running") if f.name == "status"
         else F.lit(None) if f.name in nulls else F.lit(0)).cast(f.dataType).alias(f.name)
        for f in schemas.RUN_LOG.fields])


def append_run_log(rows: DataFrame, table: str) -> None:
    rows.select([F.col(f.name).cast(f.dataType) for f in schemas.RUN_LOG.fields]).write.insertInto(table)


def orchestrator_runs(requests: DataFrame, body: str = "body", ts: str = "ts", version: str = "1.0.2") -> DataFrame:
    """Run records from trigger requests."""
    at = F.col(ts)
    return requests.select(
        F.concat(F.lit("run_"), F.date_format(at, "yyyyMMdd_HHmmss")).alias("run_id"),
        F.lit("orchestrator").alias("source"), at.alias("start_time"), at.alias("end_time"),
        F.lit("completed").alias("status"), classify.trigger_type(F.col(body)).alias("trigger_type"),
        F.lit(version).alias("scraper_version"), F.to_date(at).alias("ingestion_date"),
        *[F.lit(0).cast("long").alias(c) for c in ("total_listings_found", "new_listings", "updated_listings")])


def run_log_state(updates: DataFrame, key: str = "run_id", seq: str = "seq") -> DataFrame:
    """per run, the latest assigned value of every column.

    A partial update leaves a column NULL; to assign NULL on purpose it names the column in
    ``_set_null``. Only the latest value of each column is shuffled, not the updates.
    """
    columns, place = _assignments(updates, key, seq)
    return updates.groupBy(key).agg(*[F.max_by(F.col(c), place(c)).alias(c) for c in columns])


def _assignments(updates: DataFrame, key: str, seq: str) -> tuple[list[str], Callable[[str], Column]]:
    """The columns that updates assign, and the place of a row's assignment to one; NULL where it assigns nothing."""
    cleared = F.col("_set_null") if "_set_null" in updates.columns else F.array().cast("array<string>")

    def place(c: str) -> Column:
        assigned = F.col(c).isNotNull() | F.coalesce(F.array_contains(cleared, c), F.lit(False))
        return F.when(assigned, F.col(seq))
    return [c for c in updates.columns if c not in (key, seq, "_set_null")], place


def log_parts(updates: DataFrame, key: str = "run_id", seq: str = "seq") -> DataFrame:
    """Per run and column the latest assignment as (place, value), NULL where there is none. Parts of disjoint sets
    of updates merge into the parts of all (``merged_parts``)."""
    columns, place = _assignments(updates, key, seq)
    return updates.groupBy(key).agg(*[
        F.max_by(F.struct(F.col(seq).alias("place"), F.col(c).alias("value")), place(c)).alias(c) for c in columns])


def merged_parts(*parts: DataFrame, key: str = "run_id") -> DataFrame:
    """A column that some parts lack was not assigned there."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.groupBy(key).agg(*[F.max_by(F.col(c), F.col(c)["place"]).alias(c) for c in every.columns if c != key])


def state_of_parts(parts: DataFrame, key: str = "run_id") -> DataFrame:
    """What ``run_log_state`` gives for the updates behind the parts."""
    return parts.select(key, *[F.col(c)["value"].alias(c) for c in parts.columns if c != key])


def current_run_log(log: DataFrame) -> DataFrame:
    """The stored log as it stands: one row per run and site, later rows over earlier ones."""
    keyed = log.withColumns({
        "_key": F.struct("run_id", "site_name"),
        "seq": F.struct(F.coalesce("end_time", "start_time"), F.col("status") != "running")})
    state = run_log_state(keyed.drop("run_id", "site_name"), "_key")
    return state.select("_key.*", *[c for c in log.columns if c not in ("run_id", "site_name")])


def failed_run_rows(runs: DataFrame, end_time: Column, message: str) -> DataFrame:
    """The closing row of a run that broke: its counts stay as last logged."""
    known = {"end_time": end_time, "status": F.lit("failed"), "error_message": F.lit(message), "error_count": F.lit(1),
             "duration_seconds": F.timestamp_diff("MICROSECOND", F.col("start_time"), end_time) / 1e6}
    keys = {"run_id", "site_name", "start_time"}
    return runs.select([
        (F.col(f.name) if f.name in keys else known.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in schemas.RUN_LOG.fields])


def run_accounting(outcomes: DataFrame, searches: Column, pages: int | None = None, runs: DataFrame | None = None) -> DataFrame:
    """counters of each run from one row per URL it found.

    ``outcomes``: ``run_id, site_name, ts`` and flags ``existing``, ``succeeded``, ``raised``.
    ``searches`` counts the run's search URLs; calls are estimated with ``pages`` or ten each. ``runs``
    (``run_id, site_name, start_time``): all runs, those that found nothing get zeros.
    """
    existing, new = F.col("existing"), ~F.col("existing")
    counted = outcomes.groupBy("run_id", "site_name").agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.count("*").alias("total_listings_found"), F.count_if(existing).alias("existing_listings"),
        F.count_if(new).alias("new_listings"), F.count_if(new & F.col("succeeded")).alias("successful_scrapes"),
        F.count_if(new & ~F.col("succeeded")).alias("failed_scrapes"),
        F.count_if(new & F.col("raised")).alias("error_count"))
    if runs is not None:
        zeros = {c: 0 for c in counted.columns if c not in ("run_id", "site_name", "start_time", "end_time")}
        counted = (runs.withColumnRenamed("start_time", "_start").join(counted, ["run_id", "site_name"], "left").fillna(zeros)
                   .withColumn("start_time", F.coalesce("start_time", "_start")).drop("_start"))
    return counted.withColumns({
        "duration_seconds": F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / 1e6,
        "status": F.lit("completed"),
        "api_calls_made": (searches * (pages or fv.ESTIMATED_SEARCH_PAGES) + F.col("new_listings")).cast("long"),
        "api_credits_saved": F.col("existing_listings"),
        "stored_total": F.col("existing_listings") + F.col("successful_scrapes"),
    })


def latest_run_status(state: DataFrame) -> DataFrame:
    """per site, its last run: time, status, error, and whether it still runs."""
    last = F.max_by(F.struct("run_id", "status", "error_message", "start_time"),
                    F.struct("start_time", "run_id")).alias("last")
    return state.groupBy("site_name").agg(last).select(
        "site_name", F.col("last.run_id").alias("last_run_id"), F.col("last.start_time").alias("last_run"),
        F.col("last.status").alias("last_status"), F.col("last.error_message").alias("last_error"),
        (F.col("last.status") == "running").alias("running"))
