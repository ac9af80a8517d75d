"""Registered checks of reports and run accounting (F, G)."""
from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions import text as tx
from bazaarlens.operators import report
from bazaarlens.plans import inputs as i
from bazaarlens.plans.registry import ORACLES, query
from bazaarlens.plans.tables_catalog import PRICED, priced_listings
from bazaarlens.session import fresh_path, own
from bazaarlens.sources import runlog, sites
from bazaarlens.streaming import log_state

C = F.col
UPDATES = f"WITH u AS ({i.cte(i.RUNS)})"


@query("f1_count_by_source", f"{PRICED} SELECT source_site, count(*) AS n FROM priced GROUP BY source_site")
def f1(spark, sf_dir):
    return report.count_by_source(priced_listings(spark, sf_dir))


@query("f1_count_with_total", f"""{PRICED} SELECT coalesce(source_site, 'Total') AS source_site, count(*) AS n
FROM priced GROUP BY ROLLUP (source_site)""")
def f1_total(spark, sf_dir):
    return report.count_by_source(priced_listings(spark, sf_dir), with_total=True)


_CARDS = f"""{PRICED}, cards AS (SELECT source_site AS source, price AS asking_price, cash_flow AS profit,
  CASE WHEN seq % 3 = 0 THEN cash_flow * 4 END AS revenue,
  nullif(regexp_extract(description, '{fv.CARD_PLACE}', 1), '') AS location, CAST(NULL AS VARCHAR) AS city FROM priced)"""


def _cards(spark, sf_dir):
    return priced_listings(spark, sf_dir).select(
        C("source_site").alias("source"), C("price").alias("asking_price"), C("cash_flow").alias("profit"),
        F.when(C("seq") % 3 == 0, C("cash_flow") * 4).alias("revenue"),
        tx.not_blank(F.regexp_extract("description", fv.CARD_PLACE, 1)).alias("location"),
        F.lit(None).cast("string").alias("city"))


@query("f2_coverage_total", f"""{_CARDS}, c AS (SELECT count(*) AS total, count(*) FILTER (asking_price > 0) AS with_price,
  count(*) FILTER (revenue > 0) AS with_revenue, count(*) FILTER (profit > 0) AS with_profit,
  count(*) FILTER (coalesce(location, '') <> '' OR coalesce(city, '') <> '') AS with_location FROM cards)
SELECT *, with_price * 100.0::DOUBLE / total AS pct_price, with_revenue * 100.0::DOUBLE / total AS pct_revenue,
  with_profit * 100.0::DOUBLE / total AS pct_profit, with_location * 100.0::DOUBLE / total AS pct_location FROM c""")
def f2(spark, sf_dir):
    return report.coverage_total(_cards(spark, sf_dir))


@query("f3_coverage_by_source", f"""{_CARDS} SELECT source, count(*) AS listings, count(*) FILTER (revenue > 0) AS with_revenue,
  count(*) FILTER (profit > 0) AS with_profit FROM cards GROUP BY source""")
def f3(spark, sf_dir):
    return report.coverage_by_source(_cards(spark, sf_dir))


@query("f4_completeness", f"""{PRICED} SELECT seq, CAST(coalesce(title <> '', false) AS INT) + CAST(coalesce(price <> 0, false) AS INT)
  + CAST(coalesce(cash_flow <> 0, false) AS INT) + CAST(coalesce(description <> '', false) AS INT)
  + CAST(coalesce(industry <> '', false) AS INT) + CAST(coalesce(listing_url <> '', false) AS INT) AS filled_fields,
  6 AS total_fields FROM priced""")
def f4(spark, sf_dir):
    columns = ("title", "price", "cash_flow", "description", "industry", "listing_url")
    return report.completeness(priced_listings(spark, sf_dir), columns).select("seq", "filled_fields", "total_fields")


_UPDATE_ROWS = f"""{UPDATES}, updates AS (SELECT run_id, event_id AS seq, CASE WHEN event_type = 'signup' THEN site_name END AS site_name,
  CASE event_type WHEN 'signup' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN event_type = 'error' THEN concat('error ', event_id) END AS error_message,
  CASE WHEN event_type = 'click' THEN event_id % 100 END AS new_listings, event_type = 'purchase' AS clears FROM u)"""


def _updates(spark, sf_dir):
    """Every event as a partial update; a purchase clears the error on purpose."""
    kind = C("event_type")
    return i.bind(spark, sf_dir, i.RUNS).select(
        "run_id", C("event_id").alias("seq"), F.when(kind == "signup", C("site_name")).alias("site_name"),
        F.when(kind == "signup", "running").when(kind == "error", "failed").otherwise("completed").alias("status"),
        F.when(kind == "error", F.concat(F.lit("error "), C("event_id").cast("string"))).alias("error_message"),
        F.when(kind == "click", C("event_id") % 100).alias("new_listings"),
        F.when(kind == "purchase", F.array(F.lit("error_message"))).alias("_set_null"))


def _sql_latest(column, assigned):
    return (f"(SELECT x.{column} FROM updates x WHERE x.run_id = r.run_id AND ({assigned}) "
            f"ORDER BY x.seq DESC LIMIT 1) AS {column}")


@query("f5_run_log_state", f"""{_UPDATE_ROWS}, r AS (SELECT DISTINCT run_id FROM updates)
SELECT run_id, {_sql_latest('site_name', 'x.site_name IS NOT NULL')}, {_sql_latest('status', 'x.status IS NOT NULL')},
  {_sql_latest('error_message', 'x.error_message IS NOT NULL OR x.clears')},
  {_sql_latest('new_listings', 'x.new_listings IS NOT NULL')} FROM r""")
def f5(spark, sf_dir):
    return runlog.run_log_state(_updates(spark, sf_dir))


@query("f5_log_state_kept", ORACLES["f5_run_log_state"])
def f5_kept(spark, sf_dir):
    """The same state, kept up over three appends of which each brings updates older than some already taken."""
    folder, updates = own(fresh_path(spark, "log")), _updates(spark, sf_dir)
    for n in range(3):
        updates.filter(F.pmod(F.xxhash64("seq"), F.lit(3)) == n).write.mode("append").parquet(f"{folder}/updates")
        log_state.keep_log_state(spark, f"{folder}/updates", updates.schema, f"{folder}/progress").awaitTermination()
    return log_state.log_state(spark, f"{folder}/progress", updates.schema)


_OUTCOMES = f"""{UPDATES}, o AS (SELECT run_id, site_name, ts, event_type = 'view' AS existing, event_type <> 'error' AS succeeded,
  event_type = 'error' AND event_id % 2 = 0 AS raised FROM u),
a AS (SELECT run_id, site_name, count(*) AS total_listings_found, count(*) FILTER (existing) AS existing_listings,
  count(*) FILTER (NOT existing) AS new_listings, count(*) FILTER (NOT existing AND succeeded) AS successful_scrapes,
  count(*) FILTER (NOT existing AND NOT succeeded) AS failed_scrapes, count(*) FILTER (raised) AS error_count,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS duration_seconds, 'completed' AS status FROM o GROUP BY 1, 2)"""


def _accounts(spark, sf_dir):
    kind = C("event_type")
    outcomes = i.bind(spark, sf_dir, i.RUNS).select(
        "run_id", "site_name", "ts", (kind == "view").alias("existing"), (kind != "error").alias("succeeded"),
        ((kind == "error") & (C("event_id") % 2 == 0)).alias("raised"))
    return runlog.run_accounting(outcomes, F.when(C("site_name") == "QuietLight", 2).otherwise(1))


@query("f6_run_accounting", f"""{_OUTCOMES} SELECT *, (CASE WHEN site_name = 'QuietLight' THEN 2 ELSE 1 END) * 10 + new_listings
  AS api_calls_made, existing_listings AS api_credits_saved FROM a""")
def f6(spark, sf_dir):
    return _accounts(spark, sf_dir).drop("start_time", "end_time", "stored_total")


@query("f7_stored_total", f"""{_OUTCOMES} SELECT site_name, CAST(sum(existing_listings + successful_scrapes) AS BIGINT) AS stored_total
FROM a GROUP BY 1""")
def f7(spark, sf_dir):
    return _accounts(spark, sf_dir).groupBy("site_name").agg(F.sum("stored_total").alias("stored_total"))


_RESULTS = f"""{UPDATES}, res AS (SELECT site_name AS site, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS listings_found,
  event_type = 'click' AS listing_page, event_type = 'purchase' AS data_extracted, event_type = 'signup' AS saved,
  CASE event_type WHEN 'error' THEN concat('Listing scrape failed ', event_id % 3) END AS error FROM u)"""


def _results(spark, sf_dir):
    kind = C("event_type")
    return i.bind(spark, sf_dir, i.RUNS).select(
        C("site_name").alias("site"), (kind == "view").cast("int").alias("listings_found"), (kind == "click").alias("listing_page"),
        (kind == "purchase").alias("data_extracted"), (kind == "signup").alias("saved"),
        F.when(kind == "error", F.concat(F.lit("Listing scrape failed "), (C("event_id") % 3).cast("string"))).alias("error"))


@query("f8_site_status", f"""{_RESULTS}, sites(site) AS (VALUES {', '.join(f"('{s[0]}')" for s in fv.SITES)}),
g AS (SELECT site, sum(listings_found) AS found, bool_or(listing_page) AS lp, bool_or(data_extracted) AS de, bool_or(saved) AS sv,
  count(error) AS ne, min(error) AS fe FROM res GROUP BY site)
SELECT site, coalesce(found > 0, false) AS search_page, coalesce(lp, false) AS listing_page, coalesce(de, false) AS data_extracted,
  coalesce(sv, false) AS saved, CAST(coalesce(found, 0) AS BIGINT) AS listings_found, coalesce(ne, 0)::BIGINT AS n_errors,
  fe AS an_error, CASE WHEN found > 0 THEN 'OK' WHEN fe IS NOT NULL THEN 'Error: ' || fe ELSE 'No listings found' END AS status
FROM sites LEFT JOIN g USING (site)""")
def f8(spark, sf_dir):
    return report.site_status(sites.site_config(spark), _results(spark, sf_dir))


@query("f8_site_errors", f"{_RESULTS} SELECT site, error, count(*) AS n FROM res WHERE error IS NOT NULL GROUP BY ALL")
def f8_errors(spark, sf_dir):
    return report.site_errors(_results(spark, sf_dir))


@query("f9_latest_run_status", f"""{UPDATES}, s AS (SELECT run_id, site_name, min(ts) AS start_time,
  arg_max(event_type, event_id) AS last_type FROM u GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY site_name ORDER BY start_time DESC, run_id DESC) AS rn FROM s)
SELECT site_name, run_id AS last_run_id, strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f') AS last_run,
  CASE last_type WHEN 'signup' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'completed' END AS last_status,
  CASE WHEN last_type = 'error' THEN 'stopped by an error' END AS last_error, last_type = 'signup' AS running FROM k WHERE rn = 1""")
def f9(spark, sf_dir):
    kind = C("event_type")
    updates = i.bind(spark, sf_dir, i.RUNS).select(
        "run_id", C("event_id").alias("seq"), "site_name", C("ts").alias("ts"),
        F.when(kind == "signup", "running").when(kind == "error", "failed").otherwise("completed").alias("status"),
        F.when(kind == "error", "stopped by an error").alias("error_message"),
        F.when(kind != "error", F.array(F.lit("error_message"))).alias("_set_null"))
    starts = updates.groupBy("run_id").agg(F.min("ts").alias("start_time"))
    state = runlog.run_log_state(updates.drop("ts")).join(starts, "run_id")
    return runlog.latest_run_status(state).withColumn("last_run", tx.iso_timestamp(C("last_run")))


@query("g1_high_value_sorted", f"""{PRICED} SELECT title, price, source_site, listing_url FROM priced WHERE price > 1000000
ORDER BY price DESC, listing_url""")
def g1(spark, sf_dir):
    return report.high_value_sorted(priced_listings(spark, sf_dir))


@query("g2_first_n_per_source", f"""{PRICED}, r AS (SELECT source_site, seq, listing_url,
  row_number() OVER (PARTITION BY source_site ORDER BY seq) AS rn FROM priced)
SELECT source_site, seq, listing_url FROM r WHERE rn <= 3""")
def g2(spark, sf_dir):
    return report.first_n_per_source(priced_listings(spark, sf_dir), 3, ["seq"]).select("source_site", "seq", "listing_url")
