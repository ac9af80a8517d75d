"""Store, run log, frontier helpers, skew helpers and the stream."""
import datetime as dt
import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from bazaarlens import fixed_values as fv, schemas
from bazaarlens.operators import report
from bazaarlens.plans import catalog
from bazaarlens.plans.ingest import ingest_run
from bazaarlens.operators.skew import first_per_group
from bazaarlens.session import shared_dir
from bazaarlens.sources import captures, runlog, sites, store
from bazaarlens.streaming.incremental import incremental_ingest


def stamp():
    return F.lit("2024-05-01 02:00:00").cast("timestamp")


def test_site_dimension_and_choice(spark):
    config = sites.site_config(spark)
    assert config.count() == 9
    assert {r.name for r in sites.select_sites(config, ["Flippa", "Acquire"]).collect()} == {"Flippa"}
    resolved = {(r.name, r.search_pos): r.resolved_url for r in sites.resolve_search_urls(config).collect()}
    assert resolved["BizQuest", 0].endswith("/amazon-business-for-sale/") and ("BizQuest", 1) not in resolved
    assert resolved["QuietLight", 1].endswith("/ecommerce-businesses-for-sale/")


def test_tables_are_created_once_with_the_fixed_schema(spark, tmp_path):
    for _ in range(2):
        store.create_listings_table(spark, "t_listings", str(tmp_path / "l"))
        store.create_log_table(spark, "t_log", str(tmp_path / "r"))
    assert spark.table("t_listings").columns == [f.name for f in schemas.LISTINGS.fields]
    assert spark.table("t_log").columns == [f.name for f in schemas.RUN_LOG.fields]
    assert len(schemas.LISTINGS.fields) == 25 and len(schemas.RUN_LOG.fields) == 15


def test_append_leaves_bad_rows_to_rejects(spark, tmp_path):
    rows = spark.createDataFrame([("A", "https://x/1", "t", 5.0), ("A", None, "u", 6.0)],
                                 "source_site string, listing_url string, title string, price double")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("description", "industry")})
    listings = store.to_listings(rows, stamp())
    store.create_listings_table(spark, "t_append", str(tmp_path / "a"))
    store.append_listings(listings, "t_append")
    assert [r.title for r in spark.table("t_append").collect()] == ["t"]
    assert [r.reject_reason for r in store.rejected(listings).collect()] == ["id is missing"]
    assert sorted(p.name for p in (tmp_path / "a").glob("source_site=*")) == ["source_site=A"]


def test_json_sink_writes_iso_times(spark, tmp_path):
    for _ in range(2):  # a run never overwrites another
        store.write_json(spark.range(1).withColumn("at", stamp()), str(tmp_path / "j"))
    first, _ = sorted((tmp_path / "j").iterdir())
    line = "".join(p.read_text() for p in first.glob("*.json"))
    assert json.loads(line) == {"id": 0, "at": "2024-05-01T02:00:00.000000"}


def test_captures_from_json_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"url":"u","html":"<p>"}\n{"url":"v"}\n')
    assert [r.url for r in captures.read_captures(spark, str(tmp_path), "json").collect()] == ["u"]


def test_explicit_null_beats_an_older_value(spark):
    df = spark.createDataFrame(
        [("r", 1, "boom", None), ("r", 2, None, ["error"]), ("r", 3, None, None), ("s", 1, "x", None)],
        "run_id string, seq int, error string, _set_null array<string>")
    assert {r.run_id: r.error for r in runlog.run_log_state(df).collect()} == {"r": None, "s": "x"}


def test_run_accounting(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("r", "S", t, True, True, False), ("r", "S", t + dt.timedelta(seconds=1.5), False, True, False),
            ("r", "S", t, False, False, True)]
    df = spark.createDataFrame(rows, "run_id string, site_name string, ts timestamp, existing boolean, succeeded boolean, raised boolean")
    row = runlog.run_accounting(df, F.lit(2)).first()
    assert (row.total_listings_found, row.existing_listings, row.new_listings, row.successful_scrapes, row.failed_scrapes,
            row.error_count, row.duration_seconds, row.api_calls_made, row.stored_total) == (3, 1, 2, 1, 1, 1, 1.5, 22, 2)


def test_sites_without_results_still_report(spark):
    results = spark.createDataFrame([("Flippa", 0, False, False, False, "boom")],
                                    "site string, listings_found int, listing_page boolean, data_extracted boolean, saved boolean, error string")
    status = {r.site: r.status for r in report.site_status(sites.site_config(spark), results).collect()}
    assert len(status) == len(fv.SITES)
    assert status["Flippa"] == "Error: boom" and status["QuietLight"] == "No listings found"


def test_first_per_group_is_exact_on_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    out = first_per_group(df, ["k"], [F.desc("id")], 4, F.col("id")).filter("k = 'hot'").orderBy("id")
    assert [r.id for r in out.collect()] == [4994, 4996, 4997, 4999]


def test_first_per_group_beyond_a_thousand(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 5 > 0, "hot").otherwise("cold").alias("k"), "id")
    out = first_per_group(df, ["k"], [F.desc("id")], 1500, F.col("id")).filter("k = 'hot'")
    assert sorted(r.id for r in out.collect()) == sorted([i for i in range(8999, -1, -1) if i % 5 > 0][:1500])


def test_pages_are_not_sorted_and_move_once_at_most(spark, tmp_path):
    shots = spark.createDataFrame([("u", "<p>", True, dt.datetime(2024, 5, 1), "Flippa")], captures.CAPTURE_SCHEMA)
    shots.write.parquet(str(tmp_path / "c"))
    named = spark.read.parquet(str(tmp_path / "c")).withColumnRenamed("url", "listing_url")
    known = spark.createDataFrame([("Flippa", "v")], "source_site string, listing_url string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = captures.prefer_rendered(named, *store.URL_KEY, known=known)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    single = plan[:plan.index("dropDuplicates") if "dropDuplicates" in plan else plan.index("SortAggregate")]
    assert "ShuffledHashJoin" in single and "SortMergeJoin" not in single.split("LeftSemi")[0]
    ranking = [line for line in plan.splitlines() if "Aggregate" in line and "_equals" in line]
    assert plan.count("md5(") and "md5(" not in single
    assert ranking and not any("html" in line.split("functions=")[-1] for line in ranking)
    assert [r.listing_url for r in fresh.collect()] == ["u"]


def test_captures_equal_in_order_are_decided_by_their_pages(spark):
    t, late = dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)
    rows = ([("hot", f"<p>{k % 7}", True, t, "S") for k in range(300)] + [("hot", None, True, late, "S"), ("hot", "<p>later", False, late, "S")]
            + [("one", "<p>x", None, None, "S"), ("two", "<p>a", False, None, "S"), ("two", "<p>b", False, None, "S"), ("two", "<p>z", None, late, "S"),
               (None, "<p>n", True, t, "S"), (None, "<p>n", True, t, None), ("gone", None, True, t, "S"), ("void", "", True, t, "S")])
    got = captures.prefer_rendered(spark.createDataFrame(rows, captures.CAPTURE_SCHEMA)).collect()
    largest = lambda *pages: max(pages, key=lambda p: hashlib.md5(p.encode()).hexdigest())
    assert {r.url: r.html for r in got} == {"hot": largest(*(f"<p>{k}" for k in range(7))), "one": "<p>x", "two": largest("<p>a", "<p>b"), None: "<p>n", "void": ""}
    assert len(got) == 5 and got[0].__fields__ == captures.CAPTURE_SCHEMA.names
    assert captures.prefer_rendered(spark.createDataFrame([], captures.CAPTURE_SCHEMA)).count() == 0


def test_pages_of_one_url_equal_their_sql(spark, tmp_path):
    rows = [(n, f"https://e.org/{n % 6}", f"<p>{n * 7 % 24:02d} page") for n in range(24)] + [(24, "https://e.org/0", "<p>00 page")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = catalog.QUERIES["a3_prefer_rendered"](spark, str(tmp_path)).drop("page_id").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT url, rendered, html_md5 FROM ({catalog.ORACLES['a3_prefer_rendered']})").fetchall())


def test_stored_table_prunes_to_one_site(spark, tmp_path):
    store.create_listings_table(spark, "t_prune", str(tmp_path / "p"))
    plan = store.by_site(spark.table("t_prune"), "Flippa")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_site" in plan


def test_repeated_and_late_captures_are_stored_once(spark, tmp_path):
    store.create_listings_table(spark, "t_stream", str(tmp_path / "s"))

    def drop(*rows):
        data = [(u, h, r, dt.datetime(2024, 5, d), "WebsiteClosers") for u, h, r, d in rows]
        spark.createDataFrame(data, captures.CAPTURE_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        incremental_ingest(spark, str(tmp_path / "in"), "t_stream", str(tmp_path / "cp"), files_per_batch=1).awaitTermination()

    drop(("u1", "<h1>plain</h1>", False, 2), ("u1", "<h1>rendered</h1>", True, 1), ("u2", None, True, 1))
    drop(("u1", "<h1>again</h1>", True, 3), ("u2", "<h1>two</h1>", False, 3))
    rows = {r.listing_url: (r.title, r.source_site, r.scraped_at) for r in spark.table("t_stream").collect()}
    assert rows == {"u1": ("rendered", "WebsiteClosers", dt.datetime(2024, 5, 1)), "u2": ("two", "WebsiteClosers", dt.datetime(2024, 5, 3))}


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_a_run_is_logged_from_start_to_end(spark, tmp_path):
    store.create_listings_table(spark, "t_run", str(tmp_path / "l"))
    store.create_log_table(spark, "t_runlog", str(tmp_path / "g"))
    page = [("u1", "<h1>a</h1>"), ("u2", "<h1>b</h1>"), ("u3", "<h1> </h1>"), ("other", "<h1>not found by the crawl</h1>")]
    shots = spark.createDataFrame([(u, h, True, dt.datetime(2024, 5, 1), "WebsiteClosers") for u, h in page], captures.CAPTURE_SCHEMA)

    def found(*urls):
        return spark.createDataFrame([("WebsiteClosers", u) for u in urls], "source_site string, listing_url string")

    ingest_run(spark, "r1", found("u1", "u1"), shots, "t_run", "t_runlog", F.lit(1))
    ingest_run(spark, "r2", found("u1", "u2", "u3", "u4"), shots, "t_run", "t_runlog", F.lit(2), pages=1)
    assert sorted(r.listing_url for r in spark.table("t_run").collect()) == ["u1", "u2"]
    log = {r.run_id: r for r in runlog.current_run_log(spark.table("t_runlog")).collect()}
    assert spark.table("t_runlog").count() == 4
    row = log["r2"]
    assert (row.status, row.total_listings_found, row.existing_listings, row.new_listings, row.successful_scrapes,
            row.failed_scrapes, row.api_calls_made, row.api_credits_saved) == ("completed", 4, 1, 3, 1, 2, 5, 1)
    assert row.end_time >= row.start_time and row.duration_seconds >= 0


def test_a_broken_run_is_logged_as_failed(spark, tmp_path):
    store.create_listings_table(spark, "t_broken", str(tmp_path / "l"))
    store.create_log_table(spark, "t_brokenlog", str(tmp_path / "g"))
    found = spark.createDataFrame([("Flippa", "u")], "source_site string, listing_url string")
    broken = spark.createDataFrame([("u",)], "url string")
    with pytest.raises(Exception):
        ingest_run(spark, "r", found, broken, "t_broken", "t_brokenlog", F.lit(1))
    row = runlog.current_run_log(spark.table("t_brokenlog")).first()
    assert (row.status, row.error_count, row.total_listings_found) == ("failed", 1, 0) and row.error_message


def test_two_streams_each_keep_their_rejects(spark, tmp_path):
    rows = [("https://a.example/1", "<h1>t</h1>", False, dt.datetime(2024, 5, 1), "Nowhere")]
    captures = spark.createDataFrame(rows, "url string, html string, rendered boolean, fetched_at timestamp, source_site string")
    captures.write.parquet(str(tmp_path / "in"))
    store.create_listings_table(spark, "t_two_streams", str(tmp_path / "t"))
    for name in ("first", "second", "first"):  # the last one goes on from its checkpoint and finds nothing new
        incremental_ingest(spark, str(tmp_path / "in"), "t_two_streams", str(tmp_path / name)).awaitTermination()
    runs = [r["run"] for r in spark.table("t_two_streams_rejects").collect()]
    assert len(runs) == 2 == len(set(runs)) and all(r.endswith(" batch 0") and not r.startswith("batches") for r in runs)
