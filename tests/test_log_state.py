"""The run log's state, kept up over appends, against all updates regrouped."""
from pyspark.sql import functions as F

from bazaarlens.sources import runlog
from bazaarlens.streaming.log_state import keep_log_state, log_state

UPDATES = "run_id string, seq int, status string, error_message string, n int, _set_null array<string>"


def test_state_kept_up_equals_all_updates_regrouped(spark, tmp_path):
    rows = [("a", 1, "running", None, 0, None), ("a", 5, "completed", None, None, None), ("b", 2, "running", "old", None, None),
            ("a", 3, "paused", None, 7, None),                      # late: its status is older, its count is newer
            ("b", 6, None, None, None, ["error_message"]), (None, 4, "odd", None, None, None), ("c", 9, None, None, None, None),
            ("b", 4, "failed", "late", None, None)]                 # late: behind the clearing of the message
    appends = (rows[:3], rows[3:7], [], rows[7:])
    folder, progress = str(tmp_path / "updates"), str(tmp_path / "progress")
    schema = spark.createDataFrame([], UPDATES).schema
    assert log_state(spark, progress, schema).count() == 0
    for n, new in enumerate(appends):
        spark.createDataFrame(new, UPDATES).coalesce(1).write.mode("append").parquet(folder)
        stream = keep_log_state(spark, folder, schema, progress)
        stream.awaitTermination()
        assert sum(p["numInputRows"] for p in stream.recentProgress) == len(new)  # nothing is read twice
        so_far = spark.createDataFrame([r for a in appends[:n + 1] for r in a], UPDATES)
        want = runlog.run_log_state(so_far)
        got = log_state(spark, progress, schema)
        assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    keep_log_state(spark, folder, schema, progress).awaitTermination()  # nothing new: the state stays
    assert sorted(map(str, log_state(spark, progress, schema).collect())) == sorted(map(str, want.collect()))
    assert len(list((tmp_path / "progress" / "state").iterdir())) <= 2
    b = log_state(spark, progress, schema).filter("run_id = 'b'").first()
    assert (b.status, b.error_message) == ("failed", None)


def test_parts_merge_in_any_grouping(spark):
    updates = spark.range(200).select((F.col("id") % 7).alias("run_id"), F.expr("(id * 37) % 200").alias("seq"),
                                      F.expr("if(id % 3 = 0, NULL, id)").alias("x"), F.expr("if(id % 5 = 0, 's' || id, NULL)").alias("y"))
    parts = [runlog.log_parts(updates.filter(F.col("seq") % 3 == n)) for n in range(3)]
    one = runlog.merged_parts(runlog.merged_parts(parts[0], parts[1]), parts[2])
    other = runlog.merged_parts(parts[2], runlog.log_parts(updates.filter("seq % 3 < 2")))
    want = sorted(map(str, runlog.run_log_state(updates).collect()))
    assert sorted(map(str, runlog.state_of_parts(one).collect())) == want == sorted(map(str, runlog.state_of_parts(other).collect()))
