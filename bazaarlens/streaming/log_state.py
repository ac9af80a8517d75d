"""F5, kept up: the run log's state as a snapshot merged with the updates since, instead of all updates regrouped."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from bazaarlens.sources import runlog


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _version(progress: str, batch: int) -> str:
    return f"{progress.rstrip('/')}/state/version={batch:012d}"


def _newest(spark: SparkSession, progress: str) -> str | None:
    """The last version that was written to its end."""
    done, files = _path(spark, f"{progress.rstrip('/')}/state/version=*/_SUCCESS")
    found = sorted(str(s.getPath().getParent().toString()) for s in files.globStatus(done) or ())
    return found[-1] if found else None


def keep_log_state(spark: SparkSession, updates_dir: str, schema: T.StructType, progress: str, key: str = "run_id",
                   seq: str = "seq", files_per_batch: int = 1000) -> StreamingQuery:
    """Take the update files of ``updates_dir`` not seen before into the state below ``progress``, then stop.

    A batch reads its own files and the version before it, and writes the next version: per run and column the last
    assignment with its place, so that late updates find their order. A batch that is repeated writes its own version
    again and changes nothing else; the last two versions stay, so a reader is not cut off. Progress and state lie
    in one folder, as neither means anything without the other.
    """
    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        parts = runlog.log_parts(batch, key, seq)
        at, files = _path(own, _version(progress, number - 1))
        if number > 0 and files.exists(at):
            parts = runlog.merged_parts(own.read.parquet(_version(progress, number - 1)), parts, key=key)
        parts.write.mode("overwrite").parquet(_version(progress, number))
        old, files = _path(own, _version(progress, number - 2))
        if number > 1 and files.exists(old):
            files.delete(old, True)

    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(updates_dir)
        .writeStream.foreachBatch(take).option("checkpointLocation", f"{progress.rstrip('/')}/checkpoint")
        .trigger(availableNow=True).start())


def log_state(spark: SparkSession, progress: str, schema: T.StructType, key: str = "run_id", seq: str = "seq") -> DataFrame:
    """The state as of the last batch: what ``runlog.run_log_state`` gives over all updates taken; no rows before the first."""
    newest = _newest(spark, progress)
    if newest is None:
        return runlog.run_log_state(spark.createDataFrame([], schema), key, seq)
    return runlog.state_of_parts(spark.read.parquet(newest), key)
