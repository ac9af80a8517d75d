"""Session settings and the shared folder of a job."""
from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. On a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName("bazaarlens")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",  # a number that doesn't fit fails instead of becoming NULL
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",  # pages do repeat keys; the last one counts
        "spark.sql.files.maxPartitionBytes": "32m",  # compressed pages: one split is parsed by one task
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",  # pages are large rows
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or where that is unset the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/bazaarlens/{name}-{uuid.uuid4().hex}"


_OWNED: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def own(path: str) -> str:
    """Note a folder of intermediate rows, to be removed at the end of the job."""
    _OWNED.append(path)
    return path


@atexit.register
def remove_owned() -> None:
    """Remove the noted folders, if their session still runs; they are named by random ids, so no other job has them."""
    spark = SparkSession.getActiveSession()
    if spark is None or not _OWNED:
        return
    try:
        for path in _OWNED:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception:  # the JVM may be gone already at exit; the folders then stay for the cluster's cleaning
        pass
    _OWNED.clear()


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there: one computation, however many
    readers, each reading only its columns, and nothing to recompute when an executor is lost.
    What was shuffled on the way is removed as soon as the rows are written."""
    spark, path = df.sparkSession, own(fresh_path(df.sparkSession, "cut"))
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
