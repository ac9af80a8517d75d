"""Top-n that stays even when one key holds a large share of the rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: Column,
                    salts: int | None = None) -> DataFrame:
    """The first ``n`` rows of every group, exactly.

    Each salt slice of a group keeps its own first ``n``; only those survivors meet in the
    group's final ranking. A group has as many slices as a shuffle has partitions, so a hot one
    uses all tasks that the size of the job asks for.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    local = salted.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
    kept = local.filter(F.col("_rn") <= n).drop("_salt", "_rn")
    ranked = kept.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")
