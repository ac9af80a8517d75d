"""Connected components of an edge table, by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens import session


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v: distinct, still u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(least, "u")
    return (joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def roots(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for every node with an edge but the roots themselves; root is the smallest node reachable.

    ``edges`` has u and v (long), in any order; self-links and repeats don't matter. The table of a round is
    written to the shared folder; the driver sees one count and one checksum a round.
    """
    now = session.cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        sums = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (sums["n"], sums["s"]) == state or not sums["n"]:
            return now.select("u", F.col("v").alias("root"))
        state = (sums["n"], sums["s"])
        now = session.cut(_stars(now))
