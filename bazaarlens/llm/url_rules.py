"""URL filter: a sort-merge range join of URLs with nested host and path rules.

A key is the reversed host, a separator and the path, so everything that starts with a rule's key is
one interval of the sorted keys. A URL has a key for each of its parent hosts that a rule may name.
Keys and rules are sorted into ranges together; a sweep finds the nearest rule start before each key,
and the stack of rules around that start holds every rule still open there.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from bazaarlens import session

RULES_SCHEMA = "host string, path string, verdict string"
_SEPARATOR = "\u0001"


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host: Column, labels: Column | None = None) -> Column:
    parts = F.split(host, r"\.", -1)
    return F.array_join(F.reverse(parts if labels is None else F.slice(parts, F.size(parts) - labels + 1, labels)), ",")


def _key(reversed_host: Column, path: Column) -> Column:
    return F.concat(reversed_host, F.lit(_SEPARATOR), path)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each distinct (host, path) with its key and ``stack``: itself and all rules whose interval holds it, by key.

    Of several verdicts for one (host, path), ``block`` wins (the largest text). Rules with a NULL are ignored.
    """
    plain = (rules.select("host", "path", "verdict").dropna().groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("key", _key(_reversed(F.col("host")), F.col("path"))))
    outer = plain.select(F.col("key").alias("prefix"), F.struct("key", "host", "path", "verdict").alias("outer"))
    inner = plain.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")),
                                                      lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("prefix"))
    return (inner.join(outer, "prefix").groupBy(F.col("key").alias("start"))
            .agg(F.sort_array(F.collect_list("outer")).alias("stack")))  # at most one rule for each character of the key


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule of each distinct (host, path) of ``urls``: host, path, rule, rule_verdict.

    ``rules`` has host, path, verdict. A rule fits its host and all subdomains where the path starts with
    the rule's path; the longest host plus path wins, then the longer host. Pairs without a rule are absent.
    NULLs in ``urls`` match nothing; no rules or no URLs give no rows.
    """
    spark = urls.sparkSession
    stacks = session.cut(rule_stacks(rules))
    deepest = stacks.agg(F.max(F.size(F.split(F.element_at("stack", -1)["host"], r"\.", -1)))).first()[0] or 0
    labels = F.least(F.size(F.split("host", r"\.", -1)), F.lit(deepest))
    keys = (urls.select("host", "path").dropna().distinct()
            .filter(F.lit(deepest > 0))
            .withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(labels, F.lit(1)))))
            .select(_key(_reversed(F.col("host"), F.col("n")), F.col("path")).alias("key"), "host", "path",
                    F.lit(None).cast("string").alias("start")))
    starts = stacks.select(F.col("start").alias("key"), F.lit("").alias("host"), F.lit("").alias("path"), "start")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A range may begin inside a run of equal keys: the host is part of the order, so no key is hot.
    ranges = session.cut(keys.unionByName(starts).repartitionByRange(parts, "key", "host", "path")
                         .withColumn("range", F.spark_partition_id()))
    before = W.Window.orderBy("range").rowsBetween(W.Window.unboundedPreceding, -1)
    entering = (ranges.groupBy("range").agg(F.max("start").alias("last_start"))  # a row for each range
                .select("range", F.last("last_start", ignorenulls=True).over(before).alias("entered")))
    sweep = (W.Window.partitionBy("range").orderBy("key", F.col("start").isNull(), "host", "path")
             .rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow))
    swept = (ranges.join(entering, "range")
             .withColumn("nearest", F.coalesce(F.last("start", ignorenulls=True).over(sweep), F.col("entered")))
             .filter(F.col("start").isNull() & F.col("nearest").isNotNull()))
    # Of the rules open at the nearest start, those that ended before the key are popped.
    open_rules = F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"]))
    found = (swept.select("key", "host", "path", F.col("nearest").alias("start")).join(stacks, "start")
             .select("host", "path", F.try_element_at(F.filter(open_rules, _fits), F.lit(-1)).alias("r"))
             .filter(F.col("r").isNotNull()))
    longest = F.struct((F.length("r.host") + F.length("r.path")).alias("n"), F.length("r.host").alias("m"))
    return (found.groupBy("host", "path").agg(F.max_by("r", longest).alias("r"))
            .select("host", "path", F.concat("r.host", "r.path").alias("rule"), F.col("r.verdict").alias("rule_verdict")))


def _fits(rule: Column) -> Column:
    """The exact test behind the key: the host or a subdomain of it, and the start of the path."""
    host, path = F.col("host"), F.col("path")
    return ((host == rule["host"]) | F.endswith(host, F.concat(F.lit("."), rule["host"]))) & F.startswith(path, rule["path"])


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str, url_column: str, default: str = "allow") -> DataFrame:
    """Each row's id, host, path, rule and verdict; ``default`` where no rule fits, also for NULL or odd URLs.

    Repeated ids stay repeated rows. Other columns are not read, so their names don't matter.
    """
    rows = pages.select(F.col(id_column), url_host(F.col(url_column)).alias("host"), url_path(F.col(url_column)).alias("path"))
    matched = match_rules(rows, rules)
    return (rows.join(matched, ["host", "path"], "left")
            .select(F.col(id_column), "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict")))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, T.StructType.fromDDL(RULES_SCHEMA))
