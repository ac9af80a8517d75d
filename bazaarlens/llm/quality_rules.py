"""Quality rules: a decision list learned by sequential covering, applied as Spark conditional expressions.

Everything here is DataFrame and Column work. Statistics come from whole texts. Learning grows one
conjunction of thresholds at a time on two thirds of the labelled rows, prunes it on the rest, removes
what it covers and goes on. Each step is one aggregate over a narrow table; a few hundred counts reach the driver.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens import session
from bazaarlens.llm.rows import WORD, free_name

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
#: Statistics that conditions may test.
FEATURES = ("n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "exclaim_share")


def text_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and FEATURES.

    A NULL text counts as empty. Columns of ``docs`` with one of these names are replaced.
    """
    named = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES}
    kept = [c for c in docs.columns if c.lower() not in named]
    words, lines, hashes, windows, places, body = (free_name(docs, f"_{c}") for c in ("words", "lines", "hashes", "windows", "places", "body"))
    read = docs.select(*(F.col(c) for c in kept), F.coalesce(F.col(text_column), F.lit("")).alias(body))
    read = read.select(
        *kept, body, F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias(words),
        F.filter(F.split(body, "\n", -1), lambda x: F.rlike(x, F.lit(WORD))).alias(lines))
    hashed = read.select(
        *kept, F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(body, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).alias(lines), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace(body, r"\P{Lu}+", "")).alias(f"{body}u"),
        (F.length(body) - F.length(F.translate(body, "!", ""))).alias(f"{body}e"),
        F.transform(words, lambda w: F.xxhash64(w)).alias(hashes))
    at = lambda a, i: F.get(F.col(a), i)
    # Windows of three words with their places, equal ones side by side after the sort.
    sorted_windows = hashed.select(
        *(c for c in hashed.columns if c != hashes),
        F.sort_array(F.transform(
            F.when(F.size(hashes) >= 3, F.sequence(F.lit(0), F.size(hashes) - 3)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(F.xxhash64(at(hashes, i), at(hashes, i + 1), at(hashes, i + 2)).alias("h"), i.alias("i")))).alias(windows))
    h = lambda i: at(windows, i)["h"]
    repeated = sorted_windows.select(
        *(c for c in sorted_windows.columns if c != windows),
        F.sort_array(F.filter(F.transform(windows, lambda w, j: F.when(
            F.coalesce(w["h"] == h(j + 1), F.lit(False)) | ((j > 0) & (w["h"] == h(j - 1))), w["i"])), lambda i: i.isNotNull())).alias(places))
    # A window covers three words, less those that the next window covers as well.
    covered = F.aggregate(
        F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(at(places, j + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, n: total + n)
    counted = repeated.select(*(c for c in repeated.columns if c != places), covered.alias("n_repeat_words"))
    share = lambda n, of: F.col(n) / F.greatest(F.col(of).cast("double"), F.lit(1.0))
    return counted.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word_chars"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", lines).alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share(f"{body}u", "word_chars").alias("upper_share"), share(f"{body}e", "n_words").alias("exclaim_share"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value >= self.threshold if self.above else value < self.threshold


@dataclass(frozen=True)
class Rule:
    """Rejects rows that meet all conditions. The counts are those of the pruning rows."""
    conditions: tuple[Condition, ...]
    rejected_bad: int
    rejected_good: int

    def column(self) -> Column:
        return reduce(Column.__and__, (c.column() for c in self.conditions))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: false at the first rule that fits, else true."""
    if not rules:
        return F.lit(True)
    ordered = F.when(rules[0].column(), False)
    for rule in rules[1:]:
        ordered = ordered.when(rule.column(), False)
    return ordered.otherwise(True)


def fit_decision_list(labelled: DataFrame, label: str, key: str, features: tuple[str, ...] = FEATURES, steps: int = 40,
                      least_precision: float = 0.8, least_support: int = 5) -> list[Rule]:
    """Rules that tell rows with ``label`` 0 from rows with 1, by sequential covering over all of ``labelled``.

    Thresholds are ``steps`` quantiles of each feature among the 0 rows. A conjunction grows by the best
    FOIL gain and is pruned to its most precise prefix on the third of rows kept aside by a hash of ``key``.
    Conditions are added while they gain, rules until one falls below ``least_precision`` or ``least_support`` there; a
    rule takes as many bad rows away at least, so learning ends. Rows with a NULL label are
    ignored; without 0 rows there are no rules.
    """
    names = list(features)
    rows = session.cut(labelled.filter(F.col(label).isin(0, 1)).select(
        *(F.col(f).cast("double").alias(f) for f in names), (F.col(label) == 0).alias("_bad"),
        (F.pmod(F.xxhash64(F.col(key)), F.lit(3)) == 0).alias("_prune")))
    at = [i / (steps + 1) for i in range(1, steps + 1)]
    cuts = rows.filter("_bad AND NOT _prune").agg(*(F.percentile_approx(f, at, 10_000).alias(f) for f in names)).first()
    thresholds = {f: sorted(set(cuts[f] or [])) for f in names}
    if not any(thresholds.values()):
        return []
    # Per feature: how many thresholds the value reaches. Counts by this number give every condition's counts.
    reached = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), _reached(F.col(f), thresholds[f]).alias("b"))
                                  for i, f in enumerate(names)))).alias("x")

    def histogram(part: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
        counts = (part.select("_bad", reached).groupBy("x.f", "x.b")
                  .agg(F.count_if("_bad").alias("bad"), F.count_if(~F.col("_bad")).alias("good")))
        return {(r["f"], r["b"]): (r["bad"], r["good"]) for r in counts.collect()}  # features x steps rows at most

    rules: list[Rule] = []
    left = rows
    while True:
        grown: list[Condition] = []
        part = left.filter(~F.col("_prune"))
        while True:
            best = _best_condition(histogram(part), names, thresholds, least_support)
            if best is None:
                break
            grown.append(best)
            part = part.filter(best.column())
        if not grown:
            break
        prefixes = [reduce(Column.__and__, (c.column() for c in grown[:n])) for n in range(1, len(grown) + 1)]
        counts = left.filter("_prune").agg(*(F.count_if(p & (F.col("_bad") == b)).alias(f"n{i}_{int(b)}")
                                             for i, p in enumerate(prefixes) for b in (True, False))).first()
        scored = [(counts[f"n{i}_1"], counts[f"n{i}_0"], i + 1) for i in range(len(prefixes))]
        bad, good, n = max(scored, key=lambda x: ((x[0] - x[1]) / max(x[0] + x[1], 1), x[0], -x[2]))
        if bad < least_support or bad < least_precision * (bad + good):
            break
        rules.append(Rule(tuple(grown[:n]), bad, good))
        left = left.filter(~rules[-1].column())
    return rules


def _reached(value: Column, thresholds: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, thresholds)).cast("array<double>"), lambda t: t <= value))


def _best_condition(counts: dict[tuple[int, int], tuple[int, int]], names: list[str], thresholds: dict[str, list[float]],
                    least_support: int) -> Condition | None:
    total = [sum(v[k] for (f, _), v in counts.items() if f == 0) for k in (0, 1)]
    if total[0] < least_support or not total[1]:
        return None
    purity = lambda bad, good: math.log2(bad / (bad + good))
    best, most = None, 1e-9
    for i, name in enumerate(names):
        bad = good = 0  # of rows below the threshold
        for b, threshold in enumerate(thresholds[name]):
            x, y = counts.get((i, b), (0, 0))
            bad, good = bad + x, good + y
            for above, p, n in ((False, bad, good), (True, total[0] - bad, total[1] - good)):
                if p >= least_support and (gain := p * (purity(p, n) - purity(*total))) > most:
                    best, most = Condition(name, above, threshold), gain
    return best


def label_quality(labels: DataFrame, id_column: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row per labelled id, ``_id`` and ``_label``; of repeated labels the lowest counts."""
    return (labels.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label")).dropna()
            .groupBy("_id").agg(F.min("_label").alias("_label")))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base_failed and kept of every row of ``docs`` (doc_id, text), by rules learned from ``labels``.

    Empty and NULL texts fail the base rules. Repeated ids are separate rows (each is a labelled row).
    """
    stats = session.cut(text_statistics(docs.select("doc_id", "text")))
    rules = fit_decision_list(stats.filter(~base_failed()).join(label_quality(labels), F.col("doc_id") == F.col("_id")), "_label", "doc_id")
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned rules keep, all columns unchanged."""
    labelled = docs.select("doc_id", "text").join(label_quality(labels), F.col("doc_id") == F.col("_id"))
    stats = session.cut(text_statistics(labelled))
    rules = fit_decision_list(stats.filter(~base_failed()), "_label", "doc_id")
    whole = free_name(docs, "_row")
    judged = text_statistics(docs.select(F.struct(*docs.columns).alias(whole), F.col("text").alias(free_name(docs, "_text"))), free_name(docs, "_text"))
    # Statistics leave through a generator: a filter on them is not copied down into their computation.
    once = judged.select(whole, F.explode(F.array(F.struct("n_words", "n_repeat_words", *(f for f in FEATURES if f != "n_words")))).alias("_s"))
    return once.select(whole, "_s.*").filter(~base_failed() & verdict(rules)).select(f"{whole}.*")
