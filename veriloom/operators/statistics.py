"""Agreement, reliability and label statistics as aggregations."""

from __future__ import annotations

import random
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import jaccard, rate

BOOTSTRAP, BOOTSTRAP_SEED = 1000, 20260728


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """stage, n: one count for each."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("stage"), "n") for k, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def counted(rows: DataFrame, *by: Column) -> DataFrame:
    """Groups and their sizes, largest first."""
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col("n").desc(), *[F.col(c) for c in out.columns if c != "n"])


def quarter(date: Column) -> Column:
    """2024-Q3 (A05, X18)."""
    return F.concat(F.year(date).cast("string"), F.lit("-Q"), F.quarter(date).cast("string"))


def confusion(rows: DataFrame, judge: Column, human: Column) -> DataFrame:
    """Confusion matrix, precision, NPV and raw agreement of decided rows with intervals, and the
    corpus estimate (A09, A10, A12).  ``human`` is null where undecided."""
    j, h = judge.cast("int"), human.cast("int")
    m = rows.where(human.isNotNull()).agg(
        F.count_if((j == 1) & (h == 1)).alias("tp"), F.count_if((j == 1) & (h == 0)).alias("fp"), F.count_if((j == 0) & (h == 0)).alias("tn"), F.count_if((j == 0) & (h == 1)).alias("fn")
    )
    parts = {"precision": ("tp", F.col("tp") + F.col("fp")), "npv": ("tn", F.col("tn") + F.col("fn")), "agreement": (None, F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))}
    rows_ = [m.select("tp", "fp", "tn", "fn", F.lit(k).alias("measure"), *rate(F.col(c) if c else F.col("tp") + F.col("tn"), n)) for k, (c, n) in parts.items()]
    return reduce(DataFrame.unionByName, rows_)


def corpus_estimate(share: Column, precision: Column, npv: Column) -> Column:
    return F.round(share * precision + (1 - share) * npv, 4)


def breakdown(rows: DataFrame, by: str, agree: Column) -> DataFrame:
    """Agreement of decided rows and the number of undecided, by group."""
    g = rows.groupBy(by).agg(F.count_if(F.coalesce(agree, F.lit(False))).alias("yes"), F.count(agree).alias("decided"), F.count_if(agree.isNull()).alias("unsure"))
    return g.select(by, *rate(F.col("yes"), F.col("decided")), "unsure")


def kappa(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """n and Cohen's kappa, null where chance leaves no room (A13): from the contingency table."""
    table = rows.select(a.cast("string").alias("a"), b.cast("string").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    total = table.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a").eqNullSafe(F.col("b")), F.col("n")).otherwise(0)).alias("same"))
    of = lambda c: table.groupBy(F.col(c).alias("v")).agg(F.sum("n").alias(f"n_{c}"))
    chance = of("a").join(of("b"), "v").agg(F.sum(F.col("n_a") * F.col("n_b")).alias("chance"))
    out = total.crossJoin(chance)  # one row by one row
    po, pe = F.col("same") / F.col("n"), F.coalesce(F.col("chance"), F.lit(0)) / (F.col("n") * F.col("n"))
    return out.select(F.coalesce("n", F.lit(0)).alias("n"), F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 4).alias("kappa"))


def kappas(tables: np.ndarray) -> np.ndarray:
    """Cohen's kappa of each of a stack of square contingency tables; NaN where chance leaves no room."""
    n = tables.sum((1, 2)).astype(float)
    seen = np.trace(tables, axis1=1, axis2=2)
    by_chance = (tables.sum(2) * tables.sum(1)).sum(1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(by_chance < n * n, (seen * n - by_chance) / (n * n - by_chance), np.nan)


def kappa_interval(pairs: pd.DataFrame, times: int = BOOTSTRAP, seed: int = BOOTSTRAP_SEED) -> tuple[float, float] | None:
    """Percentile bootstrap over the units of a review sample, which is small by design (A14): each
    resample is a contingency table of drawn units, all tables are evaluated at once."""
    n = len(pairs)
    if n < 2:
        return None
    values = pd.unique(pairs.to_numpy().ravel())
    code = pd.Index(values).get_indexer(pairs.iloc[:, 0]) * len(values) + pd.Index(values).get_indexer(pairs.iloc[:, 1])
    rng = random.Random(seed)
    units = np.fromiter((rng.randrange(n) for _ in range(times * n)), np.int64, times * n).reshape(times, n)
    cells = len(values) ** 2
    tables = np.bincount((code[units] + cells * np.arange(times)[:, None]).ravel(), minlength=times * cells)
    got = kappas(tables.reshape(times, len(values), len(values)))
    got = np.sort(got[~np.isnan(got)])
    if len(got) < times // 2:
        return None
    last = len(got) - 1
    return round(float(got[int(0.025 * last)]), 4), round(float(got[round(0.975 * last)]), 4)


def family_rates(rows: DataFrame, by: str = "family") -> DataFrame:
    """For each family: precision and NPV of decided pairs, NPV reweighted to the whole vocabulary,
    kappa, and lists of misses and false applications (A16).  ``rows`` are the pairs of a review sample
    (applied, human_applies, agreement, sel_p, label, jurisdiction, candidate_id, note)."""
    d = rows.where("agreement is not null and agreement <> 'unsure'")
    j, h = F.col("applied"), F.col("human_applies")
    w = F.when(~j & (F.col("sel_p") > 0), 1.0 / F.col("sel_p"))
    told = F.struct("label", "jurisdiction", "candidate_id", "note")
    listed = lambda cond: F.sort_array(F.collect_list(F.when(cond, told)))
    g = d.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(j & h).alias("tp"), F.count_if(j).alias("applied"), F.count_if(h).alias("human"), F.count_if(~j & ~h).alias("tn"), F.count_if(~j).alias("left_off"),
        F.sum(w).alias("w"), F.sum(F.when(~h, w)).alias("w_agreed"), listed(~j & h).alias("misses"), listed(j & ~h).alias("false_applications"),
    )
    po = (F.col("tp") + F.col("tn")) / F.col("n")
    pe = (F.col("applied") * F.col("human") + F.col("left_off") * (F.col("n") - F.col("human"))) / (F.col("n") * F.col("n"))
    share = lambda k, n: F.round(F.when(F.col(n) > 0, F.col(k) / F.col(n)), 4)
    return g.select(
        by, "n", share("tp", "applied").alias("precision"), share("tn", "left_off").alias("npv"),
        F.round(F.when(F.col("w") > 0, F.coalesce("w_agreed", F.lit(0.0)) / F.col("w")), 4).alias("npv_reweighted"),
        F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 4).alias("kappa"), "misses", "false_applications",
    )


def horvitz_thompson(rows: DataFrame, p: Column, agree: Column, *by: str) -> DataFrame:
    """n, Kish effective size and weighted rate of units drawn with probability p."""
    w = F.when(p > 0, 1.0 / p)
    g = rows.where(w.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(w).alias("t"), F.sum(w * w).alias("q"), F.sum(F.when(agree, w).otherwise(0.0)).alias("a"))
    return g.select(*by, "n", F.round(F.when(F.col("n") > 0, F.col("t") * F.col("t") / F.col("q")).otherwise(0.0), 1).alias("ess"), F.round(F.col("a") / F.col("t"), 4).alias("rate"))


def pair_sets(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """Exact-match rate, mean Jaccard and mean size of paired label sets."""
    return rows.select(F.array_distinct(a).alias("a"), F.array_distinct(b).alias("b")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.when((F.size(F.array_except("a", "b")) == 0) & (F.size(F.array_except("b", "a")) == 0), 1.0).otherwise(0.0)), 3).alias("exact_set_match"),
        F.round(F.avg(jaccard(F.col("a"), F.col("b"))), 3).alias("mean_jaccard"),
        F.round(F.avg(F.size("a") + F.size("b")) / 2, 2).alias("mean_labels"),
    )


def label_agreement(rows: DataFrame, a: Column, b: Column, labels: list[str]) -> DataFrame:
    """For each label: how often both sides agree on it, and when either asserts it."""
    each = rows.select(a.alias("a"), b.alias("b"), F.explode(F.array(*map(F.lit, labels))).alias("label"))
    x, y = F.array_contains("a", F.col("label")), F.array_contains("b", F.col("label"))
    g = each.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(x == y).alias("same"), F.count_if(x | y).alias("asserted_by_either"), F.count_if(x & y).alias("both"))
    return g.select("label", F.round(F.col("same") / F.col("n"), 3).alias("agreement"), F.round(F.when(F.col("asserted_by_either") > 0, F.col("both") / F.col("asserted_by_either")), 3).alias("positive_agreement"), "asserted_by_either")


def drift(rows: DataFrame, before: Column, after: Column) -> DataFrame:
    """How often each label was added and dropped."""
    moved = rows.select(F.explode(F.concat(F.transform(F.array_except(after, before), lambda t: F.struct(t.alias("label"), F.lit(1).alias("added"))), F.transform(F.array_except(before, after), lambda t: F.struct(t.alias("label"), F.lit(0).alias("added"))))).alias("m"))
    return moved.groupBy("m.label").agg(F.sum("m.added").alias("n_added"), F.sum(1 - F.col("m.added")).alias("n_dropped"))


def label_counts(rows: DataFrame, key: str, label: str) -> DataFrame:
    return rows.select(key, label).distinct().groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def cooccurrence(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Ordered pairs of labels on one key and their number (A17).  A key's labels come from a fixed
    vocabulary, so its pairs are bounded by that, not by rows."""
    sets = rows.groupBy(key).agg(F.collect_set(label).alias("ls"))
    pairs = sets.select(F.explode("ls").alias("a"), "ls").select("a", F.explode("ls").alias("b")).where("a <> b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def negative_weights(rows: DataFrame, key: str, label: str, vocabulary: list[str]) -> DataFrame:
    """How plausible each label is that a key does not have (A25): sum of P(b|a) over its labels, and
    a floor that keeps every label drawable."""
    counts, pairs = label_counts(rows, key, label), cooccurrence(rows, key, label)
    own = rows.groupBy(key).agg(F.collect_set(label).alias("ls"))
    given = pairs.join(counts.select(F.col(label).alias("a"), F.col("n").alias("n_a")), "a").select("a", "b", (F.col("n") / F.col("n_a")).alias("p"))
    sums = own.select(key, F.explode("ls").alias("a")).join(given, "a").groupBy(key, "b").agg(F.sum("p").alias("p"))
    total = counts.agg(F.sum("n").alias("total"))
    asked = own.select(key, F.explode(F.array_except(F.array(*map(F.lit, vocabulary)), F.col("ls"))).alias("b"))
    out = asked.join(sums, [key, "b"], "left").join(counts.select(F.col(label).alias("b"), F.col("n").alias("n_b")), "b", "left").crossJoin(F.broadcast(total))  # one row
    return out.select(key, F.col("b").alias("label"), (F.coalesce("p", F.lit(0.0)) + 0.05 * (F.coalesce("n_b", F.lit(0)) + 1) / F.col("total")).alias("weight"))


def outcomes(rows: DataFrame, decision: str = "decision") -> DataFrame:
    """Run statistics from a decision column."""
    return rows.groupBy(decision).agg(F.count(F.lit(1)).alias("n"))


def running_share(rows: DataFrame, order: list[Column], n: str) -> DataFrame:
    """Cumulative share of a small table of counts."""
    w = Window.orderBy(*order)
    return rows.withColumn("share", F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
