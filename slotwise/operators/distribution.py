"""Exact distribution functions of many columns: medians, KS, Wasserstein, few-value tests.

Values are counted per (feature, value), cut into ranges of about equally many distinct
values, and cumulated within the ranges; totals of the ranges are carried across. No
feature is sorted in one task and no value list is collected: ``median()`` and
``percentile()`` would keep all distinct values of a feature in one aggregation buffer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.operators import blocks as B

RANGES = 64
BRACKET = (0.47, 0.53)
KS_P_VALUE = 0.05
DISTANCE_LIMIT = 0.1
SMALL_REFERENCE = 1000
FEW_VALUES = 5
SCALE_FLOOR = 0.001
DATASET_SHARE = 0.5


def long_form(df: DataFrame, columns: Sequence[str], side: str | None = None) -> DataFrame:
    """(feature, value) rows of the given columns without nulls, and a side label."""
    cast = df.select(*[F.expr(f"try_cast(`{c}` AS double)").alias(c) for c in columns])
    out = cast.unpivot([], list(columns), "feature", "value")
    if side is not None:
        out = out.withColumn("side", F.lit(side))
    return out.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def cumulated(values: DataFrame, sides: Sequence[str] = ("all",)) -> DataFrame:
    """Per distinct value: counts, cumulated counts and totals per side, and the next value."""
    which = F.col("side") if "side" in values.columns else F.lit("all")
    counts = values.groupBy("feature", "value").agg(
        *[F.count_if(which == s).alias(f"n_{s}") for s in sides]
    )
    marks = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    cuts = counts.groupBy("feature").agg(F.percentile_approx("value", marks, 1000).alias("cuts"))
    # One row per monitored column.
    ranged = counts.join(F.broadcast(cuts), "feature").withColumn(
        B.BLOCK, F.size(F.filter("cuts", lambda c: c < F.col("value")))
    ).drop("cuts")
    keys = ["feature"]
    before, after = B.before_blocks(keys, B.BLOCK), B.after_blocks(keys, B.BLOCK)
    summary = {"_first": F.min("value"), **{f"_t_{s}": F.sum(f"n_{s}") for s in sides}}
    across: dict[str, Column] = {"_next": F.last("_first", ignorenulls=True).over(after)}
    for s in sides:
        across[f"_before_{s}"] = F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0))
        across[f"total_{s}"] = F.sum(f"_t_{s}").over(B.all_blocks(keys))
    across["n_values"] = F.sum("_d").over(B.all_blocks(keys))
    summary["_d"] = F.count(F.lit(1))
    rows = B.carry(ranged, keys, B.BLOCK, summary, across)
    order = Window.partitionBy("feature", B.BLOCK).orderBy("value")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    cum = {f"cum_{s}": F.col(f"_before_{s}") + F.sum(f"n_{s}").over(running) for s in sides}
    following = F.coalesce(F.lead("value").over(order), F.col("_next"))
    return rows.withColumns({**cum, "next_value": following}).drop(
        B.BLOCK, "_next", *[f"_before_{s}" for s in sides]
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, median): the mean of the two middle values.

    A sketch first brackets the middle far outside its own rank error; one pass counts
    the values below the bracket, and only the few inside are shuffled and ranked.
    """
    values = long_form(df, columns)
    # One row per column.
    around = values.groupBy("feature").agg(
        F.percentile_approx("value", F.array(*[F.lit(q) for q in BRACKET]), 1000).alias("q")
    ).select("feature", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    placed = values.join(F.broadcast(around), "feature")
    counts = placed.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < F.col("lo")).alias("below")
    )
    inside = cumulated(placed.filter(F.col("value").between(F.col("lo"), F.col("hi"))).select("feature", "value"))
    rows = inside.join(F.broadcast(counts), "feature")
    low, high = F.expr("(n - 1) div 2"), F.expr("n div 2")
    upto = F.col("below") + F.col("cum_all")
    prior = upto - F.col("n_all")
    lower = F.when((prior <= low) & (low < upto), F.col("value"))
    upper = F.when((prior <= high) & (high < upto), F.col("value"))
    return rows.groupBy("feature").agg(((F.max(lower) + F.max(upper)) / 2).alias("median"))


def _gap() -> Column:
    f = F.col("cum_ref") / F.col("total_ref")
    g = F.col("cum_cur") / F.col("total_cur")
    return F.abs(f - g)


def two_sided(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Cumulated rows of two long frames; features without values on a side drop out."""
    both = reference.withColumn("side", F.lit("ref")).unionByName(current.withColumn("side", F.lit("cur")))
    rows = cumulated(both, ("ref", "cur"))
    return rows.filter((F.col("total_ref") > 0) & (F.col("total_cur") > 0))


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value: the alternating series as one expression."""
    lam2 = d * d * (n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam2),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    # Near zero the series has not converged after 100 terms; the limit is 1.
    return F.when(lam2 < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def _erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 from its all-positive series."""
    terms = F.sequence(F.lit(1), F.lit(200))
    start = F.struct(x.alias("term"), x.alias("total"))
    series = F.aggregate(
        terms, start,
        lambda a, k: F.struct(
            (a["term"] * 2 * x * x / (2 * k + 1)).alias("term"),
            (a["total"] + a["term"] * 2 * x * x / (2 * k + 1)).alias("total"),
        ),
    )
    erf = F.lit(1.1283791670955126) * F.exp(-x * x) * series["total"]
    return F.when(x > 6, F.lit(0.0)).otherwise(F.greatest(F.lit(1.0) - erf, F.lit(0.0)))


def _chi2_tail(x: Column, df: Column) -> Column:
    """Upper tail of chi-square for 1 to 4 degrees of freedom."""
    half = F.sqrt(x / 2)
    odd = _erfc(half)
    tail = F.exp(-x / 2)
    return (
        F.when(df == 1, odd)
        .when(df == 2, tail)
        .when(df == 3, odd + F.sqrt(F.lit(0.6366197723675814) * x) * tail)
        .otherwise(tail * (1 + x / 2))
    )


def distances(rows: DataFrame) -> DataFrame:
    """Per feature: KS statistic and p-value, Wasserstein-1 and the statistics of few values."""
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    p = F.col("n_ref") / F.col("total_ref")
    q = F.col("n_cur") / F.col("total_cur")
    mid = (p + q) / 2
    kl = F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)
    expected = p * F.col("total_cur")
    chi = (F.col("n_cur") - expected) * (F.col("n_cur") - expected) / F.nullif(expected, F.lit(0.0))
    mean = F.col("value") * p
    stats = rows.groupBy("feature").agg(
        F.max("total_ref").alias("n_ref"), F.max("total_cur").alias("n_cur"),
        F.max("n_values").alias("n_values"),
        F.max(_gap()).alias("ks_d"),
        F.sum(_gap() * width).alias("wasserstein"),
        F.sqrt(F.greatest(F.sum(kl) / 2, F.lit(0.0))).alias("js"),
        F.sum(chi).alias("chi2"), F.max(F.when(p == 0, 1).otherwise(0)).alias("unseen"),
        F.sum(mean).alias("ref_mean"),
        F.max_by(p, "value").alias("p_top"), F.max_by(q, "value").alias("q_top"),
    )
    return stats.withColumn("ks_p", kolmogorov_p(F.col("ks_d"), F.col("n_ref"), F.col("n_cur")))


def reference_scale(reference: DataFrame) -> DataFrame:
    """Population deviation of the reference per feature (centred, hence stable)."""
    return reference.groupBy("feature").agg(F.stddev_pop("value").alias("ref_std"))


TESTS = ("ks", "chisquare", "z", "wasserstein", "jensenshannon")
BY_SIZE = "by size"


def drift_table(reference: DataFrame, current: DataFrame, tests: str | Mapping[str, str] = "wasserstein") -> DataFrame:
    """One row per usable feature: test, score, decision and severity.

    ``tests`` names the test of all features or of single ones (others: Wasserstein). ``ks``, ``chisquare`` and ``z`` give
    p-values, drift below 0.05; ``wasserstein`` (in reference deviations) and ``jensenshannon`` give distances, drift
    from 0.1 on. The decision on a feature so keeps its meaning however many rows it has. Only on request does
    ``BY_SIZE`` choose: up to 1000 reference rows KS above five distinct values, chi-square above two, else z; beyond that
    Wasserstein, Jensen-Shannon for few values.
    """
    named = {"*": tests} if isinstance(tests, str) else {**tests, "*": "wasserstein"}
    if unknown := {t for t in named.values() if t not in (*TESTS, BY_SIZE)}:
        raise ValueError(f"unknown test {sorted(unknown)}, expected one of {TESTS}")
    stats = distances(two_sided(reference, current)).join(F.broadcast(reference_scale(reference)), "feature")
    pooled = (F.col("p_top") * F.col("n_ref") + F.col("q_top") * F.col("n_cur")) / (F.col("n_ref") + F.col("n_cur"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n_ref") + 1 / F.col("n_cur")))
    z = F.coalesce(F.abs(F.col("p_top") - F.col("q_top")) / F.nullif(error, F.lit(0.0)), F.lit(0.0))
    chi_p = F.when(F.col("unseen") == 1, F.lit(0.0)).otherwise(_chi2_tail(F.col("chi2"), F.col("n_values") - 1))
    small, few = F.col("n_ref") <= SMALL_REFERENCE, F.col("n_values") <= FEW_VALUES
    chosen = (
        F.when(small & ~few, "ks").when(small & (F.col("n_values") > 2), "chisquare").when(small, "z")
        .when(few, "jensenshannon").otherwise("wasserstein")
    )
    one = lambda name: chosen if name == BY_SIZE else F.lit(name)
    test = one(named.pop("*"))
    for feature, name in named.items():
        test = F.when(F.col("feature") == feature, one(name)).otherwise(test)
    kind = F.col("stattest")
    score = (
        F.when(kind == "ks", F.col("ks_p")).when(kind == "chisquare", chi_p)
        .when(kind == "z", _erfc(z / F.sqrt(F.lit(2.0)))).when(kind == "jensenshannon", F.col("js"))
        .otherwise(F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(SCALE_FLOOR)))
    )
    rows = stats.withColumn("stattest", test).withColumn("drift_score", score)
    drifted = F.when(kind.isin("ks", "chisquare", "z"), F.col("drift_score") < KS_P_VALUE).otherwise(F.col("drift_score") >= DISTANCE_LIMIT)
    return rows.withColumn("drift_detected", drifted).select(
        "feature", "drift_detected", "drift_score", "stattest",
        F.when(F.col("drift_detected"), "CRITICAL").otherwise("OK").alias("severity"),
    )
