"""Expectation suites over raw tables: all row checks of a suite in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.timegrid import floor_div, micros


@dataclass(frozen=True)
class Exists:
    column: str
    severity: str = "CRITICAL"


@dataclass(frozen=True)
class NotNull:
    column: str
    mostly: float = 1.0
    severity: str = "WARN"


@dataclass(frozen=True)
class Between:
    column: str
    low: float
    high: float
    mostly: float = 1.0
    severity: str = "CRITICAL"


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    mostly: float = 1.0
    severity: str = "CRITICAL"


@dataclass(frozen=True)
class Regular:
    entity: str
    time: str = "timestamp"
    freq_minutes: int = 30
    severity: str = "WARN"


# The suites.
SUITES = {
    "smart_meter": (
        Exists("timestamp"), Exists("household_id"), Exists("consumption_kwh"),
        NotNull("consumption_kwh", mostly=0.99),
        Between("consumption_kwh", 0, 25, mostly=0.9999),
        Unique(("timestamp", "household_id"), mostly=0.999),
        Regular("household_id"),
    ),
    "weather": (
        Exists("timestamp"),
        Between("temperature_c", -25, 45), Between("humidity_pct", 0, 100), Between("wind_speed_ms", 0, 60),
        NotNull("temperature_c"),
    ),
    "calendar": (
        Exists("date"), Exists("is_weekend"), Exists("is_holiday"),
        Unique(("date",)),
    ),
}


def gap_counts(df: DataFrame, entity: str, time: str = "timestamp", freq_minutes: int = 30) -> DataFrame:
    """Per entity, the number of consecutive readings more than one step apart.

    Two readings of the same slot are never more than a step apart, so only the first and
    last of each slot matter: that aggregation shrinks dense series before the shuffle and
    bounds an entity by its span. The window then runs per block of slots.
    """
    step = freq_minutes * 60_000_000
    us = micros(F.col(time))
    slots = df.filter(us.isNotNull()).groupBy(F.col(entity).alias("_e"), floor_div(us, step).alias("_slot")).agg(
        F.min(us).alias("_lo"), F.max(us).alias("_hi")
    ).withColumn("_block", floor_div(F.col("_slot"), 4096))
    in_block = Window.partitionBy("_e", "_block").orderBy("_slot")
    jumps = slots.withColumn("_prev", F.lag("_hi").over(in_block))
    blocks = jumps.groupBy("_e", "_block").agg(
        F.count_if(F.col("_lo") - F.col("_prev") > step).alias("n"),
        F.min("_lo").alias("lo"), F.max("_hi").alias("hi"),
    )
    between = Window.partitionBy("_e").orderBy("_block")
    edges = blocks.withColumn("edge", (F.col("lo") - F.lag("hi").over(between) > step).cast("bigint"))
    return edges.groupBy(F.col("_e").alias(entity)).agg(
        (F.sum("n") + F.coalesce(F.sum("edge"), F.lit(0))).alias("n_gaps")
    )


def _duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Members of repeated keys; rows whose key is entirely null are left out."""
    some = None
    for c in columns:
        some = F.col(c).isNotNull() if some is None else some | F.col(c).isNotNull()
    sizes = df.filter(some).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _passes(bad: Column, n: Column, mostly: float) -> Column:
    return F.when(n == 0, F.lit(True)).otherwise((n - bad) / F.nullif(n, F.lit(0)) >= mostly)


def _row(expectation: str, column: str, severity: str, success: Column, observed: Column, details: str = "") -> Column:
    return F.struct(
        F.lit(expectation).alias("expectation"), F.lit(column).alias("column"), F.lit(severity).alias("severity"),
        success.alias("success"), observed.cast("string").alias("observed"), F.lit(details).alias("details"),
    )


def run_suite(df: DataFrame, suite: str, checks: Sequence | None = None) -> DataFrame:
    """One row per expectation. A check on a missing column fails without a pass."""
    checks = SUITES[suite] if checks is None else checks
    counters: dict[str, Column] = {"_rows": F.count(F.lit(1))}
    for i, c in enumerate(checks):
        if isinstance(c, (NotNull, Between)) and c.column in df.columns:
            counters[f"_n{i}"] = F.count(c.column)
            if isinstance(c, Between):
                counters[f"_bad{i}"] = F.count_if(~F.col(c.column).between(c.low, c.high))
    totals = df.agg(*[v.alias(k) for k, v in counters.items()])
    missing = F.lit("column missing")
    rows: list[Column] = []
    for i, c in enumerate(checks):
        match c:
            case Exists():
                there = F.lit(c.column in df.columns)
                rows.append(_row("expect_column_to_exist", c.column, c.severity, there, F.initcap(there.cast("string"))))
            case NotNull():
                name = "expect_column_values_to_not_be_null"
                if c.column not in df.columns:
                    rows.append(_row(name, c.column, c.severity, F.lit(False), missing))
                    continue
                bad = F.col("_rows") - F.col(f"_n{i}")
                rows.append(_row(name, c.column, c.severity, _passes(bad, F.col("_rows"), c.mostly), bad))
            case Between():
                name = "expect_column_values_to_be_between"
                if c.column not in df.columns:
                    rows.append(_row(name, c.column, c.severity, F.lit(False), missing))
                    continue
                bad = F.col(f"_bad{i}")
                rows.append(_row(name, c.column, c.severity, _passes(bad, F.col(f"_n{i}"), c.mostly), bad))
            case Unique():
                name = "expect_column_values_to_be_unique" if len(c.columns) == 1 else "expect_compound_columns_to_be_unique"
                joined = ",".join(c.columns)
                if not set(c.columns) <= set(df.columns):
                    rows.append(_row(name, joined, c.severity, F.lit(False), missing))
                    continue
                found = _duplicates(df, c.columns)
                bad, n = found.select("bad").scalar(), found.select("n").scalar()
                rows.append(_row(name, joined, c.severity, _passes(bad, n, c.mostly), bad))
            case Regular():
                gaps = gap_counts(df, c.entity, c.time, c.freq_minutes)
                n_gaps = F.coalesce(gaps.agg(F.sum("n_gaps")).scalar(), F.lit(0))
                rows.append(_row(
                    "expect_timestamps_regular", c.time, c.severity, n_gaps == 0,
                    F.concat(F.lit("n_gaps="), n_gaps.cast("string")), f"expected_freq={c.freq_minutes}min",
                ))
    return totals.select(F.lit(suite).alias("suite"), F.inline(F.array(*rows)))


def summary(results: DataFrame) -> DataFrame:
    failed = ~F.col("success")
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("n_expectations"),
        F.count_if(failed & (F.col("severity") == "CRITICAL")).alias("n_critical_failures"),
        F.count_if(failed & (F.col("severity") == "WARN")).alias("n_warn_failures"),
    )


def has_critical_failure(results: DataFrame) -> Column:
    """Scalar condition for gates: some critical expectation failed."""
    bad = results.agg(F.bool_or(~F.col("success") & (F.col("severity") == "CRITICAL")))
    return F.coalesce(bad.scalar(), F.lit(False))
