"""As-of join, lookup joins and the merge of meter, weather and calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.timegrid import floor_div, micros
from slotwise.session import is_broadcastable

SALTS = 32


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Left join to one row per key.

    Inside the broadcast limit Spark broadcasts ``right`` by itself. Beyond it both sides
    shuffle, and the rows of one left key are spread over ``salts`` tasks by a hash of
    the ``spread`` columns, each of which gets a copy of the matching right row.
    """
    on = list(on)
    if is_broadcastable(right):
        return left.join(right, on, "left")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    spread: Sequence[str],
    time: str = "timestamp",
    order: str | None = "seq",
    by: Sequence[str] = (),
    tolerance_minutes: int = C.ASOF_TOLERANCE_MINUTES,
    matched: str | None = None,
    salts: int = SALTS,
    plan: str = "auto",
) -> DataFrame:
    """Latest right row at or before each left row, no older than the tolerance.

    The tolerance is inclusive, null values of the matched row are kept, and of several
    right rows with one time the last by ``order`` counts. ``matched`` names an optional
    column with the time of the matched row.

    Time is cut into buckets as wide as the tolerance; a right row enters its own bucket
    and the next one, so each bucket holds all candidates of its left rows.

    * ``lookup``: right rows become intervals that do not overlap, joined on the bucket
      plus a range condition. Used while the right side may be broadcast; the left side
      is not shuffled.
    * ``merge``: both sides are shuffled by bucket and salt and walked once in time
      order. No pairs are formed, and a bucket that all entities share is split by salt.
    """
    if plan == "auto":
        plan = "lookup" if is_broadcastable(right) else "merge"
    tolerance = tolerance_minutes * 60_000_000
    wanted = F.struct(micros(F.col(time)).alias("us"), *[F.col(v) for v in values], F.col(time).alias("t"))
    rank = F.col(order) if order else F.lit(0)
    # A null key equals nothing: without this one plan would match two of them.
    known = F.col(time).isNotNull()
    for c in by:
        known &= F.col(c).isNotNull()
    candidates = right.filter(known).select(
        *by, wanted.alias("_hit"), rank.alias("_rank")
    )
    home = floor_div(F.col("_hit.us"), tolerance)
    candidates = candidates.withColumn("_bucket", F.explode(F.array(home, home + F.lit(1))))
    us = micros(F.col(time))
    left = left.withColumn("_us", us).withColumn("_bucket", floor_div(us, tolerance))
    join = _lookup_plan if plan == "lookup" else _merge_plan
    out = join(left, candidates, list(by), tolerance, list(spread), salts)
    hit = F.col("_hit")
    found = {v: hit[v] for v in values}
    if matched:
        found[matched] = hit["t"]
    return out.withColumns(found).drop("_hit", "_us", "_bucket")


def _lookup_plan(left, candidates, by, tolerance, spread, salts) -> DataFrame:
    in_order = Window.partitionBy(*by, "_bucket").orderBy("_hit.us", "_rank")
    intervals = candidates.withColumn("_until", F.lead("_hit.us").over(in_order)).drop("_rank")
    r = intervals.select(
        *[F.col(c).alias(f"_r_{c}") for c in by],
        F.col("_bucket").alias("_r_bucket"), "_until", "_hit",
    )
    same = F.col("_bucket") == F.col("_r_bucket")
    for c in by:
        same &= F.col(c) == F.col(f"_r_{c}")
    start = F.col("_hit.us")
    inside = (
        (start <= F.col("_us"))
        & (F.col("_until").isNull() | (F.col("_us") < F.col("_until")))
        & (F.col("_us") - start <= tolerance)
    )
    return left.join(r, same & inside, "left").drop("_r_bucket", "_until", *[f"_r_{c}" for c in by])


def _merge_plan(left, candidates, by, tolerance, spread, salts) -> DataFrame:
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    ranked = candidates.schema["_rank"].dataType
    rows = left.withColumns({"_salt": salt, "_side": F.lit(1), "_rank": F.lit(None).cast(ranked)})
    copies = candidates.select(
        *by, "_bucket", F.col("_hit.us").alias("_us"), "_rank",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), F.lit(0).alias("_side"), "_hit",
    )
    # Right rows sort before left rows of the same instant, so an exact match counts.
    walk = (
        Window.partitionBy(*by, "_bucket", "_salt").orderBy("_us", "_side", "_rank")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    both = rows.unionByName(copies, allowMissingColumns=True)
    latest = F.last("_hit", ignorenulls=True).over(walk)
    seen = both.withColumn("_hit", latest).filter(F.col("_side") == 1)
    recent = F.when(F.col("_us") - F.col("_hit.us") <= tolerance, F.col("_hit"))
    return seen.withColumn("_hit", recent).drop("_salt", "_side", "_rank")


def join_calendar(df: DataFrame, calendar: DataFrame, time: str = "timestamp") -> DataFrame:
    """Left join to the day. One row per day: a century stays far below the limit."""
    days = calendar.select(F.col("date").alias("_date"), "is_weekend", "is_holiday")
    return df.join(F.broadcast(days), F.to_date(time) == F.col("_date"), "left").drop("_date")


def merge_sources(
    meter: DataFrame,
    weather: DataFrame,
    calendar: DataFrame,
    cfg: SeriesConfig = DEFAULT,
    weather_values: Sequence[str] = ("temperature_c", "humidity_pct", "wind_speed_ms"),
    by: Sequence[str] = (),
    plan: str = "auto",
) -> DataFrame:
    """One row per meter row with the weather as of then and the flags of its day.

    Only the provenance flag of the meter survives, under its own name.
    """
    meter = meter.withColumnRenamed("is_real_data", "is_real_meter_data")
    order = "seq" if "seq" in weather.columns else None
    merged = asof_join(
        meter, weather.drop("is_real_data"), weather_values, spread=[cfg.entity], time=cfg.time,
        order=order, by=by, plan=plan,
    )
    return join_calendar(merged, calendar.drop("is_real_data"), cfg.time)


def observed_merge(merged: DataFrame, column: str = "temperature_c") -> tuple[DataFrame, Observation]:
    """The same rows, and what the job that computes them counts along the way: ``n_rows`` and ``n_unmatched_weather``."""
    counters = Observation()
    return merged.observe(counters, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(column).isNull()).alias("n_unmatched_weather")), counters


def last_n(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str], salts: int = SALTS) -> DataFrame:
    """The last ``n`` rows per key.

    First per (key, salt), then per key: the second step sees at most ``salts * n`` rows
    of a key however many it has. Spark also limits groups before each shuffle.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    inner = Window.partitionBy(*key, "_salt").orderBy(*order)
    outer = Window.partitionBy(*key).orderBy(*order)
    few = df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(inner)).filter(F.col("_rn") <= n)
    return few.withColumn("_rn", F.row_number().over(outer)).filter(F.col("_rn") <= n).drop("_salt", "_rn")
