"""Row-level column expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise import config as C


def winsorise(value: Column, cap: float = C.PLAUSIBLE_CAP) -> Column:
    """Clip from above; null stays null (``least`` would turn it into the cap)."""
    return F.when(value > cap, F.lit(cap)).otherwise(value)


def is_winsorised(value: Column, cap: float = C.PLAUSIBLE_CAP) -> Column:
    """True at or above the cap, so a reading of exactly the cap counts; null is false."""
    return F.coalesce(value >= cap, F.lit(False))


def heating_degree(t: Column) -> Column:
    return F.when(t.isNotNull(), F.greatest(F.lit(C.HEATING_BASE_C) - t, F.lit(0.0)))


def cooling_degree(t: Column) -> Column:
    return F.when(t.isNotNull(), F.greatest(t - F.lit(C.COOLING_BASE_C), F.lit(0.0)))


def flag_as_int(flag: Column) -> Column:
    return F.coalesce(flag.cast("boolean"), F.lit(False)).cast("bigint")


def calendar_columns(ts: Column) -> dict[str, Column]:
    hour, minute = F.hour(ts).cast("bigint"), F.minute(ts).cast("bigint")
    weekday = F.weekday(ts).cast("bigint")
    day_angle = F.lit(2 * math.pi) * (hour + minute / 60) / 24
    week_angle = F.lit(2 * math.pi) * weekday / 7
    return {
        "hour": hour,
        "minute": minute,
        "day_of_week": weekday,
        "hour_sin": F.sin(day_angle),
        "hour_cos": F.cos(day_angle),
        "dow_sin": F.sin(week_angle),
        "dow_cos": F.cos(week_angle),
    }


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def error_metrics(y: Column, y_hat: Column) -> list[Column]:
    """MAE, RMSE, MAPE (in percent, floored denominator) and the sample count."""
    err = y - y_hat
    return [
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(C.MAPE_FLOOR))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n_samples"),
    ]


def relative_improvement(base: Column, model: Column) -> Column:
    """Improvement over ``base`` in percent, positive is better, 0 for a zero base."""
    return F.when(base == 0, F.lit(0.0)).otherwise((base - model) / F.nullif(base, F.lit(0.0)) * 100)


def stable_order(key: Column, seed: int) -> Column:
    """Pseudo-random order that is the same on every engine, run and partitioning."""
    return F.md5(F.concat(key, F.lit(f"#{seed}")))
