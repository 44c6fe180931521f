"""Lag, rolling, calendar and degree features, and the whole feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.expressions import calendar_columns, cooling_degree, flag_as_int, heating_degree
from slotwise.functions.timegrid import slot_of
from slotwise.operators import blocks as B
from slotwise.operators.cleaning import ffill_column
from slotwise.operators.grid import resample_mean_last
from slotwise.session import is_broadcastable


def add_calendar_features(df: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    columns: dict[str, Column] = calendar_columns(F.col(cfg.time))
    for flag in ("is_weekend", "is_holiday"):
        if flag in df.columns:
            columns[flag] = flag_as_int(F.col(flag))
    return df.withColumns(columns)


def add_degree_features(df: DataFrame) -> DataFrame:
    if "temperature_c" not in df.columns:
        return df
    t = F.col("temperature_c")
    return df.withColumns({"heating_degree": heating_degree(t), "cooling_degree": cooling_degree(t)})


def with_lags(df: DataFrame, partition: Sequence[str], cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Value k rows earlier; the rows must be on a grid for k to be a time distance."""
    w = Window.partitionBy(*partition).orderBy(cfg.time)
    return df.withColumns({f"lag_{k}": F.lag(cfg.value, k).over(w) for k in cfg.lag_steps})


def _moments(value: str, frame) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared deviations of a growing frame, which Spark updates stably."""
    n = F.count(value).over(frame)
    return n, F.coalesce(F.avg(value).over(frame), F.lit(0.0)), F.coalesce(F.var_pop(value).over(frame), F.lit(0.0)) * n


def with_rolling(df: DataFrame, partition: Sequence[str], cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Mean and sample deviation of the w rows before the current one.

    A sliding frame costs w updates per row. Here rows are cut into chunks of w: a frame is the end of one
    chunk and the beginning of the next. Moments grow forwards and backwards within chunks, one update per
    row each, and the two parts of a frame are combined by the pairwise formula. Nothing is subtracted, so
    a large value leaves no trace in frames that no longer hold it.
    """
    names = list(df.columns)
    order = Window.partitionBy(*partition).orderBy(cfg.time)
    df = df.withColumn("_r", F.row_number().over(order) - 1)
    windows = sorted(set(cfg.rolling_windows), reverse=True)
    df = df.withColumns({f"_c{w}": F.floor(F.col("_r") / w) for w in windows} | {f"_d{w}": -F.floor(F.col("_r") / w) for w in windows})
    # Where each window divides the next longer one, chunks lie within chunks and all of them share an order.
    nested = all(long % short == 0 for long, short in zip(windows, windows[1:], strict=False))
    for side, chunk, by in (("s", "_d", F.col(cfg.time).desc()), ("p", "_c", F.col(cfg.time))):
        for i, w in enumerate(windows):
            outer, inner = (windows[: i + 1], windows[i + 1:]) if nested else ([w], [])
            grown = Window.partitionBy(*partition, *[f"{chunk}{x}" for x in outer]).orderBy(*[f"{chunk}{x}" for x in inner], by)
            grown = grown.rowsBetween(Window.unboundedPreceding, 0)
            df = df.withColumns({f"_{part}{side}{w}": c for part, c in zip("nmq", _moments(cfg.value, grown), strict=True)})
    if nested:
        order = Window.partitionBy(*partition).orderBy(*[f"_c{x}" for x in windows], cfg.time)
    parts: dict[str, Column] = {}
    for w in cfg.rolling_windows:
        # A frame that is one whole chunk has no second part.
        split = (F.col("_r") >= w) & (F.col("_r") % w != 0)
        for part in "nmq":
            parts[f"_{part}1_{w}"] = F.coalesce(F.lag(f"_{part}p{w}", 1).over(order), F.lit(0))
            parts[f"_{part}2_{w}"] = F.when(split, F.coalesce(F.lag(f"_{part}s{w}", w).over(order), F.lit(0))).otherwise(F.lit(0))
    df = df.withColumns(parts)
    out: dict[str, Column] = {}
    for w in cfg.rolling_windows:
        n1, m1, q1, n2, m2, q2 = (F.col(f"_{part}{side}_{w}") for side in "12" for part in "nmq")
        n, apart = n1 + n2, m2 - m1
        enough = max(1, w // 4)
        mean = F.when(n1 == 0, m2).otherwise(m1 + apart * n2 / n)
        squares = q1 + q2 + F.when((n1 > 0) & (n2 > 0), apart * apart * n1 * n2 / n).otherwise(0.0)
        out[f"roll_mean_{w}"] = F.when(n >= enough, mean)
        out[f"roll_std_{w}"] = F.when(n >= max(enough, 2), F.sqrt(squares / (n - 1)))
    return df.withColumns(out).select(*names, *out)


def _in_blocks(df: DataFrame, cfg: SeriesConfig, look_back: int) -> DataFrame:
    return B.open_blocks(df, slot_of(F.col(cfg.time), cfg.step_us), cfg.block_slots, look_back)


def add_lag_features(df: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    blocked = _in_blocks(df, cfg, max(cfg.lag_steps, default=0))
    return B.close_blocks(with_lags(B.dealt(blocked, cfg.entity, B.BLOCK), (cfg.entity, B.BLOCK), cfg))


def add_rolling_features(df: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    blocked = _in_blocks(df, cfg, max(cfg.rolling_windows, default=0) + 1)
    return B.close_blocks(with_rolling(B.dealt(blocked, cfg.entity, B.BLOCK), (cfg.entity, B.BLOCK), cfg))


def history_features(df: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Lags and rolling statistics with one exchange for all of them, and three sorts: in time, back in time, and by chunks."""
    blocked = _in_blocks(df, cfg, cfg.look_back + 1)
    part = (cfg.entity, B.BLOCK)
    return B.close_blocks(with_rolling(with_lags(B.dealt(blocked, *part), part, cfg), part, cfg))


def build_feature_table(merged: DataFrame, cfg: SeriesConfig = DEFAULT, on_grid: bool = False, dealt: bool = False) -> DataFrame:
    """Merged rows to features, resampled to the grid first; ``on_grid`` says that they are on it already.

    Without that step lags of rows that miss a slot would be lags of rows, not of time. Rows in open blocks that reach back ``cfg.look_back + 1``
    slots keep them; ``dealt`` says that they lie by block in tasks already.
    """
    if B.BLOCK in merged.columns:
        part = (cfg.entity, B.BLOCK)
        placed = merged if dealt else B.dealt(merged, *part)
        names = [*add_degree_features(add_calendar_features(merged.drop(B.BLOCK, B.OWN), cfg)).columns]
        history = B.close_blocks(with_rolling(with_lags(placed, part, cfg), part, cfg))
        # What a row tells by itself is added last, so that the sorts of the windows don't carry it.
        whole = add_degree_features(add_calendar_features(history, cfg))
        return whole.select(*names, *[c for c in whole.columns if c not in names])
    if not on_grid:
        numeric = [
            f.name for f in merged.schema.fields
            if f.name not in (cfg.entity, cfg.time) and f.dataType.typeName() in ("double", "integer", "long", "float")
        ]
        others = [c for c in merged.columns if c not in (cfg.entity, cfg.time, *numeric)]
        merged = resample_mean_last(merged, cfg, means=numeric, lasts=others, order=())
    return history_features(add_degree_features(add_calendar_features(merged, cfg)), cfg)


def features_from_readings(
    readings: DataFrame, weather: DataFrame, calendar: DataFrame, cfg: SeriesConfig, fill_limit: int = C.SHORT_GAP_LIMIT
) -> DataFrame:
    """De-duplicated readings of any cadence to features in one pass over blocks.

    The copied look-back rows go through fill, merge and features together, so the
    resampled rows are exchanged once for all windows.
    """
    from slotwise.operators.joins import merge_sources

    grid = resample_mean_last(readings, cfg, order=())
    part = (cfg.entity, B.BLOCK)
    blocked = _in_blocks(grid, cfg, cfg.look_back + 1 + fill_limit)
    blocked = B.dealt(blocked, *part).withColumn(cfg.value, ffill_column(cfg.value, part, cfg.time, fill_limit))
    merged = merge_sources(blocked, weather, calendar, cfg)
    featured = add_degree_features(add_calendar_features(merged, cfg))
    if not is_broadcastable(weather):
        featured = B.dealt(featured, *part)  # the join has shuffled them by time
    return B.close_blocks(with_rolling(with_lags(featured, part, cfg), part, cfg))


def feature_columns(columns: Sequence[str]) -> list[str]:
    """All columns but keys, target, quality flags and provenance, in table order."""
    return [c for c in columns if c not in C.NOT_FEATURES]
