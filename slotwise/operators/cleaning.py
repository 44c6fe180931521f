"""De-duplication, winsorising, gap filling and interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.expressions import is_winsorised, nan_to_null, winsorise
from slotwise.functions.timegrid import floor_div, micros, slot_of
from slotwise.operators import blocks as B
from slotwise.operators.grid import align_in_blocks

HOURLY_BLOCK_US = 4096 * 3_600_000_000


def dedupe_first(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """Keep the first row per key in input order.

    An aggregation with map-side combine: copies of one hot key meet before the shuffle.
    ``min_by`` keeps a null value of the first row, unlike ``first(ignorenulls)``.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    picked = df.groupBy(*keys).agg(
        F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in rest]
    )
    return picked.select(*df.columns)


def ffill_column(value: str, partition: Sequence[str], order: str, limit: int) -> Column:
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-limit, 0)
    return F.last(value, ignorenulls=True).over(w)


def forward_fill(
    df: DataFrame, cfg: SeriesConfig = DEFAULT, limit: int = C.SHORT_GAP_LIMIT
) -> DataFrame:
    """Fill at most ``limit`` slots after a reading; also the start of a longer gap."""
    blocked = B.open_blocks(df, slot_of(F.col(cfg.time), cfg.step_us), cfg.block_slots, limit)
    filled = ffill_column(cfg.value, (cfg.entity, B.BLOCK), cfg.time, limit)
    return B.close_blocks(blocked.withColumn(cfg.value, filled))


def fill_provenance_in_blocks(df: DataFrame, flag: str, cfg: SeriesConfig, placed: bool) -> DataFrame:
    keys = [cfg.entity]
    known = F.col(flag).isNotNull() & F.col(B.OWN)
    ordered = Window.partitionBy(cfg.entity).orderBy(B.BLOCK)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = B.carry(
        df, keys, B.BLOCK,
        {
            "_last": F.max_by(flag, F.when(known, F.col(cfg.time))),
            "_first": F.min_by(flag, F.when(known, F.col(cfg.time))),
        },
        {
            "_earlier": F.last("_last", ignorenulls=True).over(B.before_blocks(keys, B.BLOCK)),
            "_opening": F.first("_first", ignorenulls=True).over(whole),
        },
        placed=placed,
    )
    running = Window.partitionBy(cfg.entity, B.BLOCK).orderBy(cfg.time)
    so_far = F.last(flag, ignorenulls=True).over(running.rowsBetween(Window.unboundedPreceding, 0))
    # The backward fill only reaches rows before the first known flag of the entity.
    value = F.coalesce(so_far, F.col("_earlier"), F.col("_opening"), F.lit(False))
    return df.withColumn(flag, value).drop("_earlier", "_opening")


def fill_provenance(df: DataFrame, flag: str = "is_real_data", cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Last known flag, else the first one known later, else false, within an entity."""
    slot = slot_of(F.col(cfg.time), cfg.step_us)
    blocked = B.open_blocks(df, slot, cfg.block_slots, 0)
    return B.close_blocks(fill_provenance_in_blocks(blocked, flag, cfg, placed=False))


def clean_meter(
    df: DataFrame,
    cfg: SeriesConfig = DEFAULT,
    order: str = "seq",
    observation: Observation | None = None,
    open_for: int | None = None,
) -> DataFrame:
    """Raw readings to a complete grid: first of copies, clipped, short gaps filled.

    With ``open_for`` the rows stay in open blocks, each with so many slots before it, for windows that look back as far; the flags of these
    copies are not to be used.

    With an ``observation`` the side counts arrive without an extra job once an action
    has run over the result.
    """
    raw = df.withColumn(cfg.value, nan_to_null(F.col(cfg.value)))
    if observation is not None:
        raw = raw.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(F.col(cfg.value) > C.PLAUSIBLE_CAP).alias("spikes_before_dedupe"),
        )
    out = align_in_blocks(raw, cfg, order, C.SHORT_GAP_LIMIT + (open_for or 0)).withColumns(
        {
            "is_winsorised": is_winsorised(F.col(cfg.value)),
            "was_missing": F.col(cfg.value).isNull(),
            cfg.value: winsorise(F.col(cfg.value)),
        }
    )
    if "is_real_data" in out.columns:
        out = fill_provenance_in_blocks(out, "is_real_data", cfg, placed=True)
    filled = ffill_column(cfg.value, (cfg.entity, B.BLOCK), cfg.time, C.SHORT_GAP_LIMIT)
    out = out.withColumn(cfg.value, filled)
    if open_for is None:
        return B.close_blocks(out)
    return out.filter(slot_of(F.col(cfg.time), cfg.step_us) >= F.col(B.BLOCK) * F.lit(cfg.block_slots) - F.lit(open_for))


def interpolate_time(
    df: DataFrame,
    values: Sequence[str],
    time: str = "timestamp",
    keys: Sequence[str] = (),
    limit: int = C.WEATHER_GAP_LIMIT,
    block_us: int = HOURLY_BLOCK_US,
) -> DataFrame:
    """Linear in elapsed time for the first ``limit`` nulls of a run.

    Trailing nulls hold the last value (also up to ``limit`` rows), leading ones stay
    null. Rows may be irregular, so the distance in rows is counted: within the block by
    ``row_number``, across blocks by carried row counts. The next known value may be any
    distance away and is carried too.
    """
    keys = list(keys)
    part = [*keys, B.BLOCK]
    df = df.withColumn("_us", micros(F.col(time))).withColumn(B.BLOCK, floor_div(F.col("_us"), block_us))
    forward = Window.partitionBy(*part).orderBy("_us")
    df = df.withColumn("_row", F.row_number().over(forward).cast("bigint"))
    before, after = B.before_blocks(keys, B.BLOCK), B.after_blocks(keys, B.BLOCK)
    running = forward.rowsBetween(Window.unboundedPreceding, 0)
    reversed_order = Window.partitionBy(*part).orderBy(F.col("_us").desc())
    onward = reversed_order.rowsBetween(Window.unboundedPreceding, 0)

    summary: dict[str, Column] = {"_n": F.count(F.lit(1))}
    offset = {"_offset": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    carried: dict[str, Column] = {}
    for v in values:
        point = F.struct(F.col("_us").alias("us"), F.col(v).alias("v"), F.col("_row").alias("row"))
        at = F.when(F.col(v).isNotNull(), F.col("_us"))
        summary[f"_{v}_first"] = F.min_by(point, at)
        summary[f"_{v}_last"] = F.max_by(point, at)
        last = F.col(f"_{v}_last")
        numbered = _point(last["us"], last["v"], last["row"] + F.col("_offset"))
        carried[f"_{v}_prev"] = F.last(F.when(last.isNotNull(), numbered), ignorenulls=True).over(before)
        carried[f"_{v}_next"] = F.last(f"_{v}_first", ignorenulls=True).over(after)
    df = B.carry(df, keys, B.BLOCK, summary, offset, carried, placed=True)

    index = F.col("_row") + F.col("_offset")
    known = {v: F.when(F.col(v).isNotNull(), _point(F.col("_us"), F.col(v), index)) for v in values}
    df = df.withColumns(
        {
            f"_{v}_p": F.coalesce(F.last(known[v], ignorenulls=True).over(running), F.col(f"_{v}_prev"))
            for v in values
        }
    ).withColumns(
        {
            f"_{v}_q": F.coalesce(F.last(known[v], ignorenulls=True).over(onward), F.col(f"_{v}_next"))
            for v in values
        }
    )
    filled = {v: _interpolated(v, index, limit) for v in values}
    keep = [c for c in df.columns if not c.startswith("_")]
    return df.withColumns(filled).select(*keep)


def _point(us: Column, v: Column, row: Column) -> Column:
    return F.struct(us.alias("us"), v.alias("v"), row.alias("row"))


def _interpolated(v: str, index: Column, limit: int) -> Column:
    p, q = F.col(f"_{v}_p"), F.col(f"_{v}_q")
    share = (F.col("_us") - p["us"]) / (q["us"] - p["us"])
    return (
        F.when(F.col(v).isNotNull(), F.col(v))
        .when(p.isNull() | (index - p["row"] > limit), F.lit(None).cast("double"))
        .when(q.isNull(), p["v"])
        .otherwise(p["v"] + (q["v"] - p["v"]) * share)
    )


def clean_weather(
    df: DataFrame, values: Sequence[str] = ("temperature_c", "humidity_pct", "wind_speed_ms"),
    order: str = "seq", keys: Sequence[str] = (),
) -> DataFrame:
    """First row per instant (and station), then time interpolation of short gaps."""
    first = dedupe_first(df, [*keys, "timestamp"], order)
    return interpolate_time(first, values, keys=keys)


def clean_calendar(df: DataFrame, order: str = "seq") -> DataFrame:
    """First row per day."""
    return dedupe_first(df.withColumn("date", F.to_date("date")), ["date"], order)


def cleaning_counters(raw: DataFrame, cleaned: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Rows in, duplicates dropped, spikes clipped, filled and remaining nulls, in one row."""
    keys = raw.groupBy(cfg.entity, cfg.time).agg(
        F.count(F.lit(1)).alias("copies"), F.min_by(cfg.value, "seq").alias("v")
    )
    before = keys.agg(
        F.sum("copies").alias("rows_in"),
        (F.sum("copies") - F.count(F.lit(1))).alias("duplicates_dropped"),
        F.count_if(F.col("v") > C.PLAUSIBLE_CAP).alias("spikes"),
    )
    after = cleaned.agg(
        F.count_if(F.col("was_missing") & F.col(cfg.value).isNotNull()).alias("filled"),
        F.count_if(F.col(cfg.value).isNull()).alias("remaining_nulls"),
    )
    return before.select(
        "*", after.select("filled").scalar().alias("filled"),
        after.select("remaining_nulls").scalar().alias("remaining_nulls"),
    )
