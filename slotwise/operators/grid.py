"""Regular grids: time index, resampling and alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.timegrid import floor_div, from_micros, micros, slot_of, slot_start
from slotwise.operators import blocks as B

SLOT = "_slot"
_PART = "_slots_of"
#: Slots of an entity that one row stands for while the slots to come are dealt to tasks.
PART_SLOTS = 1024


def time_index(bounds: DataFrame, lo: str, hi: str, step_us: int, out: str = "timestamp") -> DataFrame:
    """All grid times in [lo, hi) for every row of ``bounds``."""
    start, end = micros(F.col(lo)), micros(F.col(hi))
    steps = F.when(end > start, F.sequence(start, end - F.lit(1), F.lit(step_us)))
    return bounds.select(F.explode(steps).alias("_us")).select(from_micros(F.col("_us")).alias(out))


def _every(spans: DataFrame, keys: Sequence[str], first: Column, last: Column) -> DataFrame:
    """Rows with ``keys`` and every slot number from ``first`` to ``last``.

    The spans are few bytes, so the runtime would merge them into a task or two that then make all slots. Parts of
    spans are dealt by a number of partitions of their own, which it leaves as it is.
    """
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = spans.select(*keys, first.alias("_first"), last.alias("_last"))
    parts = each.select("*", F.explode(F.sequence("_first", "_last", F.lit(PART_SLOTS).cast("bigint"))).alias(_PART)).repartition(tasks, *keys, _PART)
    end = F.least(F.col("_last"), F.col(_PART) + F.lit(PART_SLOTS - 1))
    return parts.select(*keys, F.explode(F.sequence(_PART, end)).alias(SLOT))


def _empty_slots(df: DataFrame, cfg: SeriesConfig) -> DataFrame:
    """Every slot between the first and the last reading of each entity."""
    span = df.groupBy(cfg.entity).agg(F.min(cfg.time).alias("lo"), F.max(cfg.time).alias("hi"))
    return _every(span, [cfg.entity], slot_of(F.col("lo"), cfg.step_us), slot_of(F.col("hi"), cfg.step_us))


def _by_slot(df: DataFrame, cfg: SeriesConfig, measures: list[Column]) -> DataFrame:
    """Aggregate per (entity, slot), empty slots included.

    The empty slots join the readings as rows without values *before* the aggregation, so
    one shuffle of partially aggregated rows both groups and densifies. The span of an
    entity comes from a scan of two columns.
    """
    rows = df.filter(F.col(cfg.time).isNotNull()).withColumn(SLOT, slot_of(F.col(cfg.time), cfg.step_us))
    filled = rows.unionByName(_empty_slots(df, cfg), allowMissingColumns=True)
    out = filled.groupBy(cfg.entity, SLOT).agg(*measures)
    return out.select(
        cfg.entity,
        slot_start(F.col(SLOT), cfg.step_us).alias(cfg.time),
        *[c for c in out.columns if c not in (cfg.entity, SLOT)],
    )


def resample_sum(df: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Energy per slot; an empty slot sums to 0, not to null."""
    total = F.coalesce(F.sum(cfg.value), F.lit(0.0)).alias(cfg.value)
    return _by_slot(df, cfg, [total])


def resample_mean_last(
    df: DataFrame,
    cfg: SeriesConfig = DEFAULT,
    means: Sequence[str] | None = None,
    lasts: Sequence[str] = (),
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Mean of numeric columns and last non-null value of the others per slot.

    ``order`` breaks ties between readings of the same instant.
    """
    means = [cfg.value] if means is None else means
    rank = F.struct(cfg.time, *order) if order else F.col(cfg.time)
    measures = [F.avg(c).alias(c) for c in means]
    # max_by skips rows whose rank is null, which hides null values and empty slots.
    measures += [F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in lasts]
    return _by_slot(df, cfg, measures)


def align_to_grid(df: DataFrame, cfg: SeriesConfig = DEFAULT, order: str = "seq") -> DataFrame:
    """Put every entity on the grid that starts at the first reading of the whole panel.

    Readings off the grid are dropped, missing slots appear as null rows, and of several
    readings with one key the first by ``order`` is kept: the de-duplication and the
    densification are the same aggregation, hence one shuffle.
    """
    values = [c for c in df.columns if c not in (cfg.entity, cfg.time, order)]
    span = df.agg(F.min(micros(F.col(cfg.time))).alias("lo"), F.max(micros(F.col(cfg.time))).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    us = micros(F.col(cfg.time))
    on_grid = df.filter(F.pmod(us - lo, F.lit(cfg.step_us)) == 0)
    steps = F.call_function("div", hi - lo, F.lit(cfg.step_us))
    every = _every(df.select(cfg.entity).distinct(), [cfg.entity], F.lit(0).cast("bigint"), steps)
    slots = every.select(cfg.entity, from_micros(lo + F.col(SLOT) * F.lit(cfg.step_us)).alias(cfg.time))
    return (
        on_grid.unionByName(slots, allowMissingColumns=True)
        .groupBy(cfg.entity, cfg.time)
        .agg(*[F.min_by(c, order).alias(c) for c in values])
    )


def align_in_blocks(df: DataFrame, cfg: SeriesConfig = DEFAULT, order: str = "seq", look_back: int = 0) -> DataFrame:
    """The rows of ``align_to_grid`` in open blocks, each with its last ``look_back`` slots before.

    Only readings and one row per block of an entity are exchanged; a block's slots are made where the block lies, so the dense grid is
    never shuffled. Of several readings with one key the first is found before, as copies of one key meet before that shuffle.
    """
    values = [c for c in df.columns if c not in (cfg.entity, cfg.time, order)]
    span = df.agg(F.min(micros(F.col(cfg.time))).alias("lo"), F.max(micros(F.col(cfg.time))).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    us, size = micros(F.col(cfg.time)), cfg.block_slots
    first = df.filter(F.pmod(us - lo, F.lit(cfg.step_us)) == 0).groupBy(cfg.entity, cfg.time).agg(*[F.min_by(c, order).alias(c) for c in values])
    slot = slot_of(F.col(cfg.time), cfg.step_us)
    readings = B.open_blocks(first.withColumn(SLOT, slot), F.col(SLOT), size, look_back).drop(B.OWN, cfg.time)
    # The panel's grid may lie off the anchor of the slots; each of its times still has a slot of its own.
    begin, steps = floor_div(lo, cfg.step_us), F.call_function("div", hi - lo, F.lit(cfg.step_us))
    end = begin + steps
    blocks = df.select(cfg.entity).distinct().select(cfg.entity, F.explode(F.sequence(floor_div(begin, size), floor_div(end, size))).alias(B.BLOCK))
    placed = B.dealt(readings.filter(F.col(B.BLOCK) <= floor_div(end, size)).unionByName(blocks, allowMissingColumns=True), cfg.entity, B.BLOCK)
    home = F.col(B.BLOCK) * F.lit(size)
    every = F.sequence(F.greatest(home - F.lit(look_back), begin), F.least(home + F.lit(size - 1), end))
    slots = placed.withColumn(SLOT, F.explode(F.when(F.col(SLOT).isNull(), every).otherwise(F.array(SLOT))))
    # At most one row of a slot holds values.
    dense = slots.groupBy(cfg.entity, B.BLOCK, SLOT).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])
    return dense.select(
        cfg.entity, from_micros(lo + (F.col(SLOT) - begin) * F.lit(cfg.step_us)).alias(cfg.time), *values,
        B.BLOCK, (F.col(SLOT) >= home).alias(B.OWN),
    )
