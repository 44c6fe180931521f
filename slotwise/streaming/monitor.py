"""Live features into drift detectors: every slot is fed once, in order, when it is final.

Features of a slot may be recomputed while readings for it still come. A slot is final when the newest reading of all
is ``lateness`` past its start; each batch writes that mark, and per entity the last slot fed. A batch feeds what is newly final
and not fed yet, slots that only came into being after the mark (an entity that paused) included.
Readings later than that still change the features, but no detector a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.timegrid import from_micros, micros, slot_of, slot_start
from slotwise.streaming import adwin, live


def final_mark(newest: Column, lateness_minutes: int, cfg: SeriesConfig = DEFAULT) -> Column:
    """Start of the first slot that is not final yet."""
    due = from_micros(micros(newest) - F.lit(lateness_minutes * 60_000_000))
    return slot_start(slot_of(due, cfg.step_us), cfg.step_us)


def final_features(features: DataFrame, readings: DataFrame, lateness_minutes: int, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """The batch twin: all slots that are final once all readings are there."""
    mark = readings.agg(final_mark(F.max(cfg.time), lateness_minutes, cfg)).scalar()
    return features.filter(F.col(cfg.time) < mark)


def fed_once(
    spark: SparkSession, path: str, features: Sequence[str], delta: float, lateness_minutes: int, cfg: SeriesConfig
) -> Callable[[DataFrame, int], None]:
    """Handler that follows ``live.feature_batches`` on the same batch and path."""
    walk = adwin.detector_batches(spark, f"{path}/detectors", delta)

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max(cfg.time).alias("newest"))
        if batch_id:
            newest = newest.union(spark.read.parquet(f"{path}/marks/batch_id={batch_id - 1}").select("newest")).agg(F.max("newest").alias("newest"))
        newest.withColumn("mark", final_mark(F.col("newest"), lateness_minutes, cfg)).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        mark = spark.read.parquet(f"{path}/marks/batch_id={batch_id}").select("mark").scalar()
        rows = spark.read.parquet(f"{path}/features").filter(F.col("batch_id") <= batch_id).select(cfg.entity, cfg.time, *features, "batch_id")
        if batch_id:
            # What is not fed yet lies behind the last mark or is new in this batch.
            last = spark.read.parquet(f"{path}/marks/batch_id={batch_id - 1}").select("mark").scalar()
            rows = rows.filter((F.col(cfg.time) >= last) | (F.col("batch_id") == batch_id))
        rows = live.newest_per_key(rows.filter(F.col(cfg.time) < mark), [cfg.entity, cfg.time])
        if batch_id:
            fed = spark.read.parquet(f"{path}/fed/batch_id={batch_id - 1}")
            rows = rows.join(fed, cfg.entity, "left").filter(F.col("_fed").isNull() | (F.col(cfg.time) > F.col("_fed"))).drop("_fed")
        new = f"{path}/final/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(new)
        saved = spark.read.schema(rows.schema).parquet(new)
        upto = saved.groupBy(cfg.entity).agg(F.max(cfg.time).alias("_fed"))
        if batch_id:
            upto = upto.union(fed).groupBy(cfg.entity).agg(F.max("_fed").alias("_fed"))
        upto.write.mode("overwrite").parquet(f"{path}/fed/batch_id={batch_id}")
        walk(adwin.detector_input(saved.withColumn("seq", F.lit(0).cast("bigint")), features), batch_id)

    return handle


def monitored_stream(
    stream: DataFrame, weather: DataFrame, calendar: DataFrame, path: str, cfg: SeriesConfig = DEFAULT,
    clean: Callable[[DataFrame], DataFrame] = lambda df: df, features: Sequence[str] = C.MONITORED_ONLINE,
    lateness_minutes: int = 60, delta: float = adwin.DELTA,
) -> DataFrame:
    """Drift rows, and one state row per key and batch, of the monitored features of a stream of readings.

    Equals ``batch_events`` over ``final_features`` if no reading is later than ``lateness_minutes``.
    """
    spark = stream.sparkSession
    compute = live.feature_batches(spark, weather, calendar, path, cfg, clean)
    feed = fed_once(spark, path, features, delta, lateness_minutes, cfg)

    def handle(batch: DataFrame, batch_id: int) -> None:
        compute(batch, batch_id)
        feed(batch, batch_id)

    live.run_available(stream, handle, f"{path}/checkpoint")
    out = ["household_id", "feature", "timestamp", "kind", "n_updates", "width", "delta"]
    return spark.read.parquet(f"{path}/detectors/out").select(*out)
