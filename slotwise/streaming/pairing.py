"""Readings paired with weather where both are streams: an interval join of two watermarked sources.

Weather rows are copied to the time buckets (of the tolerance) that they can reach, so the join has an equality besides the interval and
Spark can drop state that the watermarks have passed. A reading without weather comes out once no weather for it can come any more.
Readings that the join has not given out when the table is read, or that came later than the watermark allows, are paired with the
weather known by then, so no reading is lost. Weather that comes later than allowed no longer changes pairs that have come out; else
the table is what the batch join gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.operators.joins import asof_join
from slotwise.streaming.live import batch_folder, run_available


def interval_join(
    readings: DataFrame, weather: DataFrame, values: Sequence[str], cfg: SeriesConfig = DEFAULT,
    tolerance_minutes: int = C.ASOF_TOLERANCE_MINUTES, lateness_minutes: int = 60, order: str = "seq",
) -> DataFrame:
    """Each reading with every weather row (``_weather_at``, ``_order``) of the tolerance before it, or with none."""
    width = tolerance_minutes * 60

    def timed(df: DataFrame) -> DataFrame:
        # Watermarks need a time with a zone; naive times are UTC.
        return df.withColumn("_at", F.col(cfg.time).cast("timestamp"))

    bucket = F.floor(F.unix_timestamp("_at") / width)
    left = timed(readings).withWatermark("_at", f"{lateness_minutes} minutes").withColumn("_bucket", bucket)
    reach = timed(weather).withWatermark("_at", f"{lateness_minutes} minutes").withColumn("_reach", F.explode(F.array(bucket, bucket + 1)))
    right = reach.select(F.col("_at").alias("_since"), F.col("_reach"), F.col(cfg.time).alias("_weather_at"), F.col(order).alias("_order"), *values)
    near = (F.col("_bucket") == F.col("_reach")) & (F.col("_since") <= F.col("_at")) & (F.col("_since") >= F.col("_at") - F.expr(f"INTERVAL {tolerance_minutes} MINUTES"))
    return left.join(right, near, "left_outer").select(*readings.columns, "_weather_at", "_order", *values)


def paired_table(
    readings: DataFrame, weather: DataFrame, values: Sequence[str], path: str, cfg: SeriesConfig = DEFAULT,
    tolerance_minutes: int = C.ASOF_TOLERANCE_MINUTES, lateness_minutes: int = 60, key: str = "seq",
) -> DataFrame:
    """All readings of a stream with the last weather at most the tolerance before them, and ``weather_at``.

    ``key`` tells readings apart; of weather rows of one time that of the highest ``key`` counts.
    """
    spark = readings.sparkSession
    joined = interval_join(readings, weather, values, cfg, tolerance_minutes, lateness_minutes, key)
    for stream, name in ((readings, "readings"), (weather.select(key, cfg.time, *values), "weather"), (joined, "paired")):
        run_available(stream, batch_folder(f"{path}/{name}"), f"{path}/checkpoint-{name}")
    pairs = spark.read.parquet(f"{path}/paired").drop("batch_id")
    rank = F.struct(F.col("_weather_at").isNotNull(), "_weather_at", "_order")
    known = pairs.groupBy(key).agg(F.max_by(F.struct("_weather_at", *values), rank).alias("_w"))
    seen = spark.read.parquet(f"{path}/readings").drop("batch_id")
    done = seen.join(known, key).select(*readings.columns, F.col("_w._weather_at").alias("weather_at"), *[F.col(f"_w.{v}").alias(v) for v in values])
    waiting = seen.join(known, key, "left_anti")
    side = spark.read.parquet(f"{path}/weather").drop("batch_id")
    late = asof_join(waiting, side, values, spread=[cfg.entity], time=cfg.time, order=key, tolerance_minutes=tolerance_minutes, matched="weather_at")
    return done.unionByName(late.select(*done.columns))
