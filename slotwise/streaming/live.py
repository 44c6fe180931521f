"""Live readings: sources, tumbling means, enrichment, buffers and rolling features.

Every sink writes one folder per micro-batch and overwrites it when the batch is retried,
so a lost executor or a restart neither loses nor repeats rows. Readers take the newest
batch per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.timegrid import from_micros, micros, slot_of, slot_start
from slotwise.operators.blocks import dealt
from slotwise.operators.features import features_from_readings
from slotwise.operators.joins import asof_join, last_n


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything that is there in micro-batches, then stop."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def newest_per_key(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the versions of a key written by several batches, the last.

    A batch holds a key once, so aggregating what a task has read saves no rows and holds all of them: rows are dealt first.
    """
    rest = [c for c in table.columns if c not in (*keys, "batch_id")]
    return dealt(table, *keys).groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])


def slot_sums(readings: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Sum, known values and readings per entity and slot: what adds up over batches."""
    start = slot_start(slot_of(F.col(cfg.time), cfg.step_us), cfg.step_us)
    return readings.groupBy(cfg.entity, start.alias(cfg.time)).agg(
        F.sum(cfg.value).alias("_sum"), F.count(cfg.value).alias("_known"), F.count(F.lit(1)).alias("n_readings")
    )


def tumbling_table(stream: DataFrame, path: str, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Mean per entity and slot of a stream of naive-UTC readings, however late they come.

    A batch writes its sums, and the reader adds the batches up: no state, no watermark, and a batch
    that is retried overwrites its own folder.
    """
    write = batch_folder(f"{path}/sums")
    run_available(stream, lambda batch, i: write(slot_sums(batch, cfg), i), f"{path}/checkpoint")
    sums = stream.sparkSession.read.parquet(f"{path}/sums")
    total, known = F.sum("_sum"), F.sum("_known")
    return sums.groupBy(cfg.entity, cfg.time).agg(
        F.when(known > 0, total / known).alias(cfg.value), F.sum("n_readings").alias("n_readings")
    )


def enrich_stream(
    stream: DataFrame, weather: DataFrame, values: Sequence[str], path: str, cfg: SeriesConfig = DEFAULT,
    location: tuple[float, float] | None = None,
) -> DataFrame:
    """Each reading with the weather as of then, its provenance and place."""
    write = batch_folder(f"{path}/out")

    def handle(batch: DataFrame, batch_id: int) -> None:
        joined = asof_join(batch, weather, values, spread=[cfg.entity], time=cfg.time, order=None, matched="weather_at")
        joined = joined.withColumn("is_real_weather", F.col("weather_at").isNotNull()).drop("weather_at")
        if location is not None:
            joined = joined.withColumns({"source_latitude": F.lit(location[0]), "source_longitude": F.lit(location[1])})
        write(joined, batch_id)

    run_available(stream, handle, f"{path}/checkpoint")
    return stream.sparkSession.read.parquet(f"{path}/out").drop("batch_id")


def recent_buffer(readings: DataFrame, cfg: SeriesConfig = DEFAULT, n: int = C.RECENT_BUFFER_ROWS, order: str = "seq") -> DataFrame:
    """The last ``n`` readings per entity."""
    return last_n(readings, [cfg.entity], [F.col(cfg.time).desc(), F.col(order).desc()], n, spread=[order])


def buffer_stream(stream: DataFrame, path: str, cfg: SeriesConfig = DEFAULT, n: int = C.RECENT_BUFFER_ROWS, order: str = "seq") -> DataFrame:
    """The same over a stream: a batch adds at most ``n`` rows per entity to the table."""
    write = batch_folder(f"{path}/out")
    run_available(stream, lambda b, i: write(recent_buffer(b, cfg, n, order), i), f"{path}/checkpoint")
    return recent_buffer(stream.sparkSession.read.parquet(f"{path}/out").drop("batch_id"), cfg, n, order)


def session_stats(readings: DataFrame, cfg: SeriesConfig = DEFAULT, order: str = "seq") -> DataFrame:
    """Count, first time, mean and latest reading per entity."""
    at = F.struct(cfg.time, order)
    return readings.groupBy(cfg.entity).agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.min(cfg.time).alias("started_at"),
        F.avg(cfg.value).alias("mean_value"),
        F.max(at).getField(cfg.time).alias("latest_at"),
        F.max_by(cfg.value, at).alias("latest_value"),
    )


def sample_gates(readings: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    """Per entity, what its number of readings is enough for."""
    n = F.count(F.lit(1))
    return readings.groupBy(cfg.entity).agg(
        n.alias("n_readings"),
        (n >= C.MIN_PLOT_ROWS).alias("can_plot"),
        (n >= C.MIN_FORECAST_ROWS).alias("can_forecast"),
        (n >= C.MIN_DRIFT_ROWS).alias("can_check_drift"),
    )


def location_mix(readings: DataFrame, latitude: float, longitude: float) -> DataFrame:
    """How many buffered readings come from the current place, and whether places mix."""
    here = (F.round("source_latitude", 2) == round(latitude, 2)) & (F.round("source_longitude", 2) == round(longitude, 2))
    counts = readings.agg(F.count_if(here).alias("n_here"), F.count(F.lit(1)).alias("n_total"))
    return counts.withColumn("is_mixed", (F.col("n_here") > 0) & (F.col("n_here") < F.col("n_total")))


def feature_batches(
    spark: SparkSession, weather: DataFrame, calendar: DataFrame, path: str, cfg: SeriesConfig,
    clean: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Callable[[DataFrame, int], None]:
    """Handler that keeps the features of all slots so far up to date below ``path``.

    A batch stores its readings, then recomputes the slots from its earliest reading on
    for the entities it touches. Readings older than the look-back of that slot are pruned
    by day folder. The result equals the batch job over all readings, late ones included.
    """
    store, seen, out = f"{path}/readings", f"{path}/seen", f"{path}/features"
    reach = (cfg.look_back + 1 + C.SHORT_GAP_LIMIT) * cfg.step_us
    write = batch_folder(out)

    def handle(batch: DataFrame, batch_id: int) -> None:
        days = batch.withColumn("dt", F.to_date(cfg.time))
        days.write.mode("overwrite").partitionBy("dt").parquet(f"{store}/batch_id={batch_id}")
        saved = spark.read.parquet(f"{store}/batch_id={batch_id}")
        # Slots change from the first touched one on, and those between the reading seen
        # last and a new one appear.
        ends = saved.groupBy(cfg.entity).agg(F.min(cfg.time).alias("_first"), F.max(cfg.time).alias("_seen"))
        ends.select(cfg.entity, "_seen").write.mode("overwrite").parquet(f"{seen}/batch_id={batch_id}")
        earlier = spark.read.parquet(seen).filter(F.col("batch_id") < batch_id)
        known = earlier.groupBy(cfg.entity).agg(F.max("_seen").alias("_last"))
        touched = ends.join(known, cfg.entity, "left").select(cfg.entity, F.least("_first", "_last").alias("_from"))
        since = touched.agg(F.min("_from")).scalar()
        floor = from_micros(micros(since) - F.lit(reach))
        everything = spark.read.parquet(store)
        past = everything.filter((F.col("dt") >= F.to_date(floor)) & (F.col(cfg.time) >= floor)).drop("dt", "batch_id")
        mine = past.join(touched.select(cfg.entity), cfg.entity, "left_semi")
        rows = features_from_readings(clean(mine), weather, calendar, cfg)
        changed = rows.join(touched, cfg.entity).filter(
            F.col(cfg.time) >= slot_start(slot_of(F.col("_from"), cfg.step_us), cfg.step_us)
        )
        write(changed.drop("_from"), batch_id)

    return handle


def feature_stream(
    stream: DataFrame, weather: DataFrame, calendar: DataFrame, path: str, cfg: SeriesConfig,
    clean: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Features of all slots of a stream of readings, the newest version of each."""
    spark = stream.sparkSession
    run_available(stream, feature_batches(spark, weather, calendar, path, cfg, clean), f"{path}/checkpoint")
    return newest_per_key(spark.read.parquet(f"{path}/features"), [cfg.entity, cfg.time])
