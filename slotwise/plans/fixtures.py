"""Views over the given tables in the shapes that the operators take.

Every rule uses column values only, so any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.expressions import winsorise
from slotwise.functions.timegrid import slot_of, slot_start
from slotwise.operators.cleaning import clean_meter, clean_weather, dedupe_first
from slotwise.operators.features import build_feature_table, features_from_readings
from slotwise.operators.joins import merge_sources
from slotwise.operators.models import LinearScore
from slotwise.session import is_broadcastable, written
from slotwise.sources.readers import calendar_days

# The grid of the queries: readings are sparse, so a day has 4 slots and a week 28.
GRID = SeriesConfig(freq_minutes=360, lag_steps=(1, 2, 4, 28), rolling_windows=(4, 28))
HOURLY = SeriesConfig(freq_minutes=60, lag_steps=(1, 2), rolling_windows=(4,))
WEATHER_VALUES = ("temperature_c", "humidity_pct", "wind_speed_ms")
SHIFT_AT = "2024-01-16"
DRIFT_AT = "2024-01-21"
PLACE = (45.65, 13.78)
# Half of the event types are tested, the others measured.
DRIFT_TESTS = {"view": "ks", "click": "ks", "error": "ks"}
# A linear model for the scoring and attribution queries. The weights have
# many digits so that forecasts are not exact ties of the rounding to four digits.
WEIGHTS = LinearScore(
    {
        "lag_1": 0.3141592, "lag_4": 0.2236068, "roll_mean_4": 0.2718281, "roll_std_4": 0.0577215,
        "hour_sin": -0.4142135, "hour_cos": 0.1098612, "heating_degree": 0.0817317, "cooling_degree": -0.0201371,
        "is_weekend": 0.1512893, "humidity_pct": 0.0103719,
    },
    1.5052731,
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def household(user_id) -> F.Column:
    return F.format_string("HH%04d", user_id)


def shape_meter(events: DataFrame) -> DataFrame:
    """Readings with nulls, values above the cap and copies that come later in the input."""
    copies = F.when(F.col("event_id") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.select("event_id", "ts", "user_id", "value", F.explode(copies).alias("c"))
    value = F.when(F.col("event_id") % 53 != 0, F.col("value") / 10 + F.col("c"))
    return rows.select(
        (F.col("event_id") + F.col("c").cast("bigint") * 1000000000).alias("seq"),
        F.col("ts").alias("timestamp"),
        household(F.col("user_id")).alias("household_id"),
        value.alias("consumption_kwh"),
        (F.col("user_id") % 5 == 0).alias("is_real_data"),
    )


def meter_raw(spark: SparkSession, d: str) -> DataFrame:
    return shape_meter(table(spark, d, "events"))


def meter_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Nine of ten readings on the full hour, the others off the grid; flags partly unknown."""
    e = meter_raw(spark, d)
    on_hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    return e.select(
        "seq",
        F.when(F.col("seq") % 10 == 0, F.col("timestamp")).otherwise(on_hour).alias("timestamp"),
        "household_id", "consumption_kwh",
        F.when(F.col("seq") % 3 != 0, F.col("is_real_data")).alias("is_real_data"),
    )


def meter_half_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Readings of the default grid: on the half hour, but for one of ten after the first day, seven minutes late."""
    e = meter_raw(spark, d)
    start = slot_start(slot_of(F.col("timestamp"), DEFAULT.step_us), DEFAULT.step_us)
    late = (F.col("seq") % 10 == 0) & (F.dayofmonth("timestamp") > 1)
    return e.withColumn("timestamp", F.when(late, F.timestamp_add("MINUTE", F.lit(7), start)).otherwise(start)).withColumn(
        "is_real_data", F.when(F.col("seq") % 3 != 0, F.col("is_real_data")))


def pipeline_features(spark: SparkSession, d: str) -> DataFrame:
    """Raw readings, weather and calendar to features, step by step on the default grid, with all flags.

    Weather has a row per hour: written first, its true size decides how it is joined. Rows stay in open blocks from step to step, so
    the grid is not shuffled unless that join shuffles it.
    """
    hourly = written(weather(spark, d), "weather")
    cleaned = clean_meter(meter_half_hourly(spark, d), open_for=DEFAULT.look_back + 1)
    merged = merge_sources(cleaned, hourly, calendar(spark, d).drop("day_of_week"))
    return build_feature_table(merged, on_grid=True, dealt=is_broadcastable(hourly))


def readings(spark: SparkSession, d: str) -> DataFrame:
    """First reading per key, clipped."""
    first = dedupe_first(meter_raw(spark, d), ["household_id", "timestamp"])
    return first.withColumn("consumption_kwh", winsorise(F.col("consumption_kwh")))


def weather_raw(spark: SparkSession, d: str) -> DataFrame:
    """Hourly weather with missing days and runs of null temperatures."""
    e = table(spark, d, "events").filter("event_type = 'view'").filter(~F.dayofmonth("ts").isin(3, 10, 17))
    hours = e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")).agg(F.avg("value").alias("v"))
    hour, day = F.hour("timestamp"), F.dayofmonth("timestamp")
    hidden = ((day % 4 == 0) & hour.between(11, 15)) | ((day % 4 != 0) & (hour == 20))
    return hours.select(
        F.timestamp_diff("HOUR", ntz("1970-01-01"), F.col("timestamp")).alias("seq"),
        "timestamp",
        F.when(~hidden, -5 + F.col("v") / 5 + hour).alias("temperature_c"),
        F.least(F.lit(100.0), 40 + F.col("v") / 2).alias("humidity_pct"),
        (F.col("v") / 20).alias("wind_speed_ms"),
    )


def weather(spark: SparkSession, d: str) -> DataFrame:
    return clean_weather(weather_raw(spark, d), WEATHER_VALUES)


def calendar(spark: SparkSession, d: str) -> DataFrame:
    """Every day that the events cover."""
    span = table(spark, d, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    # The supplied holiday table.
    holidays = spark.createDataFrame([("2024-01-01",), ("2024-01-06",)], "date string")
    return calendar_days(span, "first", "last", holidays)


def grid(spark: SparkSession, d: str, cfg: SeriesConfig = GRID) -> DataFrame:
    from slotwise.operators.grid import resample_mean_last

    return resample_mean_last(readings(spark, d), cfg, order=())


def features(spark: SparkSession, d: str) -> DataFrame:
    """Features of the 6-hour grid. Weather whose estimate has outgrown a broadcast is written first, as in ``pipeline_features``."""
    hourly = weather(spark, d)
    hourly = hourly if is_broadcastable(hourly) else written(hourly, "weather")
    return features_from_readings(readings(spark, d), hourly, calendar(spark, d), GRID)


def stored_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table as later jobs find it: written once, read with pruned columns."""
    return written(features(spark, d), "features")


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Model versions: one family per nation, one version per supplier."""
    from pyspark.sql import Window

    order = Window.partitionBy("n_name").orderBy("s_suppkey")
    both = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    first = both.agg(F.min("n_nationkey")).scalar()
    numbered = both.withColumn("version", F.row_number().over(order).cast("bigint"))
    live = (F.col("version") == 1) & (F.col("n_nationkey") == first)
    return numbered.select(
        F.col("n_name").alias("model_name"), "version",
        F.when(F.col("s_suppkey") % 13 != 0, F.abs("s_acctbal") / 10000).alias("mae"),
        F.when(live, "Production").otherwise("None").alias("stage"),
    )


def drift_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Event values as (feature, value) rows before and after a day; errors grow by half."""
    e = table(spark, d, "events")
    ref = e.filter(F.col("ts") < ntz(DRIFT_AT)).select(F.col("event_type").alias("feature"), "value")
    later = e.filter(F.col("ts") >= ntz(DRIFT_AT))
    grown = F.when(F.col("event_type") == "error", F.col("value") * 1.5).otherwise(F.col("value"))
    return ref, later.select(F.col("event_type").alias("feature"), grown.alias("value"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_returnflag", F.col("l_quantity").alias("consumption_kwh"),
        (F.col("l_quantity") * (1 - F.col("l_discount")) + F.col("l_tax")).alias("prediction"),
    )


def shifted(spark: SparkSession, d: str) -> DataFrame:
    """Readings whose level is four times as high from the middle of the month on."""
    r = readings(spark, d)
    up = F.when(F.col("timestamp") >= ntz(SHIFT_AT), F.col("consumption_kwh") * 4)
    return r.withColumn("consumption_kwh", up.otherwise(F.col("consumption_kwh")))


def requests(spark: SparkSession, d: str) -> DataFrame:
    """One request per household: its last readings and the hour after the last of them."""
    from slotwise.operators.joins import asof_join
    from slotwise.streaming.live import recent_buffer

    known = readings(spark, d).filter(F.col("consumption_kwh").isNotNull())
    recent = recent_buffer(known)
    # At most 400 readings per household: the buffer bounds the array.
    nested = F.array_sort(F.collect_list(F.struct("timestamp", "consumption_kwh")))
    per_home = recent.groupBy("household_id").agg(nested.alias("recent_readings"))
    due = F.timestamp_add("HOUR", F.lit(7), F.element_at("recent_readings", -1)["timestamp"])
    rows = per_home.select("household_id", due.alias("forecast_timestamp"), "recent_readings")
    hot = asof_join(
        rows.withColumnRenamed("forecast_timestamp", "timestamp"), weather_raw(spark, d), ["temperature_c"],
        spread=["household_id"], tolerance_minutes=7 * 60,
    )
    # Forecast temperatures come with one decimal.
    shown = F.round(F.col("temperature_c") + 1.3e-10, 1)
    return hot.withColumn("temperature_c", shown).withColumnRenamed("timestamp", "forecast_timestamp")
