"""File sources: CSV, zipped CSV, weather payloads, lenient parsing, fallbacks."""

from __future__ import annotations

import io
import logging
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.timegrid import to_naive_utc

LOG = logging.getLogger(__name__)

# Accepted column names, in order of preference for the value.
TIME_NAMES = ("timestamp", "datetime", "date_time", "date", "time")
VALUE_NAMES = (
    "consumption_kwh", "electricity_consumption_kwh", "electricity_consumption", "consumption",
    "kwh", "energy_kwh", "energy", "energy_a_plus",
)
KMH_PER_MS = 3.6
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

METER_SCHEMA = "timestamp timestamp_ntz, household_id string, consumption_kwh double, is_real_data boolean"
WEATHER_SCHEMA = "timestamp timestamp_ntz, temperature_c double, humidity_pct double, wind_speed_ms double"
CALENDAR_SCHEMA = "date date, day_of_week int, is_weekend boolean, is_holiday boolean, is_real_data boolean"
PAYLOAD_SCHEMA = (
    "hourly struct<time: array<string>, temperature_2m: array<double>,"
    " relative_humidity_2m: array<double>, wind_speed_10m: array<double>>"
)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("timestampNTZFormat", CSV_TIME).csv(path, header=True, mode="PERMISSIVE")


def normalised(name: str) -> str:
    return name.strip().lower()


def resolve_roles(schema: T.StructType) -> tuple[str, str]:
    """Names of the time and the value column of a foreign table, from the schema alone.

    Time is the first column *of the table* with an accepted name; the value is the first
    accepted name *of the list* that is present, else the only other numeric column.
    """
    actual = {normalised(f.name): f.name for f in reversed(schema.fields)}
    order = [normalised(f.name) for f in schema.fields]
    times = [n for n in order if n in TIME_NAMES]
    if not times:
        raise ValueError(f"no time column among {order}")
    time = times[0]
    named = [n for n in VALUE_NAMES if n in actual]
    if not named:
        numeric = [
            normalised(f.name) for f in schema.fields
            if isinstance(f.dataType, T.NumericType) and normalised(f.name) != time
        ]
        if len(numeric) != 1:
            raise ValueError(f"no value column among {order}")
        named = numeric
    return actual[time], actual[named[0]]


def select_roles(df: DataFrame) -> DataFrame:
    time, value = resolve_roles(df.schema)
    rest = [F.col(f"`{c}`").alias(normalised(c)) for c in df.columns if c not in (time, value)]
    return df.select(F.col(f"`{time}`").alias("timestamp"), F.col(f"`{value}`").alias("consumption_kwh"), *rest)


def parse_lenient(df: DataFrame, time: str = "timestamp", value: str = "consumption_kwh") -> DataFrame:
    """Text columns to naive UTC time and number; unreadable, null and negative rows go."""
    text = F.col(time).cast("string")
    zoned = F.try_to_timestamp(text)
    has_zone = F.trim(text).rlike(r"([zZ]|[+-]\d{2}:?\d{2})$") & text.contains(":")
    naive = F.expr(f"try_cast(`{time}` AS timestamp_ntz)")
    number = F.expr(f"try_cast(`{value}` AS double)")
    parsed = df.withColumns({time: F.when(has_zone, to_naive_utc(zoned)).otherwise(naive), value: number})
    return parsed.filter(F.col(time).isNotNull() & ~F.isnan(value) & (F.col(value) >= 0))


def in_range(df: DataFrame, start: Column, end: Column, time: str = "timestamp") -> DataFrame:
    """Rows in [start, end); a plain comparison, so it reaches the Parquet scan."""
    return df.filter((F.col(time) >= start) & (F.col(time) < end))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The same rows; the job fails if there are none."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def read_archive(spark: SparkSession, path: str, year: int, columns: Sequence[str]) -> DataFrame:
    """Rows of the one CSV member per zip whose name contains the year, as text columns.

    Zip files cannot be split, so an archive is the unit of parallelism; a member is
    decoded in batches and never held whole as rows.
    """
    columns = list(columns)

    def members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    fits = [
                        m for m in archive.namelist()
                        if m.lower().endswith(".csv") and str(year) in PurePosixPath(m).stem
                    ]
                    if len(fits) != 1:
                        raise ValueError(f"{name}: {len(fits)} CSV members for {year}, need exactly one")
                    rows = 0
                    with archive.open(fits[0]) as member:
                        for part in pd.read_csv(member, dtype=str, chunksize=50_000, keep_default_na=False, na_values=[""]):
                            part.columns = [normalised(c) for c in part.columns]
                            rows += len(part)
                            yield part.reindex(columns=columns)
                    if not rows:
                        raise ValueError(f"{name}: {fits[0]} is empty")

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(members, schema)


def read_weather_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Hourly payload files (parallel JSON arrays) to rows; wind from km/h to m/s."""
    docs = spark.read.schema(PAYLOAD_SCHEMA).json(path, multiLine=True)
    h = "hourly"
    checked = F.when(
        F.coalesce(F.size(f"{h}.time"), F.lit(0)) <= 0, F.raise_error(F.lit("weather payload without hours"))
    ).otherwise(F.arrays_zip(f"{h}.time", f"{h}.temperature_2m", f"{h}.relative_humidity_2m", f"{h}.wind_speed_10m"))
    rows = docs.select(F.explode(checked).alias("x"))
    return rows.select(
        F.to_timestamp_ntz(F.col("x.time"), F.lit("yyyy-MM-dd'T'HH:mm")).alias("timestamp"),
        F.col("x.temperature_2m").alias("temperature_c"),
        F.col("x.relative_humidity_2m").alias("humidity_pct"),
        (F.col("x.wind_speed_10m") / KMH_PER_MS).alias("wind_speed_ms"),
    )


def read_with_fallback(
    primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame], use_real: bool = True
) -> DataFrame:
    """The primary source, or the fallback if it is switched off, cannot be opened or read, or is empty.

    Opening and the first row are tried here; the other rows stay lazy. The provenance
    column says which one it was.
    """
    if use_real:
        try:
            source = primary()
            if not source.isEmpty():
                return source.withColumn("is_real_data", F.lit(True))
            LOG.warning("primary source is empty, using the fallback")
        except Exception as error:  # any failure of the source selects the fallback
            LOG.warning("primary source failed (%s), using the fallback", type(error).__name__)
    return fallback().withColumn("is_real_data", F.lit(False))


def union_populations(real: DataFrame, peers: DataFrame, entity: str, real_id: str) -> DataFrame:
    """Rows of the one real entity, under its fixed id, and of its peers."""
    renamed = real.withColumn(
        entity, F.when(F.col("is_real_data"), F.lit(real_id)).otherwise(F.col(entity))
    )
    return renamed.unionByName(peers.withColumn("is_real_data", F.lit(False)), allowMissingColumns=True)


def calendar_days(bounds: DataFrame, first: str, last: str, holidays: DataFrame) -> DataFrame:
    """One row per day of [first, last]: Monday-based weekday, weekend and holiday flags."""
    days = bounds.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("date"))
    known = holidays.select(F.to_date("date").alias("date")).distinct().withColumn("_holiday", F.lit(True))
    weekday = F.weekday("date").cast("bigint")
    return days.join(F.broadcast(known), "date", "left").select(
        "date", weekday.alias("day_of_week"), (weekday >= 5).alias("is_weekend"),
        F.coalesce("_holiday", F.lit(False)).alias("is_holiday"), F.lit(True).alias("is_real_data"),
    )


def ingest_all(sources: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Open every named source; the frames are lazy, nothing is read yet."""
    return {name: open_source() for name, open_source in sources.items()}
