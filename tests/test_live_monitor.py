"""Streams joined with streams, keyed list state, and live features that feed detectors."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.operators.features import features_from_readings
from slotwise.operators.joins import asof_join
from slotwise.streaming import adwin, buffers, live, monitor, pairing
from tests.helpers import at, meter
from tests.test_streaming import CFG, WEATHER, readings

MONITORED = ("consumption_kwh", "temperature_c", "heating_degree", "lag_1", "lag_4")
DAYS = [("2024-01-01", False, True), ("2024-01-02", False, False), ("2024-01-03", False, False)]


def sides(spark):
    weather = spark.createDataFrame([(at("2024-01-01", 60 * h), float(h % 24), 50.0, 3.0) for h in range(70)], WEATHER)
    return weather, spark.createDataFrame(DAYS, "date string, is_weekend boolean, is_holiday boolean").withColumn("date", F.to_date("date"))


def states(events):
    last = events.filter("kind = 'state'").groupBy("household_id", "feature").agg(F.max(F.struct("n_updates", "timestamp", "width")).alias("s"))
    return sorted(tuple(r) for r in last.select("household_id", "feature", "s.n_updates", "s.timestamp", "s.width").collect())


def drifts(events):
    return sorted(tuple(r) for r in events.filter("kind = 'drift'").select("household_id", "feature", "timestamp", "n_updates", "width").collect())


@pytest.mark.parametrize("late", [False, True])
def test_monitored_stream_equals_batch(spark, folder, late):
    """Each final slot is fed once and in order, however often its features were recomputed; an entity pauses in between."""
    stream, df = readings(spark, folder, files=4, n=400, shuffle_last=late)
    weather, calendar = sides(spark)
    # The late rows of the last file are up to half the series late.
    lateness = 3000 if late else 60
    out = monitor.monitored_stream(stream, weather, calendar, f"{folder}/m", CFG, features=MONITORED, lateness_minutes=lateness, delta=0.3)
    final = monitor.final_features(features_from_readings(df, weather, calendar, CFG), df, lateness, CFG)
    batch = adwin.batch_events(adwin.detector_input(final.withColumn("seq", F.lit(0).cast("bigint")), MONITORED), 0.3)
    assert states(out) == states(batch) and len(states(batch)) > 10
    assert drifts(out) == drifts(batch)
    fed = spark.read.parquet(f"{folder}/m/final")
    assert fed.count() == fed.select("household_id", "timestamp").distinct().count() == final.count()


def test_shift_is_found_while_streaming(spark, folder):
    n = 600
    pdf = pd.DataFrame({"seq": range(n), "timestamp": pd.date_range("2024-01-01", periods=n, freq="30min"), "household_id": "a",
                        "consumption_kwh": np.where(np.arange(n) < 300, 1.0, 9.0) + np.arange(n) % 3 * 0.01})
    for i, part in enumerate(np.array_split(pdf, 5)):
        meter(spark, part).coalesce(1).write.parquet(f"{folder}/in/part={i}")
    stream = live.read_stream(spark, f"{folder}/in/*", meter(spark, pdf).schema, max_files=1)
    weather, calendar = sides(spark)
    out = monitor.monitored_stream(stream, weather, calendar, f"{folder}/m", CFG, features=MONITORED, lateness_minutes=60)
    assert {r[1] for r in drifts(out)} >= {"consumption_kwh", "lag_1", "lag_4"}


def test_status_has_window_widths(spark):
    events = spark.createDataFrame([("x", at(minutes=1))], "feature string, timestamp timestamp_ntz")
    windows = spark.createDataFrame([("a", "x", 5), ("b", "x", 9), ("a", "y", 2)], "household_id string, feature string, width bigint")
    out = adwin.drift_status(events, spark.range(3).agg(F.count(F.lit(1))), windows=windows).first()
    assert out.window_widths == {"x": 9, "y": 2} and out.n_updates == 3


# --- two streams ----------------------------------------------------------------------

R = "seq bigint, household_id string, timestamp timestamp_ntz, consumption_kwh double"
W = "seq bigint, timestamp timestamp_ntz, temperature_c double, humidity_pct double"


@pytest.mark.parametrize("lateness", [60, 100_000])
def test_paired_streams_equal_batch_join(spark, folder, lateness):
    """Files in any order; with little allowance most rows are late: no reading is lost, and weather is only ever too old."""
    r = random.Random(4)
    rows = [(i, r.choice("ab"), at("2024-01-01", r.randrange(0, 5000)), float(i)) for i in range(300)]
    weather = [(i, at("2024-01-01", r.randrange(0, 5000)), r.choice([None, float(i)]), 50.0) for i in range(60)]
    weather += [(100 + i, weather[i][1], -float(i), 1.0) for i in range(10)]
    for name, data, schema, files in (("r", rows, R, 4), ("w", weather, W, 3)):
        r.shuffle(data)
        for i in range(files):
            spark.createDataFrame(data[i::files], schema).coalesce(1).write.parquet(f"{folder}/{name}/part={i}")
    values = ["temperature_c", "humidity_pct"]
    left, right = (live.read_stream(spark, f"{folder}/{n}/*", s, max_files=1) for n, s in (("r", R), ("w", W)))
    got = pairing.paired_table(left, right, values, f"{folder}/p", CFG, lateness_minutes=lateness)
    want = asof_join(spark.createDataFrame(rows, R), spark.createDataFrame(weather, W), values, spread=["household_id"], matched="weather_at")
    columns = ["seq", "household_id", "timestamp", "consumption_kwh", "weather_at", *values]
    key = lambda t: sorted((tuple(x) for x in t.select(columns).collect()), key=repr)
    if lateness > 60:
        assert key(got) == key(want)
    exact = {x[0]: x for x in key(want)}
    pairs = key(got)
    assert [x[0] for x in pairs] == [x[0] for x in key(want)]
    assert all(x == exact[x[0]] or (exact[x[0]][4] is not None and (x[4] is None or x[4] < exact[x[0]][4] or x[5:] != exact[x[0]][5:])) for x in pairs)
    assert got.where("weather_at is null").count() > 0 and got.where("weather_at is not null and temperature_c is null").count() > 0


# --- list state -----------------------------------------------------------------------


def test_state_buffer_equals_recent_buffer_over_a_restart(spark, folder):
    import os
    import shutil

    _, df = readings(spark, folder, files=4, shuffle_last=True)
    df = df.withColumn("consumption_kwh", F.when(F.col("seq") % 7 != 0, F.col("consumption_kwh")))
    schema = df.schema
    os.makedirs(f"{folder}/now")
    for i in range(4):
        df.filter(F.col("seq") % 4 == i).coalesce(1).write.parquet(f"{folder}/all/p={i}")
    columns = ["seq", "household_id", "timestamp", "consumption_kwh"]
    key = lambda t: sorted((tuple(r) for r in t.select(columns).collect()), key=repr)
    for first, last in ((0, 2), (2, 4)):
        for i in range(first, last):
            shutil.copytree(f"{folder}/all/p={i}", f"{folder}/now/p={i}")
        stream = live.read_stream(spark, f"{folder}/now/*", schema, max_files=1)
        out = buffers.state_buffer(stream, f"{folder}/b", CFG, n=12)
        assert key(out) == key(live.recent_buffer(df.filter(F.col("seq") % 4 < last), CFG, n=12))


def test_silent_entities_expire(spark, folder):
    rows = [(i, "a", at("2024-01-01", 30 * i), 1.0) for i in range(10)] + [(20 + i, "b", at("2024-01-01", 30 * i), 2.0) for i in range(80)]
    for i, part in enumerate((rows[:15], rows[15:50], rows[50:])):
        spark.createDataFrame(part, R).coalesce(1).write.parquet(f"{folder}/in/p={i}")
    stream = live.read_stream(spark, f"{folder}/in/*", R, max_files=1)
    out = buffers.state_buffer(stream, f"{folder}/b", SeriesConfig(), n=5, idle_minutes=600)
    assert {r.household_id for r in out.collect()} == {"b"} and out.count() == 5
