import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.operators.features import features_from_readings
from slotwise.operators.grid import resample_mean_last
from slotwise.streaming import adwin, live
from tests.helpers import assert_close, at, meter, rows

CFG = SeriesConfig(lag_steps=(1, 4), rolling_windows=(4,))
WEATHER = "timestamp timestamp_ntz, temperature_c double, humidity_pct double, wind_speed_ms double"


def readings(spark, folder, files=3, n=240, shuffle_last=False):
    """Readings of irregular cadence in several files, one per micro-batch."""
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "seq": range(n), "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 4000, n)), unit="min"),
        "household_id": rng.choice(["a", "b", "c"], n), "consumption_kwh": rng.uniform(0, 5, n).round(3),
    })
    # One household pauses longer than the look-back and returns in the last file.
    pdf = pdf[~((pdf.household_id == "c") & (pdf.seq > 60) & (pdf.seq < 200))].reset_index(drop=True)
    parts = np.array_split(pdf, files)
    if shuffle_last:
        late = parts[1].iloc[:10]
        parts[1], parts[2] = parts[1].iloc[10:], pd.concat([parts[2], late])
    for i, part in enumerate(parts):
        meter(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/in/part={i}")
    stream = live.read_stream(spark, f"{folder}/in/*", meter(spark, pdf).schema, max_files=1)
    return stream, meter(spark, pdf)


def test_tumbling_mean_equals_batch(spark, folder):
    stream, df = readings(spark, folder)
    out = rows(live.tumbling_table(stream, f"{folder}/t", CFG), "household_id", "timestamp")
    batch = resample_mean_last(df, CFG).filter("consumption_kwh IS NOT NULL")
    assert_close(out.consumption_kwh, rows(batch, "household_id", "timestamp").consumption_kwh)
    assert out.n_readings.sum() == df.count()


def test_tumbling_keeps_readings_however_late(spark, folder):
    """One file per batch, newest first: every reading counts."""
    import os

    stream, df = readings(spark, folder)
    for n, name in enumerate(sorted(os.listdir(f"{folder}/in"), reverse=True)):
        for file in os.listdir(f"{folder}/in/{name}"):
            os.utime(f"{folder}/in/{name}/{file}", (1_000_000_000 + n, 1_000_000_000 + n))
    out = rows(live.tumbling_table(stream, f"{folder}/late", CFG), "household_id", "timestamp")
    batch = resample_mean_last(df, CFG).filter("consumption_kwh IS NOT NULL")
    assert out.n_readings.sum() == df.count()
    assert_close(out.consumption_kwh, rows(batch, "household_id", "timestamp").consumption_kwh)


@pytest.mark.parametrize("late", [False, True])
def test_feature_stream_equals_batch(spark, folder, late):
    stream, df = readings(spark, folder, shuffle_last=late)
    weather = spark.createDataFrame([(at("2024-01-01", 60 * h), float(h % 24), 50.0, 3.0) for h in range(70)], WEATHER)
    days = spark.createDataFrame([(d, False, d == "2024-01-01") for d in ("2024-01-01", "2024-01-02", "2024-01-03")], "date string, is_weekend boolean, is_holiday boolean")
    calendar = days.withColumn("date", F.to_date("date"))
    out = rows(live.feature_stream(stream, weather, calendar, f"{folder}/f", CFG), "household_id", "timestamp")
    batch = rows(features_from_readings(df, weather, calendar, CFG), "household_id", "timestamp")
    assert len(out) == len(batch)
    for c in ("consumption_kwh", "temperature_c", "lag_1", "lag_4", "roll_mean_4", "roll_std_4", "is_holiday"):
        assert_close(out[c], batch[c], 1e-7)


def test_enriched_stream_and_buffer(spark, folder):
    stream, df = readings(spark, folder)
    weather = spark.createDataFrame([(at("2024-01-01", 120 * h), float(h), 50.0, 3.0) for h in range(30)], WEATHER)
    out = live.enrich_stream(stream, weather, ["temperature_c"], f"{folder}/e", CFG, location=(45.65, 13.78))
    assert out.count() == df.count()
    hit = out.filter("is_real_weather").first()
    assert hit.source_latitude == 45.65 and hit.temperature_c is not None
    buffer = live.buffer_stream(stream, f"{folder}/b", CFG, n=12)
    expected = df.toPandas().sort_values(["timestamp", "seq"]).groupby("household_id").tail(12)
    assert sorted(r.seq for r in buffer.collect()) == sorted(expected.seq)


def test_gates_stats_and_location(spark):
    data = [(i, at(minutes=i), h, float(i)) for h, n in (("a", 1), ("b", 2), ("c", 5), ("d", 30)) for i in range(n)]
    df = spark.createDataFrame(data, "seq bigint, timestamp timestamp_ntz, household_id string, consumption_kwh double")
    gates = {r.household_id: (r.can_plot, r.can_forecast, r.can_check_drift) for r in live.sample_gates(df).collect()}
    assert gates == {"a": (False,) * 3, "b": (True, False, False), "c": (True, True, False), "d": (True,) * 3}
    stats = live.session_stats(df).filter("household_id = 'd'").first()
    assert (stats.n_readings, stats.mean_value, stats.latest_value, stats.started_at) == (30, 14.5, 29.0, at())
    here = df.withColumns({"source_latitude": F.when(F.col("seq") < 2, 45.651).otherwise(0.0), "source_longitude": F.lit(13.78)})
    assert live.location_mix(here, 45.65, 13.78).first().is_mixed
    assert not live.location_mix(here.filter("seq < 2"), 45.65, 13.78).first().is_mixed


# --- detector ------------------------------------------------------------------------


def feed(values, delta=adwin.DELTA):
    d = adwin.Adwin(delta)
    return d, [i for i, v in enumerate(values) if d.add(v)]


def test_stable_series_is_silent():
    _, hits = feed([1.0 + (i % 3) * 0.01 for i in range(200)])
    assert hits == []


def test_shift_is_found_and_the_window_shrinks():
    d, hits = feed([1.0] * 100 + [10.0] * 300)
    assert hits and 100 <= hits[0] < 164
    assert d.width <= 332 and d.total / d.width > 9


def test_totals_match_the_window_content():
    rng = np.random.default_rng(0)
    values = list(rng.normal(0, 1, 500))
    d, hits = feed(values)
    assert not hits and d.width == 500
    assert d.total == pytest.approx(sum(values)) and d.spread / d.width == pytest.approx(np.var(values))
    sizes = [b[0] for b in d.buckets]
    assert sizes == sorted(sizes, reverse=True) and sum(sizes) == 500
    assert max(sizes.count(s) for s in set(sizes)) <= adwin.BUCKETS


def test_cut_keeps_exact_statistics():
    rng = np.random.default_rng(1)
    values = list(rng.normal(0, 1, 300)) + list(rng.normal(8, 1, 333))
    d, hits = feed(values)
    kept = values[-int(d.width):]
    assert hits and d.total == pytest.approx(sum(kept)) and d.spread / d.width == pytest.approx(np.var(kept))


def test_state_survives_packing():
    rng = np.random.default_rng(2)
    values = list(rng.normal(0, 1, 150)) + list(rng.normal(3, 1, 250))
    whole, hits = feed(values)
    d, seen = adwin.Adwin(), []
    for i, v in enumerate(values):
        if i % 37 == 0:
            d = adwin.Adwin.unpack(d.pack())
        if d.add(v):
            seen.append(i)
    assert seen == hits and d.pack() == whole.pack()


def series(spark, folder=None):
    rng = np.random.default_rng(3)
    parts = []
    for h, shift in (("a", 0.0), ("b", 6.0)):
        v = rng.normal(1, 0.5, 400)
        v[200:] += shift
        parts.append(pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=400, freq="30min"), "household_id": h, "consumption_kwh": v}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf.insert(0, "seq", range(800))
    return meter(spark, pdf).withColumn("temperature_c", F.lit(None).cast("double")), pdf


def test_batch_and_stream_detectors_agree(spark, folder):
    df, pdf = series(spark)
    batch = adwin.batch_events(adwin.detector_input(df, ["consumption_kwh", "temperature_c"]))
    drifts = rows(batch.filter("kind = 'drift'"), "timestamp")
    assert set(drifts.household_id) == {"b"} and set(drifts.feature) == {"consumption_kwh"}
    for i in range(4):
        df.filter((F.col("seq") % 400 >= 100 * i) & (F.col("seq") % 400 < 100 * i + 100)).coalesce(1).write.parquet(f"{folder}/in/p={i}")
    stream = live.read_stream(spark, f"{folder}/in/*", df.schema, max_files=1)
    events = adwin.stream_events(adwin.detector_input(stream, ["consumption_kwh"]))
    live.run_available(events, live.batch_folder(f"{folder}/out"), f"{folder}/c")
    out = spark.read.parquet(f"{folder}/out")
    got = rows(out.filter("kind = 'drift'"), "timestamp")
    assert got.timestamp.tolist() == drifts.timestamp.tolist() and got.width.tolist() == drifts.width.tolist()
    widths = lambda t: {(r.household_id, r.width) for r in adwin.detector_windows(t).collect()}
    assert widths(out) == widths(batch)
    filled = adwin.backfill_events(adwin.detector_input(stream, ["consumption_kwh"]), f"{folder}/backfill")
    again = rows(filled.filter("kind = 'drift'"), "timestamp")
    assert again.timestamp.tolist() == drifts.timestamp.tolist() and again.width.tolist() == drifts.width.tolist()
    assert widths(filled) == widths(batch)


def test_reset_and_delta_commands(spark):
    df, _ = series(spark)
    commands = spark.createDataFrame(
        [("a", at("2024-01-09"), -1, "reset", None, None), ("b", at("2024-01-02"), -1, "delta", "consumption_kwh", 0.05)],
        "household_id string, timestamp timestamp_ntz, seq bigint, op string, feature string, value double")
    rows_in = adwin.detector_input(df, ["consumption_kwh"]).unionByName(adwin.control_rows(commands, ["consumption_kwh"]))
    got = {r.household_id: r for r in adwin.detector_windows(adwin.batch_events(rows_in)).collect()}
    assert got["a"].width == 400 - 8 * 48 and got["a"].delta == adwin.DELTA
    assert got["b"].delta == 0.05 and got["b"].width < 352


def test_status(spark):
    events = spark.createDataFrame([("x", at(minutes=i)) for i in range(12)] + [("y", at(minutes=5))], "feature string, timestamp timestamp_ntz")
    out = adwin.drift_status(events, spark.range(77).agg(F.count(F.lit(1)))).first()
    assert (out.n_updates, out.n_drift_events_total, out.features_with_drift_ever) == (77, 13, ["x", "y"])
    assert len(out.recent_events) == 10 and out.recent_events[-1].feature == "x"


def test_newest_versions_are_dealt_before_they_are_aggregated(spark):
    """A batch holds a key once: aggregating where files are read would hold all their rows in a few tasks."""
    rows = [(f"HH{i:04d}", i % 3, float(i * b), b) for i in range(20) for b in range(1 + i % 2)]
    out = live.newest_per_key(spark.createDataFrame(rows, "household_id string, timestamp int, v double, batch_id int"), ["household_id", "timestamp"])
    assert {r.household_id: r.v for r in out.collect()} == {f"HH{i:04d}": float(i * (i % 2)) for i in range(20)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "partial_max_by" not in plan.split("REPARTITION_BY_NUM")[1]
