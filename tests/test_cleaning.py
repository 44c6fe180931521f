import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.operators import cleaning, grid
from tests.helpers import METER, assert_close, at, meter, panel, rows

T0 = at()


def dirty(spark):
    times = [0, 30, 60, 90, 120, 150, 0]
    values = [0.5, 0.6, 100.0, 0.4, None, 0.3, 0.7]
    data = [(i, at(minutes=m), "HH0", v) for i, (m, v) in enumerate(zip(times, values))]
    return spark.createDataFrame(data, METER)


def test_first_copy_is_kept_even_if_null(spark):
    data = [(5, T0, "a", 2.0), (1, T0, "a", None), (9, T0, "a", 3.0)]
    out = cleaning.dedupe_first(spark.createDataFrame(data, METER), ["household_id", "timestamp"]).collect()
    assert len(out) == 1 and out[0].seq == 1 and out[0].consumption_kwh is None


def test_clean_meter_dedupes_clips_and_fills(spark):
    seen = Observation()
    out = rows(cleaning.clean_meter(dirty(spark), observation=seen), "timestamp")
    assert len(out) == 6
    assert out.consumption_kwh.tolist() == [0.5, 0.6, 20.0, 0.4, 0.4, 0.3]
    assert out.is_winsorised.tolist() == [False, False, True, False, False, False]
    assert out.was_missing.tolist() == [False, False, False, False, True, False]
    assert seen.get["rows_in"] == 7


def test_exactly_the_cap_counts_as_winsorised(spark):
    df = spark.createDataFrame([(0, T0, "a", 20.0), (1, at(minutes=30), "a", 19.99)], METER)
    assert rows(cleaning.clean_meter(df), "timestamp").is_winsorised.tolist() == [True, False]


def test_alignment_drops_readings_off_the_grid_and_spans_the_panel(spark):
    data = [(0, T0, "a", 1.0), (1, at(minutes=31), "a", 2.0), (2, at(minutes=90), "b", 3.0)]
    out = rows(grid.align_to_grid(spark.createDataFrame(data, METER)), "household_id", "timestamp")
    assert len(out) == 8
    assert out.consumption_kwh.fillna(-1).tolist() == [1, -1, -1, -1, -1, -1, -1, 3]


@pytest.mark.parametrize("block", [4, 7, 4096])
def test_forward_fill_equals_pandas_for_any_block_size(spark, block):
    df, pdf = panel(spark, holes=0.6)
    out = rows(cleaning.forward_fill(df, SeriesConfig(block_slots=block)), "seq")
    expected = pdf.groupby("household_id")["consumption_kwh"].transform(lambda s: s.ffill(limit=2))
    assert_close(out.consumption_kwh, expected)


@pytest.mark.parametrize("block", [5, 4096])
def test_provenance_fill_crosses_blocks(spark, block):
    rng = np.random.default_rng(1)
    df, pdf = panel(spark, n=50)
    flags = rng.choice([True, False, None], len(pdf), p=[0.05, 0.05, 0.9])
    flags[:50] = None
    pdf["is_real_data"] = flags
    lookup = spark.createDataFrame([(int(s), None if f is None else bool(f)) for s, f in zip(pdf.seq, flags)], "seq bigint, is_real_data boolean")
    out = rows(cleaning.fill_provenance(df.join(lookup, "seq"), cfg=SeriesConfig(block_slots=block)), "seq")
    known = pdf.assign(f=pdf.is_real_data.map({True: 1.0, False: 0.0}).astype(float))
    expected = known.groupby("household_id")["f"].transform(lambda s: s.ffill().bfill()).fillna(0) == 1
    assert out.is_real_data.tolist() == expected.tolist()


@pytest.mark.parametrize("block_hours", [3, 11, 4096])
def test_interpolation_equals_pandas_on_irregular_times(spark, block_hours):
    rng = np.random.default_rng(3)
    t = pd.to_datetime("2024-01-01") + pd.to_timedelta(np.cumsum(rng.integers(1, 300, 200)), unit="min")
    y = rng.normal(10, 3, 200)
    y[rng.random(200) < 0.6] = np.nan
    y[:4] = np.nan
    y[-6:] = np.nan
    pdf = pd.DataFrame({"timestamp": t, "temperature_c": y})
    df = spark.createDataFrame([(a, None if np.isnan(b) else float(b)) for a, b in zip(t.to_pydatetime(), y)], "timestamp timestamp_ntz, temperature_c double")
    out = rows(cleaning.interpolate_time(df, ["temperature_c"], block_us=block_hours * 3_600_000_000), "timestamp")
    expected = pdf.set_index("timestamp").interpolate(method="time", limit=3)["temperature_c"]
    assert_close(out.temperature_c, expected)


def test_resample_sum_gives_zero_for_empty_slots(spark):
    data = [(0, T0, "a", 1.5), (1, at(minutes=10), "a", 2.0), (2, at(minutes=65), "a", 4.0)]
    out = rows(grid.resample_sum(spark.createDataFrame(data, METER)), "timestamp")
    assert out.consumption_kwh.tolist() == [3.5, 0.0, 4.0]


def test_resample_mean_last_equals_pandas(spark):
    rng = np.random.default_rng(5)
    t = pd.to_datetime("2024-01-01 00:07") + pd.to_timedelta(np.sort(rng.integers(0, 900, 80)), unit="min")
    pdf = pd.DataFrame({"seq": range(80), "timestamp": t, "household_id": "a", "consumption_kwh": rng.uniform(0, 5, 80)})
    df = meter(spark, pdf).withColumn("tag", F.when(F.col("seq") % 3 > 0, F.col("seq").cast("string")))
    pdf["tag"] = [str(s) if s % 3 else None for s in pdf.seq]
    out = rows(grid.resample_mean_last(df, lasts=["tag"]), "timestamp")
    g = pdf.set_index("timestamp")
    assert_close(out.consumption_kwh, g["consumption_kwh"].resample("30min").mean())
    assert out.tag.fillna("-").tolist() == g["tag"].resample("30min").last().fillna("-").tolist()


def test_cleaning_is_deterministic(spark):
    df, _ = panel(spark)
    a = rows(cleaning.clean_meter(df), "household_id", "timestamp")
    b = rows(cleaning.clean_meter(df.repartition(7)), "household_id", "timestamp")
    pd.testing.assert_frame_equal(a, b)
