import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.operators import features, joins
from tests.helpers import assert_close, at, meter, panel, rows


def sides(spark, n=400, m=120, seed=2):
    rng = np.random.default_rng(seed)
    base = pd.Timestamp("2024-01-01")
    left = pd.DataFrame({
        "seq": range(n), "timestamp": base + pd.to_timedelta(rng.integers(0, 6000, n), unit="min"),
        "household_id": rng.choice(["a", "b", "c"], n), "consumption_kwh": 1.0,
    }).sort_values("timestamp", kind="stable")
    t = base + pd.to_timedelta(np.sort(rng.integers(0, 6000, m)), unit="min")
    v = rng.normal(0, 1, m)
    v[rng.random(m) < 0.2] = np.nan
    right = pd.DataFrame({"timestamp": t, "temperature_c": v, "seq": range(m)})
    rdf = spark.createDataFrame(
        [(a.to_pydatetime(), None if np.isnan(b) else float(b), int(s)) for a, b, s in right.itertuples(index=False)],
        "timestamp timestamp_ntz, temperature_c double, seq bigint",
    )
    expected = pd.merge_asof(left, right[["timestamp", "temperature_c"]], on="timestamp", tolerance=pd.Timedelta("1h"))
    return meter(spark, left), rdf, expected.sort_values("seq")


@pytest.mark.parametrize("plan", ["lookup", "merge"])
def test_asof_equals_merge_asof(spark, plan):
    left, right, expected = sides(spark)
    out = rows(joins.asof_join(left, right, ["temperature_c"], ["household_id"], plan=plan), "seq")
    assert_close(out.temperature_c, expected.temperature_c)
    assert len(out) == len(expected)


@pytest.mark.parametrize("plan", ["lookup", "merge"])
def test_asof_tolerance_is_inclusive_and_last_of_ties_wins(spark, plan):
    left = spark.createDataFrame([(at("2024-01-01 01:00"), "a"), (at("2024-01-01 01:01"), "a")], "timestamp timestamp_ntz, household_id string")
    right = spark.createDataFrame([(at("2024-01-01"), 1.0, 0), (at("2024-01-01"), 2.0, 1)], "timestamp timestamp_ntz, v double, seq bigint")
    out = rows(joins.asof_join(left, right, ["v"], ["household_id"], plan=plan), "timestamp")
    assert out.v.fillna(-1).tolist() == [2.0, -1.0]


def test_asof_with_station_key(spark):
    left = spark.createDataFrame([(at("2024-01-01 00:30"), "a", s) for s in ("x", "y")], "timestamp timestamp_ntz, household_id string, station string")
    right = spark.createDataFrame([(at("2024-01-01"), 1.0, 0, "x"), (at("2024-01-01 00:20"), 2.0, 1, "y")], "timestamp timestamp_ntz, v double, seq bigint, station string")
    for plan in ("lookup", "merge"):
        out = rows(joins.asof_join(left, right, ["v"], ["household_id"], by=["station"], plan=plan), "station")
        assert out.v.tolist() == [1.0, 2.0]


def test_lookup_join_is_the_same_with_salt(spark):
    df, _ = panel(spark)
    means = df.groupBy("household_id").agg(F.avg("consumption_kwh").alias("m"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    a = rows(joins.lookup_join(df, means, ["household_id"], ["timestamp"]), "seq")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        b = rows(joins.lookup_join(df, means, ["household_id"], ["timestamp"]), "seq")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    pd.testing.assert_frame_equal(a, b)


def test_last_n_is_exact(spark):
    df, pdf = panel(spark, n=50)
    out = rows(joins.last_n(df, ["household_id"], [F.col("timestamp").desc()], 7, ["seq"]), "seq")
    assert out.seq.tolist() == pdf.groupby("household_id").tail(7).seq.tolist()


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_lags_and_rolling_equal_pandas_for_any_block_size(spark, block):
    cfg = SeriesConfig(lag_steps=(1, 2, 5), rolling_windows=(4, 12), block_slots=block)
    df, pdf = panel(spark, n=70, holes=0.5)
    out = rows(features.history_features(df, cfg), "seq")
    g = pdf.groupby("household_id")["consumption_kwh"]
    for k in cfg.lag_steps:
        assert_close(out[f"lag_{k}"], g.shift(k))
    for w in cfg.rolling_windows:
        past = g.shift(1).groupby(pdf["household_id"])
        window = lambda s: s.rolling(w, min_periods=max(1, w // 4))
        assert_close(out[f"roll_mean_{w}"], past.transform(lambda s: window(s).mean()))
        assert_close(out[f"roll_std_{w}"], past.transform(lambda s: window(s).std()), 1e-7)


def test_rolling_of_equal_values_has_zero_deviation(spark):
    df, _ = panel(spark, n=40, holes=0)
    flat = df.withColumn("consumption_kwh", F.when(F.col("seq") % 40 < 5, 17.3).otherwise(0.1))
    cfg = SeriesConfig(lag_steps=(1,), rolling_windows=(4,))
    out = rows(features.add_rolling_features(flat, cfg), "seq")
    assert (out.roll_std_4[out.seq % 40 > 10] < 1e-12).all()


def test_rolling_excludes_the_current_row(spark):
    df, _ = panel(spark, n_households=1, n=20, holes=0)
    df = df.withColumn("consumption_kwh", F.col("seq").cast("double"))
    out = rows(features.history_features(df, SeriesConfig(lag_steps=(1,), rolling_windows=(4,))), "seq")
    assert out.roll_mean_4[10] == pytest.approx(7.5)
    assert out.lag_1.tolist()[1:] == list(range(19))


def test_calendar_and_degree_features(spark):
    df = spark.createDataFrame(
        [(at("2024-01-06 06:30"), None, None, 25.0), (at("2024-01-08 18:00"), True, False, None)],
        "timestamp timestamp_ntz, is_weekend boolean, is_holiday boolean, temperature_c double",
    )
    out = rows(features.add_degree_features(features.add_calendar_features(df)), "timestamp")
    assert out.day_of_week.tolist() == [5, 0] and out.is_weekend.tolist() == [0, 1]
    assert out.hour_sin.tolist() == pytest.approx([np.sin(2 * np.pi * 6.5 / 24), -1.0])
    assert out.heating_degree.fillna(-1).tolist() == [0.0, -1.0]
    assert out.cooling_degree.fillna(-1).tolist() == [3.0, -1.0]


def test_feature_columns_leave_out_keys_target_and_provenance():
    names = ["household_id", "timestamp", "consumption_kwh", "is_winsorised", "was_missing", "is_real_meter_data", "lag_1", "hour"]
    assert features.feature_columns(names) == ["lag_1", "hour"]


def test_build_feature_table_off_grid_resamples(spark):
    df, _ = panel(spark, n_households=2, n=30, freq="7min", holes=0)
    out = features.build_feature_table(df.drop("seq"), SeriesConfig(lag_steps=(1,), rolling_windows=(2,)), on_grid=False)
    assert out.count() == 2 * 7
    assert {"lag_1", "roll_mean_2", "roll_std_2", "hour_sin"} <= set(out.columns)


@pytest.mark.parametrize("block_slots", [128, 4096])
def test_rolling_after_a_spike_equals_brute_force(spark, block_slots):
    """A value a million times the others leaves no trace in frames that do not hold it."""
    rng = np.random.default_rng(5)
    y = 0.1 + 0.01 * rng.normal(size=900)
    y[40], y[610] = 1e6, -1e6
    y[rng.random(900) < 0.2] = np.nan
    pdf = pd.DataFrame({"seq": range(900), "timestamp": pd.date_range("2024-01-01", periods=900, freq="30min"), "household_id": "a", "consumption_kwh": y})
    cfg = SeriesConfig(rolling_windows=(48, 7, 1), block_slots=block_slots)
    out = rows(features.add_rolling_features(meter(spark, pdf), cfg), "timestamp")
    for w in cfg.rolling_windows:
        frames = [y[max(0, i - w): i] for i in range(900)]
        known = [f[~np.isnan(f)] for f in frames]
        enough = max(1, w // 4)
        mean = [k.mean() if len(k) >= enough else np.nan for k in known]
        std = [k.std(ddof=1) if len(k) >= max(enough, 2) else np.nan for k in known]
        for name, want in ((f"roll_mean_{w}", mean), (f"roll_std_{w}", std)):
            got = out[name].to_numpy(dtype=float)
            assert (np.isnan(got) == np.isnan(want)).all()
            np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("plan", ["lookup", "merge"])
@pytest.mark.parametrize(("kind", "order"), [("double", (0.2, 0.7, 0.4)), ("string", ("a", "c", "b")), ("bigint", (1, 9, 4))])
def test_asof_plans_agree_on_null_keys_and_kinds_of_order(spark, plan, kind, order):
    left = spark.createDataFrame([(at("2024-01-01 01:00"), "a"), (at("2024-01-01 01:00"), None), (at("2024-01-01 01:00"), "b")], "timestamp timestamp_ntz, household_id string")
    hits = [(at("2024-01-01 00:30"), "a", 10.0 + i, o) for i, o in enumerate(order)] + [(at("2024-01-01 00:40"), None, 99.0, order[0])]
    right = spark.createDataFrame(hits, f"timestamp timestamp_ntz, household_id string, temperature double, seq {kind}")
    out = joins.asof_join(left, right, ["temperature"], ["household_id"], by=["household_id"], plan=plan)
    assert sorted(((r.household_id, r.temperature) for r in out.collect()), key=str) == sorted([("a", 11.0), (None, None), ("b", None)], key=str)
