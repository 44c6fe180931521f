import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.operators import distribution as D
from slotwise.operators import drift, quality
from tests.helpers import METER, at

T0 = at()


def readings(spark, values, minutes=None):
    minutes = minutes or [30 * i for i in range(len(values))]
    return spark.createDataFrame([(i, at(minutes=m), "HH0", v) for i, (m, v) in enumerate(zip(minutes, values))], METER)


def failed(results):
    return {(r.expectation, r.column) for r in results.filter("NOT success").collect()}


def test_clean_meter_passes(spark):
    out = quality.run_suite(readings(spark, [0.3 + 0.05 * i for i in range(10)]), "smart_meter")
    assert out.count() == 7 and not failed(out)
    assert not spark.range(1).select(quality.has_critical_failure(out)).first()[0]


def test_spike_duplicate_and_gap_fail(spark):
    spike = quality.run_suite(readings(spark, [0.5, 0.6, 999.0, 0.4, 0.3]), "smart_meter")
    assert failed(spike) == {("expect_column_values_to_be_between", "consumption_kwh")}
    assert spark.range(1).select(quality.has_critical_failure(spike)).first()[0]
    copies = quality.run_suite(readings(spark, [0.5, 0.6, 0.4, 0.5], [0, 30, 60, 0]), "smart_meter")
    assert failed(copies) == {("expect_compound_columns_to_be_unique", "timestamp,household_id")}
    gap = quality.run_suite(readings(spark, [1.0, 1.0, 1.0], [0, 30, 120]), "smart_meter")
    assert gap.filter("expectation = 'expect_timestamps_regular'").first().observed == "n_gaps=1"


def test_missing_column_fails_without_a_pass(spark):
    out = quality.run_suite(readings(spark, [1.0]).drop("consumption_kwh"), "smart_meter")
    assert ("expect_column_to_exist", "consumption_kwh") in failed(out)


def test_weather_and_calendar_suites(spark):
    w = spark.createDataFrame([(T0, t, 50.0, 3.0) for t in (10.0, 200.0, None)], "timestamp timestamp_ntz, temperature_c double, humidity_pct double, wind_speed_ms double")
    assert failed(quality.run_suite(w, "weather")) == {
        ("expect_column_values_to_be_between", "temperature_c"), ("expect_column_values_to_not_be_null", "temperature_c")}
    c = spark.createDataFrame([("2024-01-01", False, True)] * 2 + [("2024-01-02", False, False)], "date string, is_weekend boolean, is_holiday boolean")
    bad = quality.run_suite(c, "calendar")
    assert failed(bad) == {("expect_column_values_to_be_unique", "date")}
    assert quality.summary(bad).first().asDict() == {"suite": "calendar", "n_expectations": 4, "n_critical_failures": 1, "n_warn_failures": 0}


def test_gap_count_equals_brute_force_across_blocks(spark):
    rng = np.random.default_rng(0)
    minutes = np.cumsum(rng.choice([5, 29, 30, 31, 200, 300000], 500, p=[0.3, 0.2, 0.2, 0.15, 0.1, 0.05]))
    out = quality.gap_counts(readings(spark, [1.0] * 500, [int(m) for m in minutes]), "household_id").first()
    assert out.n_gaps == int((np.diff(minutes) > 30).sum())


def long(spark, **columns):
    return spark.createDataFrame([(k, float(v)) for k, vs in columns.items() for v in vs], "feature string, value double")


def test_medians_are_exact(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 501), "b": rng.integers(0, 5, 501).astype(float), "c": rng.exponential(1, 501)})
    pdf.loc[:49, "a"] = np.nan
    df = spark.createDataFrame(pdf)
    got = {r.feature: r.median for r in D.exact_medians(df, ["a", "b", "c"]).collect()}
    assert got == pytest.approx(pdf.median().to_dict())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 101, 2000])
def test_medians_of_any_length(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"a": rng.lognormal(0, 2, n), "b": np.where(rng.random(n) < 0.6, 1.5, rng.normal(0, 9, n))})
    got = {r.feature: r.median for r in D.exact_medians(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    assert got == pytest.approx(pdf.median().to_dict())


def test_ks_and_wasserstein_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 1, 700).round(2), rng.normal(0.2, 1.3, 450).round(2)
    out = D.distances(D.two_sided(long(spark, f=x), long(spark, f=y))).first()
    grid = np.unique(np.concatenate([x, y]))
    f = np.searchsorted(np.sort(x), grid, side="right") / len(x)
    g = np.searchsorted(np.sort(y), grid, side="right") / len(y)
    assert out.ks_d == pytest.approx(np.abs(f - g).max(), abs=1e-12)
    assert out.wasserstein == pytest.approx((np.abs(f - g)[:-1] * np.diff(grid)).sum(), abs=1e-12)
    assert (out.n_ref, out.n_cur, out.n_values) == (700, 450, len(grid))


def test_test_choice_and_severity(spark):
    rng = np.random.default_rng(1)
    ref = {"ks": rng.normal(10, 3, 500), "same": rng.normal(0, 1, 500), "far": rng.normal(0, 1, 1500),
           "near": rng.normal(0, 1, 1500), "flag": [0, 1] * 250, "few": [1, 2, 3] * 100, "js": [1, 2, 3] * 500}
    cur = {"ks": rng.normal(25, 3, 500), "same": rng.normal(0, 1, 500), "far": rng.normal(3, 1, 500),
           "near": rng.normal(0, 1, 500), "flag": [0] * 400 + [1] * 100, "few": [1, 2, 3] * 90, "js": [1] * 500}
    out = {r.feature: r for r in D.drift_table(long(spark, **ref), long(spark, **cur), D.BY_SIZE).collect()}
    assert {k: v.stattest for k, v in out.items()} == {
        "ks": "ks", "same": "ks", "far": "wasserstein", "near": "wasserstein", "flag": "z", "few": "chisquare", "js": "jensenshannon"}
    assert {k for k, v in out.items() if v.drift_detected} == {"ks", "far", "flag", "js"}
    assert out["few"].drift_score == pytest.approx(1.0) and out["ks"].severity == "CRITICAL"
    z = (0.5 - 0.2) / math.sqrt(0.35 * 0.65 * (2 / 500))
    assert out["flag"].drift_score == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-9)


def test_named_tests_do_not_depend_on_size(spark):
    rng = np.random.default_rng(1)
    for n in (500, 1500):
        ref, cur = {"a": rng.normal(0, 1, n), "b": rng.normal(0, 1, n)}, {"a": rng.normal(3, 1, 500), "b": rng.normal(3, 1, 500)}
        out = D.drift_table(long(spark, **ref), long(spark, **cur), {"a": "ks"}).collect()
        assert {r.feature: r.stattest for r in out} == {"a": "ks", "b": "wasserstein"} and all(r.drift_detected for r in out)
    with pytest.raises(ValueError, match="unknown test"):
        D.drift_table(long(spark, **ref), long(spark, **cur), "guess")


def test_missing_and_empty_columns_are_skipped(spark):
    a = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    b = spark.createDataFrame([(1.0,), (2.0,)], "b double")
    assert drift.feature_drift(a, b, ["a"]).count() == 0
    empty = drift.dataset_drift(drift.feature_drift(a, b, ["a"])).first()
    assert (empty.dataset_drift, empty.n_drifted_columns, empty.share_drifted_columns) == (False, 0, 0.0)
    nothing = spark.createDataFrame([(None,)], "residual double")
    assert drift.residual_drift(nothing, nothing, "residual").first().severity == "OK"


def test_residual_drift_is_found(spark):
    rng = np.random.default_rng(3)
    ref = spark.createDataFrame([(float(v),) for v in rng.normal(0, 0.05, 500)], "e double")
    cur = spark.createDataFrame([(float(v),) for v in rng.normal(0.3, 0.05, 500)], "e double")
    assert drift.residual_drift(ref, cur, "e").first().drift_detected


@pytest.mark.parametrize("severities, days, live, base, urgency, n", [
    ([], 1, None, None, "NONE", 0),
    (["CRITICAL"], 1, None, None, "URGENT", 1),
    (["WARNING"] * 3, 1, None, None, "NONE", 0),
    (["WARNING"] * 4, 1, None, None, "SCHEDULED", 1),
    (["OK"] * 10, 1, 1.2, 1.0, "URGENT", 1),
    (["OK"], 1, 1.1, 1.0, "NONE", 0),
    (["OK"], 1, 1.1, 0.0, "NONE", 0),
    (["OK"], 30, None, None, "SCHEDULED", 1),
    (["CRITICAL"] + ["WARNING"] * 4, 31, 2.0, 1.0, "URGENT", 4),
])
def test_retrain_decision(spark, severities, days, live, base, urgency, n):
    df = spark.createDataFrame([(s,) for s in severities], "severity string")
    lit = lambda v: None if v is None else F.lit(v)
    out = drift.retrain_decision(df, F.lit(days), lit(live), lit(base)).first()
    assert (out.urgency, len(out.reasons), out.should_retrain) == (urgency, n, n > 0)
    if live == 1.2:
        assert out.reasons == ["live MAE is 20.0% worse than at training time (threshold 15%)"]


def test_usable_columns(spark):
    ref = spark.createDataFrame([("1", None, "x")], "a string, b string, c string")
    got = drift.usable_columns(ref, ref, ["a", "b", "c", "d"]).collect()
    assert [r.feature for r in got] == ["a"]
