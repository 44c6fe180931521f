import itertools
import math
import re
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.functions import expressions as X
from slotwise.operators import attribution, models, registry, rules, scoring, split
from tests.helpers import assert_close, at, panel, rows

CFG = SeriesConfig(lag_steps=(1, 48), rolling_windows=(4,), block_slots=100)


def brute_split(pdf, val, test, purge):
    known = pdf.dropna(subset=["consumption_kwh"])
    t = np.sort(known.timestamp.unique())
    v, e = t[int(len(t) * (1 - test - val))], t[int(len(t) * (1 - test))]
    label = np.where(known.timestamp < v, "train", np.where(known.timestamp < e, "val", "test"))
    known = known.assign(split=label)
    back = known.groupby(["household_id", "split"]).timestamp.rank(ascending=False)
    return known[(known.split == "test") | (back > purge)]


@pytest.mark.parametrize("val, test", [(0.15, 0.15), (0.2, 0.2), (0.1, 0.3)])
def test_split_equals_brute_force(spark, val, test):
    df, pdf = panel(spark, n=400, holes=0.2)
    out = rows(split.chronological_split(df, CFG, val, test), "seq")
    expected = brute_split(pdf, val, test, 48).sort_values("seq")
    assert out.seq.tolist() == expected.seq.tolist()
    assert out.split.tolist() == expected.split.tolist()


def test_purge_gap_and_short_entities(spark):
    df, _ = panel(spark, n=400, holes=0)
    short = df.filter("household_id = 'HH0' OR seq % 400 > 390")
    out = rows(split.chronological_split(short, CFG, 0.2, 0.2), "seq")
    t = out[out.household_id == "HH0"].groupby("split").timestamp
    assert t.min()["val"] - t.max()["train"] > pd.Timedelta("24h")
    assert set(out[out.household_id == "HH1"].split) == {"test"}


def test_imputation_uses_train_medians_only(spark):
    df, pdf = panel(spark, n=60, holes=0.3)
    train = F.col("seq") % 60 < 30
    out = rows(split.median_impute(df, ["consumption_kwh"], train), "seq")
    m = pdf[pdf.seq % 60 < 30].consumption_kwh.median()
    assert_close(out.consumption_kwh, pdf.consumption_kwh.fillna(m))


def test_baseline_falls_back_in_order(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "household_id string, consumption_kwh double")
    df = spark.createDataFrame(
        [(0, "a", 7.0, 5.0), (1, "a", None, 5.0), (2, "a", None, None), (3, "zz", None, None)],
        "seq int, household_id string, lag_336 double, lag_48 double",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    out = rows(models.baseline_predict(df, models.entity_means(train)), "seq")
    assert out.prediction.tolist() == [7.0, 5.0, 2.0, 6.0]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (0.0, 0.5)], "consumption_kwh double, prediction double")
    m = models.metrics(df).first()
    assert (m.mae, m.rmse, m.n_samples) == (0.625, pytest.approx(math.sqrt(2.25 / 4)), 4)
    assert m.mape == pytest.approx((1 + 1 / 3 + 0.5 / 1e-3) / 4 * 100)
    gain = lambda b, v: spark.range(1).select(X.relative_improvement(F.lit(b), F.lit(v))).first()[0]
    assert (gain(1.0, 0.5), gain(1.0, 2.0), gain(0.0, 2.0)) == (50.0, -100.0, 0.0)


def linear_frame(spark, n=200):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (n, 3))
    y = 2 * x[:, 0] + 0.5 * x[:, 1] - 1.2 * x[:, 2] + 0.1
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "x1": x[:, 0], "x2": x[:, 1], "x3": x[:, 2], "y": y}))


def test_linear_fit_and_attribution_add_up(spark):
    df = linear_frame(spark)
    names = ["x1", "x2", "x3"]
    fitted = models.factories()["linear_regression"]("y").fit(models.assemble(df, names))
    score = models.LinearScore.of(fitted, names)
    assert [score.coefficients[c] for c in names] == pytest.approx([2, 0.5, -1.2])
    out = rows(attribution.linear_attributions(df, score, df).withColumn("p", score.predict()), "id")
    total = out[[f"phi_{c}" for c in names]].sum(axis=1)
    assert_close(total, out.p - out.p.mean())
    top = attribution.top_contributions(attribution.linear_attributions(df, score, df), ["id"], names, n=2)
    assert top.count() == 400 and {r["rank"] for r in top.collect()} == {1, 2}
    assert attribution.global_importance(attribution.linear_attributions(df, score, df), names).first().feature == "x1"


@pytest.mark.parametrize("family", ["random_forest", "gradient_boosting", "histogram_boosting"])
def test_tree_attributions_add_up(spark, monkeypatch, family):
    monkeypatch.setattr(attribution, "PART_ROWS", 100)
    df = models.assemble(linear_frame(spark), ["x1", "x2", "x3"])
    model = models.factories(trees=3, rounds=3)[family]("y").fit(df)
    out = rows(attribution.tree_attributions(df, model, ["x1", "x2", "x3"], ["id"]), "id")
    p = rows(model.transform(df), "id").prediction
    assert_close(out[["phi_x1", "phi_x2", "phi_x3"]].sum(axis=1) + out.expected_value, p, 1e-8)


def test_history_becomes_a_request(spark):
    """Bounded by look-back and recent mean, whatever the length of the history."""
    df, pdf = panel(spark, n_households=2, n=900, holes=0.1)
    cfg = SeriesConfig(lag_steps=(1, 4), rolling_windows=(8,))
    asked = scoring.history_requests(df, 24, cfg, F.lit(5.0))
    for r in asked.collect():
        own = pdf[(pdf.household_id == r.household_id) & pdf.consumption_kwh.notna()].sort_values("timestamp")
        assert r.forecast_timestamp == own.timestamp.iloc[-1].to_pydatetime() + timedelta(hours=24) and r.temperature_c == 5.0
        assert [x.consumption_kwh for x in r.recent_readings] == own.consumption_kwh.tail(48).tolist()
    near = scoring.history_requests(df, 1, SeriesConfig(lag_steps=(96,), rolling_windows=())).first()
    assert len(near.recent_readings) > 48 and near.temperature_c is None
    x = scoring.request_features(scoring.history_requests(df, 1, cfg), cfg)
    assert x.filter("lag_4 is not null").count() > 0
    for hours in (0, 49):
        with pytest.raises(ValueError, match="horizon"):
            scoring.history_requests(df, hours)
    assert scoring.history_requests(df.filter("false"), 1).count() == 0


def test_fits_side_by_side_inherit_the_job_group(spark):
    """All families run under the caller's group; one that fails ends none of the others."""
    df = models.assemble(linear_frame(spark), ["x1", "x2", "x3"])
    seen = []

    def family(name):
        def make(label):
            seen.append((name, spark.sparkContext.getLocalProperty("spark.jobGroup.id")))
            if name == "broken":
                raise RuntimeError("no such family")
            return models.factories()["linear_regression"](label)

        return make

    spark.sparkContext.setJobGroup("fits", "side by side")
    try:
        found = models.fit_side_by_side({n: family(n) for n in ("a", "broken", "b")}, df, "y")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(seen) == [("a", "fits"), ("b", "fits"), ("broken", "fits")]
    assert str(found["broken"]) == "no such family" and list(found) == ["a", "broken", "b"]
    assert found["a"].coefficients == found["b"].coefficients


def test_leaves_are_worked_out_once_a_pattern(monkeypatch):
    x = np.asfortranarray(np.random.default_rng(5).uniform(size=(1000, 4)))
    leaf = (1.7, np.array([2, 0, 3]), np.array([0.2, -math.inf, 0.4]), np.array([math.inf, 0.7, 0.9]), np.array([0.8, 0.6, 0.45]))
    inside = ((x[:, leaf[1]] > leaf[2]) & (x[:, leaf[1]] <= leaf[3])).astype(float)
    want = np.zeros((1000, 4))
    want[:, leaf[1]] = attribution._leaf_shares(inside, leaf[4]) * leaf[0]
    sizes, plain = [], attribution._leaf_shares
    monkeypatch.setattr(attribution, "_leaf_shares", lambda inside, share: sizes.append(len(inside)) or plain(inside, share))
    for rows_ in (1000, 5):
        got = np.zeros((rows_, 4))
        attribution._add_leaf(got, x[:rows_], *leaf)
        assert_close(got, want[:rows_])
    assert sizes == [8, 5]


def nested_leaves(rng, depth, features, low=(), high=()):
    """Leaves of a random tree in order, as (value, feature, low, high, share)."""
    low, high = dict(low), dict(high)
    if not depth:
        names = sorted({*low, *high})
        ends = ([d.get(j, e) for j in names] for d, e in ((low, -math.inf), (high, math.inf)))
        return [(rng.normal(), np.array(names, int), *map(np.array, ends), rng.uniform(0.1, 0.9, len(names)))]
    j, cut = int(rng.integers(features)), float(rng.uniform(0.2, 0.8))
    left = nested_leaves(rng, depth - 1, features, low, high | {j: min(cut, high.get(j, cut))})
    return left + nested_leaves(rng, depth - 1, features, low | {j: max(cut, low.get(j, cut))}, high)


@pytest.mark.parametrize("n", [2000, 40])
def test_leaves_next_to_each_other_are_looked_up_together(monkeypatch, n):
    rng = np.random.default_rng(3)
    leaves = nested_leaves(rng, 5, 4)
    x = np.asfortranarray(rng.uniform(size=(n, 4)).round(2))
    x[::9, 2] = np.nan
    want, got = np.zeros(x.shape), np.zeros(x.shape, order="F")
    for leaf in leaves:
        attribution._add_leaf(want, x, *leaf)
    one_by_one, plain = [], attribution._add_leaf
    monkeypatch.setattr(attribution, "_add_leaf", lambda *a: one_by_one.append(1) or plain(*a))
    monkeypatch.setattr(attribution, "STEP_ROWS", 512)
    rows_ = attribution.Coded(x, leaves)
    for at in range(0, len(leaves), attribution.MERGED):
        attribution._add_leaves(got, rows_, leaves[at: at + attribution.MERGED])
    assert np.abs(got - want).max() < 1e-12 and not one_by_one
    few = np.zeros((3, 4), order="F")
    attribution._add_leaves(few, attribution.Coded(x[:3], leaves[:2]), leaves[:2])
    direct = np.zeros((3, 4))
    for leaf in leaves[:2]:
        plain(direct, x[:3], *leaf)
    assert np.abs(few - direct).max() < 1e-12 and one_by_one


def test_many_parts_of_the_rows_need_few_groups_of_trees(spark, monkeypatch):
    df = models.assemble(linear_frame(spark), ["x1", "x2", "x3"])
    model = models.factories(trees=6)["random_forest"]("y").fit(df)
    explained = {}
    for units in (128, 8):
        monkeypatch.setattr(attribution, "PART_ROWS", 50)
        monkeypatch.setattr(attribution, "UNITS", units)
        out = attribution.tree_attributions(df, model, ["x1", "x2", "x3"], ["id"])
        copies = re.findall(r"sequence\(0, (\d+)", out._jdf.queryExecution().logical().toString())
        explained[units] = copies, rows(out, "id")
    assert explained[128][0] != explained[8][0] and "1" in explained[8][0]
    assert_close(explained[128][1].drop(columns="id"), explained[8][1].drop(columns="id"))


def test_leaf_shares_equal_the_definition():
    """Shapley values of one leaf by enumerating all coalitions."""
    rng = np.random.default_rng(2)
    shares, inside = rng.uniform(0.1, 0.9, 4), rng.integers(0, 2, (6, 4)).astype(float)
    got = attribution._leaf_shares(inside, shares)
    for row, phi in zip(inside, got):
        worth = lambda s: math.prod(row[j] if j in s else shares[j] for j in range(4))
        for i in range(4):
            others = [j for j in range(4) if j != i]
            value = sum(
                math.factorial(len(s)) * math.factorial(3 - len(s)) / math.factorial(4) * (worth({*s, i}) - worth(set(s)))
                for k in range(4) for s in itertools.combinations(others, k)
            )
            assert phi[i] == pytest.approx(value)


VERSIONS = "model_name string, version int, stage string, mae double"


def versions(spark):
    return spark.createDataFrame(
        [("a", 1, "Production", 0.1), ("a", 2, "None", 0.5), ("b", 1, "None", 0.3), ("c", 1, "None", None)], VERSIONS)


def stages(df):
    return {(r.model_name, r.version): r.stage for r in df.collect()}


def test_champion_takes_latest_versions_only(spark):
    best = registry.champion(versions(spark)).first()
    assert (best.model_name, best.version) == ("b", 1)
    assert registry.best_run(versions(spark)).first().mae == 0.1


def test_promotion_keeps_one_production_row(spark):
    out = registry.promote(versions(spark))
    assert stages(out) == {("a", 1): "Archived", ("a", 2): "None", ("b", 1): "Production", ("c", 1): "None"}
    assert registry.production_row(out).first().model_name == "b"
    again = registry.promote(out, "a", 2)
    assert [k for k, s in stages(again).items() if s == "Production"] == [("a", 2)]
    assert registry.promote(versions(spark), dry_run=True).first().stage == "None"
    moved = registry.transition_stage(versions(spark), F.lit("a"), F.lit(2), "Production")
    assert stages(moved)[("a", 1)] == "Archived"


def test_registry_errors(spark):
    with pytest.raises(ValueError):
        registry.transition_stage(versions(spark), F.lit("a"), F.lit(1), "Live")
    with pytest.raises(Exception, match="no version is in Production"):
        registry.production_row(versions(spark).filter("version = 2")).collect()
    twice = versions(spark).withColumn("stage", F.lit("Production"))
    with pytest.raises(Exception, match="several versions"):
        registry.production_row(twice).collect()
    with pytest.raises(Exception, match="to promote"):
        registry.promote(versions(spark).filter("mae IS NULL")).collect()


def test_versions_are_numbered_per_model(spark):
    out = registry.append_version(versions(spark), {"model_name": "a", "stage": "None", "mae": 0.2})
    out = registry.append_version(out, {"model_name": "new", "stage": "None", "mae": 0.2})
    assert ("a", 3) in stages(out) and ("new", 1) in stages(out)


@pytest.mark.parametrize("hour, hd, predicted, recent, titles, savings", [
    (18, 0.0, 1.0, 0.9, [rules.SHIFT_TITLE], [0.15]),
    (10, 10.0, 0.5, 0.5, [rules.COLD_TITLE], [0.5]),
    (10, 0.0, 2.0, 1.0, [rules.ABOVE_TITLE], [1.0]),
    (10, 0.0, 2.0, 0.0, [rules.NONE_TITLE], [0.0]),
    (20, 9.0, 3.0, 1.0, [rules.SHIFT_TITLE, rules.COLD_TITLE, rules.ABOVE_TITLE], [0.45, 0.45, 2.0]),
    (21, 8.0, 0.85, 0.85, [rules.NONE_TITLE], [0.0]),
])
def test_recommendations(spark, hour, hd, predicted, recent, titles, savings):
    df = spark.createDataFrame([(hour, hd, predicted, recent)], "hour int, heating_degree double, predicted_consumption_kwh double, recent_mean_kwh double")
    out = rows(rules.recommendations(df), "position")
    assert out.title.tolist() == titles and out.estimated_saving_kwh.tolist() == pytest.approx(savings)


def request(spark, n=400):
    due = at("2024-01-15 18:00")
    readings = [(at("2024-01-15 18:00", -30 * i), 0.5 + 0.1 * (i % 3)) for i in range(n, 0, -1)]
    schema = ("household_id string, forecast_timestamp timestamp_ntz, temperature_c double,"
              " recent_readings array<struct<timestamp: timestamp_ntz, consumption_kwh: double>>")
    return spark.createDataFrame([("HH000", due, 5.0, readings)], schema), readings


def test_request_features_equal_the_series_features(spark):
    req, readings = request(spark)
    x = scoring.request_features(req).first()
    s = pd.Series([v for _, v in readings])
    assert [x.lag_1, x.lag_2, x.lag_48, x.lag_336] == pytest.approx([s.iloc[-k] for k in (1, 2, 48, 336)])
    assert x.roll_mean_48 == pytest.approx(s.iloc[-48:].mean()) and x.roll_std_336 == pytest.approx(s.iloc[-336:].std())
    assert (x.hour, x.heating_degree, x.day_of_week) == (18, 13.0, 0)


def test_scoring_pads_unknown_features_and_survives_no_history(spark):
    req, _ = request(spark, 0)
    model = models.LinearScore({"lag_1": 1.0, "humidity_pct": 5.0, "heating_degree": 0.1}, 0.2)
    out = scoring.score_requests(req, model, list(model.coefficients)).first()
    assert out.predicted_consumption_kwh == pytest.approx(1.5)
    inputs = scoring.rule_inputs(req, scoring.score_requests(req, model, list(model.coefficients))).first()
    assert (inputs.hour, inputs.recent_mean_kwh, inputs.is_weekend) == (18, 0.0, False)


def test_recent_mean_takes_the_last_48(spark):
    req, readings = request(spark, 100)
    got = req.select(scoring.recent_mean(F.col("recent_readings"))).first()[0]
    assert got == pytest.approx(np.mean([v for _, v in readings[-48:]]))


def test_train_and_compare_names_a_champion(spark):
    rng = np.random.default_rng(0)
    parts = []
    for h in range(2):
        t = pd.date_range("2024-01-01", periods=500, freq="30min")
        y = 1 + 0.3 * np.sin(np.arange(500) / 48 * 2 * np.pi) + rng.normal(0, 0.05, 500)
        parts.append(pd.DataFrame({"timestamp": t.astype(str), "household_id": f"HH{h}", "consumption_kwh": y, "lag_1": pd.Series(y).shift(1), "lag_48": pd.Series(y).shift(48)}))
    df = spark.createDataFrame(pd.concat(parts)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("lag_1", "lag_48")})
    families = {k: v for k, v in models.factories().items() if k == "linear_regression"}
    table, fitted = models.train_and_compare(df, ["lag_1", "lag_48"], CFG, families, 0.2, 0.2)
    out = {r.model: r for r in table.collect()}
    assert out["linear_regression"].is_champion and not out["baseline"].is_champion
    assert out["baseline"].mae < 1 and set(fitted) == {"linear_regression"}


def test_equal_requests_are_answered_each(spark):
    from slotwise.operators import scoring

    history = [{"timestamp": at("2024-01-01", 30 * i), "consumption_kwh": float(i)} for i in range(20)]
    due = at("2024-01-01", 600)
    rows_in = [("a", due, 5.0, history), ("a", due, 5.0, history), ("a", due, 9.0, history)]
    requests = spark.createDataFrame(rows_in, "household_id string, forecast_timestamp timestamp_ntz, temperature_c double, recent_readings array<struct<timestamp: timestamp_ntz, consumption_kwh: double>>")
    model = models.LinearScore({"lag_1": 1.0, "heating_degree": 0.1}, 0.0)
    got = scoring.score_requests(requests, model, ["lag_1", "heating_degree"])
    assert sorted(r.predicted_consumption_kwh for r in got.collect()) == pytest.approx([19.9, 20.3, 20.3])
    numbered = requests.coalesce(1).withColumn("request_id", F.monotonically_increasing_id())
    forecasts = scoring.score_requests(numbered, model, ["lag_1", "heating_degree"])
    inputs = scoring.rule_inputs(numbered, forecasts)
    assert inputs.count() == 3 and inputs.select("request_id").distinct().count() == 3


def test_lifecycle(spark, folder):
    """Runs with status, versions with saved models, promotion, serving and retraining."""
    from slotwise.operators import lifecycle

    df, _ = panel(spark, n_households=2, n=400, holes=0.1)
    df = df.withColumn("lag_1", F.coalesce(F.col("consumption_kwh") * 0.5, F.lit(1.0)))
    cfg = SeriesConfig(lag_steps=(1,), rolling_windows=(4,), block_slots=100)

    def broken(_):
        raise RuntimeError("no such family")

    families = {"linear_regression": models.factories()["linear_regression"], "broken": broken}
    store = lifecycle.ModelStore(spark, f"{folder}/models")
    runs = {r.model_name: r for r in store.train(df, ["lag_1"], cfg, families).collect()}
    assert runs["linear_regression"].status == "FINISHED" and runs["linear_regression"].metrics["mae"] < 1e-6
    assert runs["broken"].status == "FAILED" and "no such family" in runs["broken"].error
    row = store.versions().first()
    assert (row.version, row.stage, row.feature_columns) == (1, "Staging", ["lag_1"]) and row.data_hash
    with pytest.raises(Exception, match="Production"):
        store.production().collect()
    assert store.promote().first().version == 1
    due = at("2024-01-05")
    history = [{"timestamp": at("2024-01-04", 23 * 60 + 30), "consumption_kwh": 3.0}]
    requests = spark.createDataFrame([("HH0", due, 5.0, history)], "household_id string, forecast_timestamp timestamp_ntz, temperature_c double, recent_readings array<struct<timestamp: timestamp_ntz, consumption_kwh: double>>")
    served = store.serve(requests, cfg).first()
    assert served.predicted_consumption_kwh == pytest.approx(6.0, abs=1e-3) and served.version == 1
    decide = lambda yes: spark.createDataFrame([(yes, "URGENT")], "should_retrain boolean, urgency string")
    assert store.retrain(decide(False), df, ["lag_1"], cfg, families=families).first().version == 1
    after = store.retrain(decide(True), df, ["lag_1"], cfg, families=families).first()
    assert (after.version, after.retrained) == (2, True)
    assert sorted(r.stage for r in store.versions().collect()) == ["Archived", "Production"] and store.runs().count() == 4


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark):
    forest = models.factories(trees=3)["random_forest"]("y")
    assert forest.getCacheNodeIds()
    raw = spark.range(400).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    x = models.assemble(raw.withColumn("y", F.col("a") * F.col("b")), ["a", "b"])
    assert forest.fit(x).toDebugString.split("\n")[1:] == forest.copy().setCacheNodeIds(False).fit(x).toDebugString.split("\n")[1:]


def test_prepared_rows_are_split_once(spark):
    """Medians and result read the written split; neither plans its windows again."""
    start = datetime(2024, 1, 1)
    data = [("a" if i % 2 else "b", start + timedelta(hours=i), float(i % 7), None if i % 3 else float(i)) for i in range(200)]
    df = spark.createDataFrame(data, "household_id string, timestamp timestamp_ntz, consumption_kwh double, lag_1 double")
    cfg = SeriesConfig(freq_minutes=60, lag_steps=(1, 2), rolling_windows=(4,))
    out = models.prepare(df, ["lag_1"], cfg)
    assert "row_number" not in out._jdf.queryExecution().executedPlan().toString()
    known = split.chronological_split(df, cfg)
    assert out.count() == known.count() > 0
    median = known.filter("split = 'train'").agg(F.median("lag_1")).first()[0]
    assert {r.lag_1 for r in out.collect()} == {r.lag_1 if r.lag_1 is not None else median for r in known.collect()}


def test_retraining_reads_the_stored_features_once(spark, monkeypatch):
    from slotwise.plans import queries as Q

    made, real = [], Q.fx.stored_features
    monkeypatch.setattr(Q.fx, "stored_features", lambda *a: made.append(1) or real(*a))
    monkeypatch.setattr(Q, "_families", lambda: {k: v for k, v in models.factories().items() if k == "linear_regression"})
    out = Q.QUERIES["retrain_job"](spark, "/root/testdata/sf0.001").first()
    assert len(made) == 1 and out.version == (2 if out.retrained else 1)
