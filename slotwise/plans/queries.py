"""One query per operator over the given tables. Each takes (spark, folder)."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions import expressions as X
from slotwise.functions.timegrid import to_local_time
from slotwise.operators import attribution as A
from slotwise.operators import cleaning, drift, features, grid, joins, lifecycle, models, quality, registry, rules, scoring, split
from slotwise.operators import distribution as D
from slotwise.operators.leafwise import LeafwiseRegressor
from slotwise.plans import fixtures as fx
from slotwise.session import shared_dir, written
from slotwise.sources import publish, readers, store
from slotwise.streaming import adwin, buffers, live, monitor, pairing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Exact decimal ties, such as the mean of sixteen short decimals, are rounded up by one
# engine and may be down by another; this offset decides them alike.
TIE = 1.3e-10


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Doubles to few digits for the comparison."""

    def one(name: str) -> Column:
        return F.round(F.col(name) + TIE, digits).alias(name)

    return df.select(*[one(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


# --- sources -------------------------------------------------------------------------


@query
def scan_csv(spark, d):
    path = shared_dir(spark, "csv")
    store.write_csv(fx.meter_raw(spark, d).drop("seq"), path)
    return readers.read_csv(spark, path, "timestamp timestamp_ntz, household_id string, consumption_kwh double, is_real_data boolean")


@query
def scan_archive(spark, d):
    path = shared_dir(spark, "archive")
    rows = fx.table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"), "user_id", "value")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One archive per batch of rows, with a member of another year beside the wanted one.
        for frame in frames:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("data/2024_UTC.csv", frame.to_csv(index=False))
                z.writestr("data/2023_UTC.csv", "Timestamp,value\n2023-01-01,1\n")
                z.writestr("readme.txt", "2024")
            yield pd.DataFrame({"key": [int(frame["event_id"].iloc[0])], "content": [buffer.getvalue()]})

    zips = rows.mapInPandas(pack, "key bigint, content binary")

    def save(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.makedirs(path.removeprefix("file:"), exist_ok=True)
        for frame in frames:
            for key, content in zip(frame["key"], frame["content"]):
                with open(f"{path.removeprefix('file:')}/part-{key}.zip", "wb") as f:
                    f.write(content)
            yield frame[["key"]]

    zips.mapInPandas(save, "key bigint").write.format("noop").mode("overwrite").save()
    text = readers.read_archive(spark, path, 2024, ["event_id", "timestamp", "value"])
    parsed = readers.parse_lenient(text, "timestamp", "value")
    return parsed.select(F.col("event_id").cast("bigint").alias("event_id"), "timestamp", "value")


@query
def scan_resolve_columns(spark, d):
    foreign = fx.table(spark, d, "events").select(
        F.col("event_id"), F.col("ts").alias(" DateTime "), F.to_date("ts").alias("Date"),
        F.col("value").alias("Energy"), (F.col("value") / 10).alias("KWH "),
    )
    return readers.select_roles(foreign)


@query
def scan_json_arrays(spark, d):
    path = shared_dir(spark, "payloads")
    hours = fx.weather_raw(spark, d)
    row = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("t"), "temperature_c", "humidity_pct",
        (F.col("wind_speed_ms") * 3.6).alias("wind"),
    )
    # A day has at most 24 hours, which bounds the arrays.
    days = hours.groupBy(F.to_date("timestamp").alias("day")).agg(F.array_sort(F.collect_list(row)).alias("x"))
    days.select(
        F.struct(
            F.col("x.t").alias("time"), F.col("x.temperature_c").alias("temperature_2m"),
            F.col("x.humidity_pct").alias("relative_humidity_2m"), F.col("x.wind").alias("wind_speed_10m"),
        ).alias("hourly")
    ).write.option("ignoreNullFields", "false").option("maxRecordsPerFile", 1).json(path)
    return rounded(readers.read_weather_payloads(spark, path))


@query
def parse_lenient(spark, d):
    e = fx.table(spark, d, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = e.select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, "not a time").when(F.col("event_id") % 13 == 0, F.concat(stamp, F.lit("+01:00")))
        .otherwise(stamp).alias("timestamp"),
        F.when(F.col("event_id") % 7 == 0, "n/a").when(F.col("event_id") % 17 == 0, F.concat(F.lit("-"), (F.col("value") + 1).cast("string")))
        .otherwise(F.col("value").cast("string")).alias("consumption_kwh"),
    )
    return readers.parse_lenient(text)


@query
def filter_range(spark, d):
    e = fx.table(spark, d, "events").select("event_id", F.col("ts").alias("timestamp"), "value")
    return readers.in_range(e, fx.ntz("2024-01-05 06:30:00"), fx.ntz("2024-01-21"))


@query
def calendar_dim(spark, d):
    return fx.calendar(spark, d)


@query
def scan_fallback(spark, d):
    e = lambda name: lambda: fx.table(spark, d, name).select("event_id", "value")
    lost = readers.read_with_fallback(e("events_that_are_not_there"), e("events"))
    found = readers.read_with_fallback(e("events"), e("orders"))
    off = readers.read_with_fallback(e("orders"), e("events"), use_real=False)
    parts = [p.withColumn("case", F.lit(n)) for n, p in (("lost", lost), ("found", found), ("off", off))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def union_populations(spark, d):
    m = fx.meter_raw(spark, d).select("seq", "timestamp", "household_id", "consumption_kwh", "is_real_data")
    real = m.filter("is_real_data")
    peers = m.filter("NOT is_real_data").drop("is_real_data")
    return readers.union_populations(real, peers, "household_id", "HH_REAL_000")


@query
def time_index(spark, d):
    span = fx.table(spark, d, "events").agg(
        F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("lo"),
        F.timestamp_add("DAY", F.lit(1), F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).alias("hi"),
    )
    return grid.time_index(span, "lo", "hi", 30 * 60_000_000)


# --- store ---------------------------------------------------------------------------


@query
def features_read(spark, d):
    saved = store.FeatureStore(spark, shared_dir(spark, "features"))
    saved.write_features(fx.features(spark, d), fx.GRID)
    return rounded(saved.read_features(["lag_1", "roll_mean_4", "consumption_kwh"]))


@query
def features_manifest(spark, d):
    saved = store.FeatureStore(spark, shared_dir(spark, "features"))
    m = saved.write_features(fx.features(spark, d), fx.GRID)
    return m.select("n_rows", F.col("n_features").cast("bigint").alias("n_features"), F.array_join(F.array_sort("feature_columns"), ",").alias("names"))


@query
def feature_names(spark, d):
    """The feature list of the latest version, as its manifest tells it."""
    saved = store.FeatureStore(spark, shared_dir(spark, "features"))
    saved.write_features(fx.features(spark, d), fx.GRID)
    names = saved.feature_names()
    table = saved.read_features(names)
    return table.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n_known")


@query
def file_manifest(spark, d):
    m = store.file_manifest(spark, [d, f"{d}/no_such_folder"])
    return m.withColumn("path", F.element_at(F.split("path", "/"), -1))


@query
def dataset_hash(spark, d):
    return store.content_hash(fx.meter_raw(spark, d))


@query
def manifest_verify(spark, d):
    now = store.file_manifest(spark, [d])
    recorded = written(now, "manifest")
    lost = now.filter(~F.col("path").endswith("events.parquet"))
    changed = now.withColumn("sha256", F.when(F.col("path").endswith("nation.parquet"), "0").otherwise(F.col("sha256")))
    cases = {"same": now, "file_lost": lost, "file_changed": changed}
    flags = [F.struct(F.lit(n).alias("case"), F.lit(store.verify_manifest(recorded, c)).alias("verified")) for n, c in cases.items()]
    none = F.struct(F.lit("no_manifest").alias("case"), F.lit(store.verify_manifest(None, now)).alias("verified"))
    files = recorded.agg(F.count(F.lit(1)).alias("n"))
    return files.select(F.inline(F.array(*flags, none)))


# --- cleaning ------------------------------------------------------------------------


@query
def dedupe_first(spark, d):
    return cleaning.dedupe_first(fx.meter_raw(spark, d), ["household_id", "timestamp"])


@query
def winsorise(spark, d):
    v = F.col("consumption_kwh")
    return fx.meter_raw(spark, d).select("seq", X.winsorise(v).alias("consumption_kwh"), X.is_winsorised(X.winsorise(v)).alias("is_winsorised"))


@query
def grid_align(spark, d):
    return grid.align_to_grid(fx.meter_hourly(spark, d).drop("is_real_data"), fx.HOURLY)


@query
def fill_provenance(spark, d):
    aligned = grid.align_to_grid(fx.meter_hourly(spark, d).drop("consumption_kwh"), fx.HOURLY)
    return cleaning.fill_provenance(aligned, cfg=fx.HOURLY)


@query
def ffill_limit(spark, d):
    return rounded(cleaning.forward_fill(fx.grid(spark, d), fx.GRID))


@query
def clean_meter(spark, d):
    return rounded(cleaning.clean_meter(fx.meter_hourly(spark, d), fx.HOURLY))


@query
def cleaning_counters(spark, d):
    raw = fx.meter_hourly(spark, d)
    return cleaning.cleaning_counters(raw, cleaning.clean_meter(raw, fx.HOURLY))


@query
def interpolate_time(spark, d):
    return rounded(cleaning.interpolate_time(fx.weather_raw(spark, d), fx.WEATHER_VALUES).drop("seq"))


@query
def clean_calendar(spark, d):
    days = fx.calendar(spark, d).withColumn("seq", F.dayofyear("date").cast("bigint"))
    later = days.withColumns({"seq": F.col("seq") + 1000, "is_weekend": ~F.col("is_weekend"), "is_holiday": F.lit(True)})
    return cleaning.clean_calendar(later.unionByName(days)).select(F.col("date").cast("string").alias("date"), "day_of_week", "is_weekend", "is_holiday")


@query
def table_round_trip(spark, d):
    """Raw and cleaned tables written by day and read back."""
    parts = []
    for name, rows in (("raw", fx.meter_raw(spark, d)), ("cleaned", cleaning.clean_meter(fx.meter_hourly(spark, d), fx.HOURLY))):
        path = shared_dir(spark, name)
        store.write_table(rows, path)
        back = spark.read.parquet(path)
        day = back.groupBy(F.lit(name).alias("table"), F.col("dt").cast("string").alias("day"))
        parts.append(day.agg(F.count(F.lit(1)).alias("n_rows"), F.count("consumption_kwh").alias("n_known"), F.sum("consumption_kwh").alias("total")))
    return rounded(parts[0].unionByName(parts[1]), 6)


@query
def clean_weather(spark, d):
    twice = fx.weather_raw(spark, d)
    copies = twice.withColumns({"seq": F.col("seq") + 1000000000, "temperature_c": F.lit(99.0)})
    return rounded(cleaning.clean_weather(twice.unionByName(copies), fx.WEATHER_VALUES).drop("seq"))


@query
def resample_sum(spark, d):
    return rounded(grid.resample_sum(fx.readings(spark, d), fx.GRID))


@query
def resample_mean_last(spark, d):
    raw = fx.meter_raw(spark, d).withColumn(
        "is_real_data", F.when(F.col("seq") % 3 != 0, (F.col("seq") % 2 == 0))
    )
    out = grid.resample_mean_last(raw, fx.GRID, lasts=["is_real_data"])
    return rounded(out.withColumn("is_real_data", F.col("is_real_data").cast("string")))


# --- joins ---------------------------------------------------------------------------


@query
def asof_join(spark, d):
    left = fx.readings(spark, d).select("seq", "household_id", "timestamp")
    out = joins.asof_join(left, fx.weather_raw(spark, d), fx.WEATHER_VALUES, ["household_id"], matched="weather_at")
    return rounded(out)


@query
def asof_join_merge(spark, d):
    left = fx.readings(spark, d).select("seq", "household_id", "timestamp")
    out = joins.asof_join(left, fx.weather_raw(spark, d), fx.WEATHER_VALUES, ["household_id"], matched="weather_at", plan="merge")
    return rounded(out)


@query
def join_calendar(spark, d):
    m = fx.meter_raw(spark, d).select("seq", "timestamp")
    return joins.join_calendar(m, fx.calendar(spark, d))


@query
def merge_sources(spark, d):
    clean = cleaning.forward_fill(fx.grid(spark, d), fx.GRID)
    flagged = clean.withColumn("is_real_data", F.lit(True))
    return rounded(joins.merge_sources(flagged, fx.weather(spark, d), fx.calendar(spark, d), fx.GRID).drop("day_of_week"))


@query
def merge_counters(spark, d):
    """Rows and unmatched weather, counted by the job that writes the merged table."""
    clean = cleaning.forward_fill(fx.grid(spark, d), fx.GRID).withColumn("is_real_data", F.lit(True))
    merged, counters = joins.observed_merge(joins.merge_sources(clean, fx.weather(spark, d), fx.calendar(spark, d), fx.GRID))
    written(merged, "merged")
    found = counters.get
    return spark.createDataFrame([(found["n_rows"], found["n_unmatched_weather"])], "n_rows bigint, n_unmatched_weather bigint")


# --- features ------------------------------------------------------------------------


@query
def degree_features(spark, d):
    return rounded(features.add_degree_features(fx.weather_raw(spark, d).select("timestamp", "temperature_c")))


@query
def calendar_features(spark, d):
    # A calendar without the days whose number 9 divides: their flags are unknown.
    flagged = joins.join_calendar(fx.grid(spark, d), fx.calendar(spark, d).filter("day(date) % 9 <> 0"))
    return rounded(features.add_calendar_features(flagged.drop("consumption_kwh")))


@query
def lag_features(spark, d):
    return rounded(features.add_lag_features(fx.grid(spark, d), fx.GRID))


@query
def rolling_mean(spark, d):
    out = features.add_rolling_features(fx.grid(spark, d), fx.GRID)
    return rounded(out.select("household_id", "timestamp", "roll_mean_4", "roll_mean_28"))


@query
def rolling_std(spark, d):
    out = features.add_rolling_features(fx.grid(spark, d), fx.GRID)
    return rounded(out.select("household_id", "timestamp", "roll_std_4", "roll_std_28"))


@query
def lag_features_default(spark, d):
    return rounded(features.add_lag_features(fx.grid(spark, d, DEFAULT)))


@query
def rolling_default(spark, d):
    """Both windows of the default grid over values that are not clipped."""
    raw = grid.resample_mean_last(cleaning.dedupe_first(fx.meter_raw(spark, d), ["household_id", "timestamp"]), DEFAULT, order=())
    out = features.add_rolling_features(raw)
    return rounded(out.select("household_id", "timestamp", *[f"roll_{m}_{w}" for w in DEFAULT.rolling_windows for m in ("mean", "std")]))


@query
def build_features(spark, d):
    return rounded(fx.features(spark, d))


@query
def pipeline_features(spark, d):
    return rounded(fx.pipeline_features(spark, d))


@query
def feature_projection(spark, d):
    f = fx.features(spark, d).withColumns({"was_missing": F.lit(False), "is_real_meter_data": F.lit(True)})
    names = features.feature_columns(f.columns)
    return f.agg(*[F.count(c).alias(c) for c in names])


# --- split, baseline, metrics --------------------------------------------------------


@query
def chrono_split(spark, d):
    f = fx.stored_features(spark, d).select("household_id", "timestamp", "consumption_kwh")
    return split.chronological_split(f, fx.GRID).select("household_id", "timestamp", "split")


@query
def purge_tail(spark, d):
    f = fx.stored_features(spark, d).select("household_id", "timestamp", "consumption_kwh")
    rows = split.purge_tail(split.label_split(f, fx.GRID), fx.GRID, rows=7)
    return rows.groupBy("household_id", "split").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("last"))


IMPUTED = ("lag_1", "lag_4", "roll_mean_4", "temperature_c")


@query
def median_impute(spark, d):
    labelled = split.label_split(fx.stored_features(spark, d), fx.GRID)
    out = split.median_impute(labelled, IMPUTED, F.col("split") == "train")
    return rounded(out.select("household_id", "timestamp", "split", *IMPUTED))


@query
def baseline_predict(spark, d):
    s = split.chronological_split(fx.stored_features(spark, d), fx.GRID)
    means = models.entity_means(s.filter("split = 'train'"), fx.GRID)
    val = s.filter("split <> 'train'").select("household_id", "timestamp", "split", "lag_28", "lag_4")
    out = models.baseline_predict(val, means, fx.GRID, lags=("lag_28", "lag_4"))
    return rounded(out.select("household_id", "timestamp", "split", "prediction"))


@query
def error_metrics(spark, d):
    return rounded(models.metrics(fx.predictions(spark, d), by=["l_returnflag"]))


@query
def relative_improvement(spark, d):
    p = fx.predictions(spark, d)
    err = lambda c: F.avg(F.abs(F.col("consumption_kwh") - c))
    both = p.groupBy("l_returnflag").agg(err(F.lit(25.0)).alias("base"), err(F.col("prediction")).alias("model"))
    return rounded(both.select(
        "l_returnflag", X.relative_improvement(F.col("base"), F.col("model")).alias("improvement_pct"),
        X.relative_improvement(F.lit(0.0), F.col("model")).alias("against_zero"),
    ))


@query
def provenance_share(spark, d):
    return rounded(fx.meter_raw(spark, d).agg(F.avg(F.col("is_real_data").cast("double")).alias("share_real"), F.count(F.lit(1)).alias("n")))


# --- quality -------------------------------------------------------------------------


@query
def validate_meter(spark, d):
    return quality.run_suite(fx.meter_raw(spark, d), "smart_meter")


@query
def validate_weather(spark, d):
    return quality.run_suite(fx.weather_raw(spark, d), "weather")


@query
def validate_calendar(spark, d):
    return quality.run_suite(fx.calendar(spark, d), "calendar")


@query
def gated_publish(spark, d):
    """Raw, cleaned and again raw readings behind the gate of their suite: only the cleaned ones become readable."""
    table = publish.CheckedTable(spark, shared_dir(spark, "gate"), "smart_meter")
    readable = []
    for rows in (fx.meter_raw(spark, d), fx.readings(spark, d), fx.meter_raw(spark, d)):
        table.publish(rows)
        try:
            readable.append(table.read().count())
        except LookupError:
            readable.append(0)
    seen = spark.createDataFrame(list(enumerate(readable, 1)), "version int, readable_rows bigint")
    return table.reports().join(seen, "version")


@query
def validation_summary(spark, d):
    parts = [validate_meter(spark, d), validate_weather(spark, d), validate_calendar(spark, d)]
    return quality.summary(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def gap_count(spark, d):
    return quality.gap_counts(fx.meter_raw(spark, d), "household_id")


# --- drift and decisions -------------------------------------------------------------


@query
def drift_usable_columns(spark, d):
    e = fx.table(spark, d, "events")
    shaped = e.select("ts", F.col("value").alias("v"), "props", F.when(F.col("ts") < fx.ntz(fx.DRIFT_AT), F.col("value")).alias("early"),
                      F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("user_id").cast("string")).alias("mixed"))
    ref, cur = shaped.filter(F.col("ts") < fx.ntz(fx.DRIFT_AT)), shaped.filter(F.col("ts") >= fx.ntz(fx.DRIFT_AT))
    return drift.usable_columns(ref, cur, ["v", "props", "early", "mixed", "absent"])


@query
def drift_ks(spark, d):
    stats = D.distances(D.two_sided(*fx.drift_sides(spark, d)))
    return rounded(stats.select("feature", "n_ref", "n_cur", "ks_d", "ks_p"))


@query
def drift_wasserstein(spark, d):
    ref, cur = fx.drift_sides(spark, d)
    stats = D.distances(D.two_sided(ref, cur)).join(D.reference_scale(ref), "feature")
    norm = F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(0.001))
    return rounded(stats.select("feature", "wasserstein", norm.alias("normalised")))


@query
def feature_drift(spark, d):
    out = D.drift_table(*fx.drift_sides(spark, d), fx.DRIFT_TESTS)
    return rounded(out)


@query
def dataset_drift(spark, d):
    return rounded(drift.dataset_drift(D.drift_table(*fx.drift_sides(spark, d), fx.DRIFT_TESTS)))


@query
def residual_drift(spark, d):
    li = fx.table(spark, d, "lineitem").select(
        "l_shipdate", (F.col("l_quantity") * F.col("l_discount") - F.col("l_tax")).alias("e")
    )
    cut = fx.ntz("1998-01-01")
    ref = li.filter(F.col("l_shipdate") < cut)
    cur = li.filter(F.col("l_shipdate") >= cut).withColumn("e", F.col("e") + 0.3)
    return rounded(drift.residual_drift(ref, cur, "e"))


def _severities(spark, d) -> DataFrame:
    share = F.avg((F.col("value") > 100).cast("double"))
    s = fx.table(spark, d, "events").groupBy("user_id").agg(share.alias("x"))
    return s.select(F.when(F.col("x") > 0.3, "CRITICAL").when(F.col("x") > 0.15, "WARNING").otherwise("OK").alias("severity"))


@query
def retrain_decision(spark, d):
    errors = fx.predictions(spark, d).agg(
        F.avg(F.abs(F.col("consumption_kwh") - F.col("prediction"))).alias("live"),
        F.avg(F.abs(F.col("consumption_kwh") - F.col("prediction")) * F.when(F.col("l_returnflag") == "A", 0.5).otherwise(0.9)).alias("train"),
    )
    age = fx.table(spark, d, "events").agg(F.date_diff(F.max("ts"), F.min("ts")).alias("days"))
    out = drift.retrain_decision(
        _severities(spark, d), age.scalar(), errors.select("live").scalar(), errors.select("train").scalar()
    )
    return out.select("should_retrain", F.array_join("reasons", "; ").alias("reasons"), "urgency")


@query
def drift_report(spark, d):
    table = D.drift_table(*fx.drift_sides(spark, d), fx.DRIFT_TESTS)
    found = written(adwin.batch_events(adwin.detector_input(fx.shifted(spark, d), ["consumption_kwh"])), "adwin")
    n = fx.table(spark, d, "events").agg(F.count(F.lit(1)))
    status = adwin.drift_status(found.filter("kind = 'drift'"), n)
    decision = drift.retrain_decision(table, F.lit(1))
    return drift.drift_report(table, status, decision, ("before 2024-01-21", "from 2024-01-21"))


@query
def reference_sample(spark, d):
    f = fx.stored_features(spark, d)
    key = F.concat("household_id", F.lit("|"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    return rounded(A.reference_sample(f, ["household_id", "timestamp", "temperature_c", "lag_1", "roll_mean_4"], key))


# --- models --------------------------------------------------------------------------

MODEL_FEATURES = tuple(fx.WEIGHTS.coefficients)


def _model_input(spark, d) -> DataFrame:
    return scoring.pad_and_fill(fx.stored_features(spark, d).withColumnRenamed("timestamp", "forecast_timestamp"), MODEL_FEATURES)


@query
def local_attribution(spark, d):
    x = _model_input(spark, d)
    return rounded(A.top_contributions(A.linear_attributions(x, fx.WEIGHTS, x), scoring.KEYS, MODEL_FEATURES), 6)


@query
def global_importance(spark, d):
    x = _model_input(spark, d)
    return rounded(A.global_importance(A.linear_attributions(x, fx.WEIGHTS, x), MODEL_FEATURES))


@query
def linreg_fit(spark, d):
    li = fx.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("y"), "l_quantity")
    model = models.factories()["linear_regression"]("y").fit(models.assemble(li, ["l_quantity"]))
    return rounded(li.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(float(model.coefficients[0])).alias("slope"), F.lit(float(model.intercept)).alias("intercept")), 3)


# A month is short against the purge of a week, so validation takes a larger share.
FIT_VAL = 0.35
FIT_COLUMNS = ("lag_1", "lag_2", "lag_4", "lag_28", "roll_mean_4", "roll_std_4", "hour_sin", "hour_cos",
               "dow_sin", "dow_cos", "heating_degree", "cooling_degree", "is_weekend", "is_holiday")


def _fit(spark, d, *families: str):
    chosen = {k: v for k, v in models.factories().items() if k in families}
    f = fx.stored_features(spark, d)
    return models.train_and_compare(f, FIT_COLUMNS, fx.GRID, chosen, val_share=FIT_VAL)


@query
def forest_fit(spark, d):
    return _fit(spark, d, "random_forest")[0]


@query
def gbt_fit(spark, d):
    return _fit(spark, d, "gradient_boosting")[0]


@query
def gbt_hist_fit(spark, d):
    return _fit(spark, d, "histogram_boosting")[0]


@query
def model_comparison(spark, d):
    return _fit(spark, d, "linear_regression", "random_forest", "gradient_boosting", "histogram_boosting")[0]


@query
def tree_attribution(spark, d):
    f = written(models.prepare(fx.stored_features(spark, d), FIT_COLUMNS, fx.GRID, val_share=FIT_VAL), "trees")
    model = models.factories()["random_forest"]("consumption_kwh").fit(f.filter("split = 'train'"))
    rows = f.filter("split = 'val'").select("household_id", "timestamp", *FIT_COLUMNS)
    return A.tree_attributions(rows, model, FIT_COLUMNS, ["household_id", "timestamp"])


@query
def tree_request_attribution(spark, d):
    """Contributions of a boosted ensemble to the forecasts of requests: with the expected value they add up to each forecast."""
    names = ["lag_1", "lag_4", "roll_mean_4", "hour_sin"]
    train = models.assemble(fx.stored_features(spark, d).select("consumption_kwh", *names).na.drop(), names)
    model = LeafwiseRegressor(labelCol="consumption_kwh", maxIter=3, maxLeaves=16).fit(train)
    parts = scoring.request_attributions(fx.requests(spark, d), model, names, fx.GRID)
    total = F.col("expected_value")
    for c in names:
        total = total + F.col(f"phi_{c}")
    both = parts.join(scoring.score_requests(fx.requests(spark, d), model, names, fx.GRID), ["household_id", "forecast_timestamp"])
    return both.select("household_id", "forecast_timestamp", (F.abs(total - F.col("predicted_consumption_kwh")) < 1e-4).alias("adds_up"))


@query
def leafwise_split(spark, d):
    """The first split that best-first growth makes: two leaves, one feature, every value its own bin."""
    li = fx.table(spark, d, "lineitem").select(F.col("l_extendedprice").cast("double").alias("y"), F.col("l_quantity").cast("double").alias("x"))
    settings = {"labelCol": "y", "maxIter": 1, "maxLeaves": 2, "stepSize": 1.0, "featureShare": 1.0}
    tree = LeafwiseRegressor(**settings).fit(models.assemble(li, ["x"])).tree_nodes()[0]
    _, cut, left, right, value, _ = tree
    mean = li.agg(F.avg("y")).scalar()
    return rounded(li.agg(F.count_if(F.col("x") <= cut[0]).alias("n_left")).select(
        F.lit(float(cut[0])).alias("cut"), "n_left", (mean + value[left[0]]).alias("left_value"), (mean + value[right[0]]).alias("right_value")), 4)


@query
def score_requests(spark, d):
    return scoring.score_requests(fx.requests(spark, d), fx.WEIGHTS, MODEL_FEATURES, fx.GRID)


@query
def history_forecast(spark, d):
    """Forecasts a day ahead from uploaded histories."""
    asked = scoring.history_requests(fx.readings(spark, d), 24, fx.GRID, F.lit(10.0))
    scored = scoring.score_requests(asked, fx.WEIGHTS, MODEL_FEATURES, fx.GRID)
    sizes = asked.select("household_id", F.size("recent_readings").cast("bigint").alias("n_readings"))
    return scored.drop("request_id").join(sizes, "household_id")


@query
def explain_requests(spark, d):
    return rounded(scoring.explain_requests(fx.requests(spark, d), fx.WEIGHTS, _model_input(spark, d), fx.GRID), 6)


@query
def recommendations(spark, d):
    req = fx.requests(spark, d)
    inputs = scoring.rule_inputs(req, score_requests(spark, d))
    out = rules.recommendations(inputs)
    few = out.drop("description", "recent_mean_kwh", "is_weekend", "predicted_consumption_kwh")
    return few.withColumn("heating_degree", F.round(F.col("heating_degree") + TIE, 3))


@query
def recent_mean(spark, d):
    return rounded(fx.requests(spark, d).select("household_id", scoring.recent_mean(F.col("recent_readings")).alias("recent_mean_kwh")))


# --- registry ------------------------------------------------------------------------


@query
def champion_of(spark, d):
    """The champion among some families only."""
    return rounded(registry.champion(fx.runs(spark, d), ["FRANCE", "GERMANY", "JAPAN", "BRAZIL"]))


@query
def best_run(spark, d):
    return rounded(registry.best_run(fx.runs(spark, d)))


@query
def champion(spark, d):
    return rounded(registry.champion(fx.runs(spark, d)))


@query
def promote(spark, d):
    return rounded(registry.promote(fx.runs(spark, d)))


@query
def production_row(spark, d):
    return rounded(registry.production_row(registry.promote(fx.runs(spark, d))))


def _families() -> dict:
    """Two families, so that there is a champion to choose."""
    return {k: v for k, v in models.factories().items() if k in ("linear_regression", "random_forest")}


def _trained(spark, stored: DataFrame) -> lifecycle.ModelStore:
    """A store with the versions of one training run."""
    store = lifecycle.ModelStore(spark, shared_dir(spark, "models"))
    store.train(stored, FIT_COLUMNS, fx.GRID, _families(), val_share=FIT_VAL)
    return store


@query
def train_runs(spark, d):
    """Families fitted side by side, one of which can't be: its run is FAILED, the others finish."""
    store = lifecycle.ModelStore(spark, shared_dir(spark, "models"))

    def broken(label: str):
        raise RuntimeError("no such family")

    families = _families() | {"no_family": broken}
    runs = store.train(fx.stored_features(spark, d), FIT_COLUMNS, fx.GRID, families, val_share=FIT_VAL)
    return runs.select("run_id", "model_name", "status", "error", (F.col("metrics")["mae"] > 0).alias("has_metrics"))


@query
def register_and_promote(spark, d):
    store = _trained(spark, fx.stored_features(spark, d))
    store.promote()
    shown = [F.col("metrics")[m].alias(m) for m in ("mae", "rmse")]
    return rounded(store.versions().select("model_name", "version", "stage", F.size("feature_columns").alias("n_features"), *shown), 4)


@query
def serve_production(spark, d):
    store = _trained(spark, fx.stored_features(spark, d))
    store.promote()
    return rounded(store.serve(fx.requests(spark, d), fx.GRID), 3)


@query
def retrain_job(spark, d):
    """Both trainings read one stored feature table, as later jobs find it."""
    stored = fx.stored_features(spark, d)
    store = _trained(spark, stored)
    store.promote()
    decision = drift.retrain_decision(_severities(spark, d), F.lit(C.MAX_AGE_DAYS))
    out = store.retrain(decision, stored, FIT_COLUMNS, fx.GRID, families=_families(), val_share=FIT_VAL)
    return rounded(out, 4)


# --- streams -------------------------------------------------------------------------


def _events_stream(spark, d) -> DataFrame:
    schema = fx.table(spark, d, "events").schema
    return live.read_stream(spark, f"{d}/events.parquet*", schema)


def _reading_stream(spark, d) -> DataFrame:
    return fx.shape_meter(_events_stream(spark, d))


@query
def stream_tumbling(spark, d):
    out = live.tumbling_table(_reading_stream(spark, d), shared_dir(spark, "tumbling"), fx.GRID)
    return rounded(out)


@query
def stream_enrich(spark, d):
    stream = _reading_stream(spark, d).select("seq", "household_id", "timestamp", "consumption_kwh")
    w = written(fx.weather_raw(spark, d), "weather")
    out = live.enrich_stream(stream, w, fx.WEATHER_VALUES, shared_dir(spark, "enrich"), fx.GRID, location=fx.PLACE)
    return rounded(out)


@query
def stream_pairing(spark, d):
    """The same pairs with weather as a stream of its own."""
    stream = _reading_stream(spark, d).select("seq", "household_id", "timestamp", "consumption_kwh")
    folder = shared_dir(spark, "weather-files")
    fx.weather_raw(spark, d).repartition(3).write.parquet(folder)
    w = live.read_stream(spark, folder, spark.read.parquet(folder).schema, max_files=1)
    out = pairing.paired_table(stream, w, fx.WEATHER_VALUES, shared_dir(spark, "pairs"), fx.GRID, lateness_minutes=31 * 1440)
    place = {"source_latitude": F.lit(fx.PLACE[0]), "source_longitude": F.lit(fx.PLACE[1])}
    return rounded(out.withColumn("is_real_weather", F.col("weather_at").isNotNull()).drop("weather_at").withColumns(place))


def _clean_live(rows: DataFrame) -> DataFrame:
    first = cleaning.dedupe_first(rows, ["household_id", "timestamp"])
    return first.withColumn("consumption_kwh", X.winsorise(F.col("consumption_kwh")))


@query
def stream_features(spark, d):
    w, c = written(fx.weather(spark, d), "weather"), written(fx.calendar(spark, d), "calendar")
    return rounded(live.feature_stream(_reading_stream(spark, d), w, c, shared_dir(spark, "live"), fx.GRID, _clean_live))


@query
def stream_monitor(spark, d):
    """Detectors fed by live features, ten days a micro-batch: how often and up to which slot each was fed."""
    folder = shared_dir(spark, "event-files")
    events = fx.table(spark, d, "events")
    for i, (low, high) in enumerate((("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01"))):
        events.filter((F.col("ts") < fx.ntz(high)) & (F.col("ts") >= fx.ntz(low) if i else F.lit(True))).coalesce(1).write.parquet(f"{folder}/part={i}")
    stream = fx.shape_meter(live.read_stream(spark, f"{folder}/*", events.schema, max_files=1))
    w, c = written(fx.weather(spark, d), "weather"), written(fx.calendar(spark, d), "calendar")
    names = ("consumption_kwh", "temperature_c", "heating_degree", "lag_1", "lag_4")
    out = monitor.monitored_stream(stream, w, c, shared_dir(spark, "monitor"), fx.GRID, _clean_live, names)
    return out.filter("kind = 'state'").groupBy("household_id", "feature").agg(F.max("n_updates").alias("n_updates"), F.max("timestamp").alias("last_fed"))


@query
def state_buffer(spark, d):
    """The last readings as keyed list state."""
    out = buffers.state_buffer(_reading_stream(spark, d), shared_dir(spark, "state"), fx.GRID, n=20)
    return out.select("seq", "household_id", "timestamp", "consumption_kwh")


@query
def recent_buffer(spark, d):
    out = live.buffer_stream(_reading_stream(spark, d), shared_dir(spark, "buffer"), fx.GRID, n=20)
    return out.select("seq", "household_id", "timestamp", "consumption_kwh")


@query
def stream_session_stats(spark, d):
    return rounded(live.session_stats(fx.meter_raw(spark, d)))


@query
def min_sample_gate(spark, d):
    return live.sample_gates(fx.meter_raw(spark, d))


@query
def location_mix(spark, d):
    e = fx.table(spark, d, "events").select(
        (F.lit(45.65) + F.when(F.col("event_id") % 4 == 0, 0.5).otherwise(0.001)).alias("source_latitude"),
        F.lit(13.7768).alias("source_longitude"),
    )
    return live.location_mix(e, *fx.PLACE)


@query
def to_local_time_query(spark, d):
    return fx.table(spark, d, "events").select("event_id", to_local_time(F.col("ts"), "Europe/Rome").alias("local_time"))


QUERIES["to_local_time"] = QUERIES.pop("to_local_time_query")


@query
def adwin_events(spark, d):
    return adwin.batch_events(adwin.detector_input(fx.shifted(spark, d), ["consumption_kwh"]))


@query
def adwin_stream(spark, d):
    rows = adwin.detector_input(_reading_stream(spark, d), ["consumption_kwh"])
    return adwin.detector_windows(adwin.backfill_events(rows, shared_dir(spark, "adwin")))


@query
def adwin_reset(spark, d):
    m = fx.shifted(spark, d)
    homes = m.groupBy("household_id").agg(F.min("timestamp").alias("t"))
    reset = homes.select("household_id", fx.ntz("2024-01-29").alias("timestamp"), F.lit(-2).cast("bigint").alias("seq"),
                         F.lit("reset").alias("op"), F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("value"))
    looser = homes.select("household_id", fx.ntz("2024-01-10").alias("timestamp"), F.lit(-1).cast("bigint").alias("seq"),
                          F.lit("delta").alias("op"), F.lit("consumption_kwh").alias("feature"), F.lit(0.05).alias("value"))
    commands = adwin.control_rows(reset.unionByName(looser), ["consumption_kwh"])
    rows = adwin.detector_input(m, ["consumption_kwh"]).unionByName(commands)
    return adwin.detector_windows(adwin.batch_events(rows))


@query
def drift_status(spark, d):
    names = F.array(*[F.lit(c) for c in ("consumption_kwh", "temperature_c", "heating_degree", "lag_1", "lag_48")])
    e = fx.table(spark, d, "events")
    log = e.filter("event_type = 'error'").select(
        F.element_at(names, (F.col("user_id") % 5 + 1).cast("int")).alias("feature"), F.col("ts").alias("timestamp")
    )
    out = adwin.drift_status(log, e.agg(F.count(F.lit(1))))
    tail = F.array_join(F.transform("recent_events", lambda x: F.concat(x["feature"], F.lit("@"), x["timestamp"])), "|")
    return out.select("n_updates", "n_drift_events_total", F.array_join("features_with_drift_ever", ",").alias("features"), tail.alias("recent"), "delta")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return pipeline_features(spark, d)


__all__ = ["QUERIES", "SeriesConfig", "flagship"]
