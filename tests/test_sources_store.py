import hashlib
import os
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.functions.timegrid import to_instant, to_naive_utc
from slotwise.operators import grid
from slotwise.sources import readers, store
from tests.helpers import at, panel, rows


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_archive_picks_the_member_of_the_year(spark, folder):
    make_zip(f"{folder}/a.zip", {"d/2025_UTC.csv": " Timestamp ,value\n2025-01-01,1.5\n2025-01-02,\n", "d/2024_UTC.csv": "x\n1\n", "2025.txt": ""})
    out = readers.read_archive(spark, folder, 2025, ["timestamp", "value"]).collect()
    assert [tuple(r) for r in out] == [("2025-01-01", "1.5"), ("2025-01-02", None)]


@pytest.mark.parametrize("members, message", [
    ({"2024.csv": "a\n1\n"}, "0 CSV members"), ({"2025_a.csv": "a\n1\n", "2025_b.csv": "a\n1\n"}, "2 CSV members"), ({"2025.csv": "a\n"}, "is empty"),
])
def test_archive_errors(spark, folder, members, message):
    make_zip(f"{folder}/a.zip", members)
    with pytest.raises(Exception, match=message):
        readers.read_archive(spark, folder, 2025, ["a"]).collect()


def test_roles_follow_file_order_for_time_and_list_order_for_value(spark):
    schema = spark.createDataFrame([], " Date string, TIMESTAMP string, energy double, KWH double").schema
    assert readers.resolve_roles(schema) == (" Date", "KWH") or readers.resolve_roles(schema) == ("Date", "KWH")
    one = spark.createDataFrame([], "time string, reading double").schema
    assert readers.resolve_roles(one) == ("time", "reading")
    for bad in ("when string, kwh double", "time string, a double, b double"):
        with pytest.raises(ValueError):
            readers.resolve_roles(spark.createDataFrame([], bad).schema)


def test_lenient_parse(spark):
    data = [("2024-01-01 00:00:00", "1.5"), ("2024-01-01T02:00:00+02:00", "2"), ("2024-01-01T00:00:00Z", "0"), ("nope", "1"), ("2024-01-01", "x"), ("2024-01-01", "-1"), (None, "1"), ("2024-01-02", "NaN")]
    out = rows(readers.parse_lenient(spark.createDataFrame(data, "timestamp string, consumption_kwh string")), "consumption_kwh")
    assert out.consumption_kwh.tolist() == [0.0, 1.5, 2.0]
    assert set(out.timestamp) == {pd.Timestamp("2024-01-01")}
    with pytest.raises(ValueError, match="nothing left"):
        readers.require_rows(spark.createDataFrame([], "a int"), "nothing left")


def test_weather_payloads(spark, folder):
    with open(f"{folder}/w.json", "w") as f:
        f.write('{"hourly": {"time": ["2025-01-01T00:00", "2025-01-01T01:00"], "temperature_2m": [1.0, null],\n "relative_humidity_2m": [80, 81], "wind_speed_10m": [36.0, 3.6]}}')
    out = rows(readers.read_weather_payloads(spark, folder), "timestamp")
    assert out.wind_speed_ms.tolist() == [10.0, 1.0] and pd.isna(out.temperature_c[1])
    with open(f"{folder}/w.json", "w") as f:
        f.write('{"hourly": {"time": []}}')
    with pytest.raises(Exception, match="without hours"):
        readers.read_weather_payloads(spark, folder).collect()


def test_fallback(spark):
    good = lambda: spark.createDataFrame([(1,), (2,), (3,)], "x int")

    def broken():
        raise OSError("offline")

    flags = lambda df: {r.is_real_data for r in df.collect()}
    assert flags(readers.read_with_fallback(broken, good)) == {False}
    assert flags(readers.read_with_fallback(good, broken)) == {True}
    assert flags(readers.read_with_fallback(broken, good, use_real=False)) == {False}
    assert set(readers.ingest_all({"a": good, "b": good})) == {"a", "b"}


def test_range_filter_reaches_the_scan(spark, folder):
    df, _ = panel(spark)
    df.write.mode("overwrite").parquet(folder)
    out = readers.in_range(spark.read.parquet(folder), F.lit(at()).cast("timestamp_ntz"), F.lit(at("2024-01-01 01:00")).cast("timestamp_ntz"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert out.count() == 6


def test_time_index_is_left_inclusive(spark):
    span = spark.createDataFrame([(at(), at("2024-01-01 02:00"))], "lo timestamp_ntz, hi timestamp_ntz")
    assert grid.time_index(span, "lo", "hi", 30 * 60_000_000).count() == 4
    assert grid.time_index(span, "hi", "lo", 30 * 60_000_000).count() == 0


def test_calendar_flags(spark):
    span = spark.createDataFrame([(at("2024-01-05"), at("2024-01-08"))], "a timestamp_ntz, b timestamp_ntz")
    out = rows(readers.calendar_days(span, "a", "b", spark.createDataFrame([("2024-01-06",)], "date string")), "date")
    assert out.day_of_week.tolist() == [4, 5, 6, 0]
    assert out.is_weekend.tolist() == [False, True, True, False]
    assert out.is_holiday.tolist() == [False, True, False, False]


def test_feature_store_versions_and_prunes(spark, folder):
    df, _ = panel(spark)
    df = df.withColumns({"lag_1": F.col("consumption_kwh") + 1, "hour": F.hour("timestamp")}).drop("seq")
    s = store.FeatureStore(spark, folder)
    first = s.write_features(df, SeriesConfig()).first()
    assert (first.version, first.n_rows, first.feature_columns) == (1, 180, ["lag_1", "hour"])
    second = s.write_features(df.repartition(5), SeriesConfig()).first()
    assert second.version == 2 and second.content_hash == first.content_hash
    third = s.write_features(df.withColumn("lag_1", F.lit(0.0))).first()
    assert third.content_hash != first.content_hash
    part = s.read_features(["hour"])
    assert part.columns == ["household_id", "timestamp", "consumption_kwh", "hour"] and part.count() == 180
    assert "lag_1" not in part._jdf.queryExecution().executedPlan().toString()
    assert s.feature_names() == ["lag_1", "hour"]


def test_file_manifest(spark, folder):
    for name in ("a", "b"):
        with open(f"{folder}/{name}.txt", "w") as f:
            f.write(name)
    recorded = spark.createDataFrame(store.file_manifest(spark, [folder, f"{folder}/none"]).collect())
    ok = lambda: spark.range(1).select(store.verify_manifest(recorded, store.file_manifest(spark, [folder]))).first()[0]
    assert recorded.count() == 2 and ok()
    with open(f"{folder}/b.txt", "w") as f:
        f.write("changed")
    assert not ok()
    assert store.verify_manifest(None, recorded) is False
    assert store.file_manifest(spark, [f"{folder}/none"]).count() == 0
    assert os.path.exists(f"{folder}/a.txt")


def test_files_of_2_gb_are_hashed(spark, folder):
    with open(f"{folder}/long one.bin", "wb") as f:
        f.write(b"begin")
        f.truncate(1 << 31)
    with open(f"{folder}/short.bin", "wb") as f:
        f.write(b"short")
    found = {r.path.rsplit("/", 1)[-1]: r for r in store.file_manifest(spark, [folder]).collect()}
    want = hashlib.sha256(b"begin")
    for at in range(5, 1 << 31, 1 << 20):
        want.update(bytes(min(1 << 20, (1 << 31) - at)))
    assert found["long one.bin"].sha256 == want.hexdigest() and found["long one.bin"].size_bytes == 1 << 31
    assert found["short.bin"].sha256 == hashlib.sha256(b"short").hexdigest() and len(found) == 2


@pytest.mark.parametrize("mounted", [True, False])
def test_long_files_have_the_hash_of_whole_ones(spark, folder, monkeypatch, mounted):
    os.mkdir(f"{folder}/in")
    for i, size in enumerate((1, 98, 99, 100, 5000)):
        with open(f"{folder}/in/{i} ü%20.bin", "wb") as f:
            f.write(os.urandom(size))
    whole = sorted(store.file_manifest(spark, [folder]).collect())
    monkeypatch.setattr(store, "WHOLE_BYTES", 99)
    monkeypatch.setattr(store, "STEP_BYTES", 64)
    if not mounted:
        monkeypatch.setattr(store, "_sha256_of_mounted", lambda file: None)
    assert len(whole) == 5 and sorted(store.file_manifest(spark, [folder]).collect()) == whole


def test_naive_and_instant_convert_both_ways(spark):
    df = spark.createDataFrame([(at("2024-03-31 01:30"),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        out = df.select(to_naive_utc(to_instant(F.col("t"))).alias("t"), F.unix_seconds(to_instant(F.col("t"))).alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert out.t == at("2024-03-31 01:30") and out.s == 1711848600


def test_failed_read_of_the_pointer_is_no_empty_store(spark, folder, monkeypatch):
    """Only a missing path means that there is no version yet; history is never overwritten."""
    kept = store.FeatureStore(spark, f"{folder}/versions")
    df, _ = panel(spark, n_households=1, n=5)
    kept.write_features(df)
    schema = spark.read.schema

    class Broken:
        def schema(self, _):
            raise RuntimeError("store does not answer")

    monkeypatch.setattr(type(spark), "read", property(lambda _: Broken()))
    with pytest.raises(RuntimeError):
        kept._latest(missing_ok=True)
    monkeypatch.undo()
    assert schema is not None and kept._latest() == 1
    kept.write_features(df)
    assert kept._latest() == 2


def test_empty_primary_falls_back(spark):
    df, _ = panel(spark, n_households=1, n=5)
    out = readers.read_with_fallback(lambda: df.limit(0), lambda: df)
    assert out.count() == 5 and not any(r.is_real_data for r in out.collect())
