"""Plan shapes and skew: what must hold at any size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from slotwise.config import SeriesConfig
from slotwise.operators import cleaning, features, grid, joins, quality
from slotwise.operators import distribution as D
from slotwise.plans import fixtures as fx
from slotwise.plans.queries import QUERIES
from tests.helpers import assert_close, panel, rows

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["build_features", "asof_join", "asof_join_merge", "clean_meter", "lag_features", "drift_ks", "merge_sources"])
def test_no_nested_loops_or_cartesian_products(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_all_feature_windows_share_one_exchange(spark):
    df, _ = panel(spark)
    text = plan(features.history_features(df, SeriesConfig()))
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1
    # In time for lags and row numbers, back in time for the ends of chunks, by chunks for all else.
    assert text.count("Window [") >= 3 and len(re.findall(r"\bSort \[", text)) == 3


def test_fill_merge_and_features_share_one_exchange_of_the_grid(spark):
    text = plan(fx.features(spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(household_id#\d+, _block", text)) == 1


def test_windows_over_series_are_partitioned(spark):
    for name in ("build_features", "clean_meter", "lag_features", "gap_count", "asof_join_merge"):
        for spec in re.findall(r"windowspecdefinition\(([^,]+),", plan(QUERIES[name](spark, SF))):
            # Unpartitioned windows may only run over block summaries.
            assert "ASC" not in spec.split("#")[0]
            if " ASC" in spec or " DESC" in spec:
                assert spec.startswith("_block")


def test_scan_reads_only_the_needed_columns(spark):
    text = plan(fx.grid(spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_deduplication_combines_before_the_shuffle(spark):
    text = plan(cleaning.dedupe_first(fx.meter_raw(spark, SF), ["household_id", "timestamp"]))
    assert "partial_min_by" in text and "SortAggregate" not in text


def test_large_right_side_takes_the_merge_plan(spark):
    left = fx.readings(spark, SF).select("seq", "household_id", "timestamp")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(joins.asof_join(left, fx.weather_raw(spark, SF), ["temperature_c"], ["household_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Join" not in text and "_salt" in text


@pytest.fixture(scope="module")
def hot(spark):
    """Half of all readings belong to one household."""
    raw = fx.meter_raw(spark, SF)
    return raw.withColumn("household_id", F.when(F.col("seq") % 2 == 0, "HH0000").otherwise(F.col("household_id")))


def test_blocks_split_a_hot_entity_and_keep_the_result(spark, hot):
    cfg = SeriesConfig(lag_steps=(1, 48), rolling_windows=(48,))
    small = SeriesConfig(lag_steps=(1, 48), rolling_windows=(48,), block_slots=128)
    g = grid.resample_mean_last(cleaning.dedupe_first(hot, ["household_id", "timestamp"]), cfg, order=())
    a = rows(features.history_features(g, cfg), "household_id", "timestamp")
    b = rows(features.history_features(g, small), "household_id", "timestamp")
    for c in ("lag_48", "roll_mean_48", "roll_std_48"):
        assert_close(a[c], b[c], 1e-7)
    blocked = features._in_blocks(g, small, 49)
    largest = blocked.groupBy("household_id", "_block").count().agg(F.max("count")).first()[0]
    assert largest <= 128 + 49


def test_hot_entity_in_top_n_and_gaps(spark, hot):
    out = joins.last_n(hot, ["household_id"], [F.col("timestamp").desc(), F.col("seq").desc()], 5, ["seq"])
    pdf = hot.toPandas().sort_values(["timestamp", "seq"])
    assert sorted(r.seq for r in out.collect()) == sorted(pdf.groupby("household_id").tail(5).seq)
    gaps = {r.household_id: r.n_gaps for r in quality.gap_counts(hot, "household_id").collect()}
    deltas = pdf.groupby("household_id").timestamp.diff().dt.total_seconds() > 1800
    assert gaps == deltas.groupby(pdf.household_id).sum().to_dict()


def test_value_ranges_split_a_feature(spark):
    df = spark.range(5000).select(F.lit("f").alias("feature"), F.sqrt(F.col("id").cast("double")).alias("value"))
    rows_ = D.cumulated(df)
    assert re.search(r"hashpartitioning\([^)]*_block", plan(rows_))
    assert rows_.agg(F.max("cum_all")).first()[0] == 5000
    # A third of the rows in one value is one row after counting.
    heavy = df.unionByName(spark.range(2500).select(F.lit("f").alias("feature"), F.lit(3.3).alias("value")))
    assert D.cumulated(heavy).count() <= 5001


def test_empty_slots_are_made_by_many_tasks(spark):
    # Two readings of an entity are few bytes, but a month of half-hours between them many rows.
    month = F.explode(F.array(F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz")))
    ends = spark.range(40).select(F.format_string("HH%02d", "id").alias("household_id"), month.alias("timestamp"), F.lit(1.0).alias("consumption_kwh"))
    cfg = SeriesConfig()
    made = [r["count"] for r in grid._empty_slots(ends, cfg).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 40 * (31 * 48 + 1) and max(made) < sum(made) / 2
    aligned = grid.align_to_grid(ends.withColumn("seq", F.lit(1)), cfg)
    held = aligned.agg(F.count("consumption_kwh"), F.count("*"), F.min("timestamp").cast("string"), F.max("timestamp").cast("string")).first()
    assert tuple(held) == (80, sum(made), "2024-01-01 00:00:00", "2024-02-01 00:00:00")


def test_sorts_of_features_are_not_merged_into_a_task(spark):
    # Merged by their few bytes, the rows of a grid would be sorted in a single task here.
    used = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
    readings, _ = panel(spark)
    cfg = SeriesConfig()
    for made in (features.add_lag_features, features.add_rolling_features, features.history_features):
        assert used(made(readings, cfg)) > 1
    weather = fx.weather(spark, SF)
    whole = fx.features(spark, SF)
    assert used(whole) > 1
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        shuffled = features.features_from_readings(fx.readings(spark, SF), weather, fx.calendar(spark, SF), fx.GRID)
        assert used(shuffled) > 1
        # Written weather is small, whatever the events are that it was made from.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 10))
        assert "_salt" not in plan(fx.features(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    a, b = (rows(x, "household_id", "timestamp").drop(columns=["household_id", "timestamp"]) for x in (shuffled, whole))
    assert_close(a, b[a.columns])


def test_the_pipeline_never_shuffles_the_dense_grid(spark):
    text = plan(fx.pipeline_features(spark, SF))
    made = re.search(r"Generate explode\(CASE WHEN isnull\(_slot", text)
    assert made and not re.search(r"Exchange hashpartitioning\(household_id", text[: made.start()])


@pytest.mark.parametrize("block", [50, 4096])
def test_open_blocks_hold_the_aligned_rows_and_those_before(spark, block):
    df, _ = panel(spark, n=200, holes=0.5, start="2024-01-01 00:07:00")
    df = df.filter("seq % 7 <> 0").unionByName(df.withColumns({"seq": F.col("seq") + 1000, "consumption_kwh": F.lit(99.0)}))
    df = df.unionByName(df.filter("seq = 3").withColumns({"household_id": F.lit("only off"), "timestamp": F.expr("timestamp + interval 3 minutes")}))
    cfg = SeriesConfig(block_slots=block)
    key = ["household_id", "timestamp"]
    want = rows(grid.align_to_grid(df, cfg), *key)
    out = grid.align_in_blocks(df, cfg, look_back=70)
    own = rows(out.filter("_own").drop("_block", "_own"), *key)
    assert len(want) == 4 * 200 and own[key].equals(want[key])
    assert_close(own.consumption_kwh, want.consumption_kwh)
    opened = features._in_blocks(grid.align_to_grid(df, cfg), cfg, 70)
    last = opened.filter("_own").agg(F.max("_block")).scalar()
    expected = opened.filter(F.col("_block") <= last).select(out.columns)
    assert out.exceptAll(expected).count() == 0 and expected.exceptAll(out).count() == 0


def test_features_in_open_blocks_equal_those_dealt_anew(spark):
    df, _ = panel(spark, n=300, holes=0.4)
    cfg = SeriesConfig(lag_steps=(1, 48), rolling_windows=(4, 48), block_slots=100)
    df = df.withColumn("is_real_data", F.when(F.col("seq") % 5 == 0, F.col("seq") % 2 == 0))
    key = ["household_id", "timestamp"]
    want = rows(features.build_feature_table(cleaning.clean_meter(df, cfg), cfg, on_grid=True), *key)
    for dealt in (True, False):
        got = rows(features.build_feature_table(cleaning.clean_meter(df, cfg, open_for=cfg.look_back + 1), cfg, on_grid=True, dealt=dealt), *key)
        assert got.equals(want)
