"""The gate in front of a table: what fails a critical check is stored and reported, not read."""

import pytest
from pyspark.sql import functions as F

from slotwise.operators import registry
from slotwise.sources.publish import CheckedTable
from tests.helpers import panel


def test_bad_batches_leave_the_earlier_version(spark, folder):
    good, _ = panel(spark)
    table = CheckedTable(spark, f"{folder}/meter", "smart_meter")
    bad = good.withColumn("consumption_kwh", F.lit(99.0))
    assert not table.publish(bad).first()["published"]
    with pytest.raises(LookupError):
        table.read()
    report = table.publish(good)
    assert report.first()["published"] and report.count() == 7
    assert not table.publish(good.union(good)).first()["published"]
    assert table.read().exceptAll(good.select(table.read().columns)).count() == 0 and table.read().count() == good.count()
    seen = {r.version: (r.published, r.n_critical_failures) for r in table.reports().collect()}
    assert seen == {1: (False, 1), 2: (True, 0), 3: (False, 1)}
    assert table.report(1).filter("not success and severity = 'CRITICAL'").first()["expectation"] == "expect_column_values_to_be_between"


def test_an_attempt_without_report_is_written_again(spark, folder):
    good, _ = panel(spark)
    table = CheckedTable(spark, f"{folder}/meter", "smart_meter")
    good.limit(5).write.parquet(f"{folder}/meter/staged/v1")
    assert table.publish(good).first()["published"] and table.read().count() == good.count()


def test_untimed_tables(spark, folder):
    days = spark.createDataFrame([("2024-01-01", False, True), ("2024-01-02", False, False)], "date string, is_weekend boolean, is_holiday boolean")
    table = CheckedTable(spark, f"{folder}/days", "calendar", time=None, entity=None)
    assert table.publish(days).first()["published"] and table.read().count() == 2
    assert not table.publish(days.union(days)).first()["published"] and table.read().count() == 2


def test_champion_of_some_families(spark):
    rows = spark.createDataFrame([("a", 1, 0.1, "None"), ("b", 1, 0.3, "None"), ("b", 2, 0.5, "None"), ("c", 1, 0.4, "None")], "model_name string, version int, mae double, stage string")
    assert registry.champion(rows).first().model_name == "a"
    assert registry.champion(rows, ["b", "c"]).first().model_name == "c"
    assert registry.champion(rows, ["z"]).count() == 0
