"""Queries against their DuckDB oracles.

A few run always; set SLOTWISE_ALL=1 to run every query (slow).
"""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tests.helpers import assert_close

SF = os.environ.get("SLOTWISE_SF_DIR", "/root/testdata/sf0.001")
QUICK = (
    "dedupe_first", "winsorise", "resample_mean_last", "asof_join", "build_features", "clean_meter", "chrono_split",
    "drift_ks", "feature_drift", "recommendations", "promote", "validate_meter", "recent_buffer", "location_mix",
)
NAMES = tuple(entry_points.oracle_sql()) if os.environ.get("SLOTWISE_ALL") else QUICK


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages"
                 " benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def as_text(df: pd.DataFrame) -> pd.DataFrame:
    return df.astype(object).where(df.notna(), None).astype(str)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    got = entry_points.queries()[name](spark, SF).toPandas()
    expected = duck.execute(entry_points.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(expected.columns)
    exact = [c for c in sorted(got.columns) if got[c].dtype != float]
    floats = [c for c in sorted(got.columns) if got[c].dtype == float]
    for df in (got, expected):
        for c in exact:
            if str(df[c].dtype).startswith("datetime"):
                df[c] = df[c].astype("datetime64[us]")
        df.sort_values(exact + floats, inplace=True)
    assert len(got) == len(expected)
    pd.testing.assert_frame_equal(as_text(got[exact]).reset_index(drop=True), as_text(expected[exact]).reset_index(drop=True))
    for c in floats:
        assert_close(got[c], expected[c].astype(float), 1e-5)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_a_stable_schema(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["household_id", "timestamp"] and df.count() > 0
