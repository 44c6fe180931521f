"""Small frames and the plain pandas forms of the operators, as brute-force checks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

METER = "seq bigint, timestamp timestamp_ntz, household_id string, consumption_kwh double"


def at(text="2024-01-01", minutes=0):
    return (pd.Timestamp(text) + pd.Timedelta(minutes=minutes)).to_pydatetime()


def panel(spark, n_households=3, n=60, freq="30min", start="2024-01-01", holes=0.3, seed=0):
    """A seeded panel on a grid with nulls, as Spark and as pandas frame."""
    rng = np.random.default_rng(seed)
    parts = []
    for h in range(n_households):
        y = rng.uniform(0, 10, n).round(3)
        y[rng.random(n) < holes] = np.nan
        parts.append(pd.DataFrame({
            "timestamp": pd.date_range(start, periods=n, freq=freq), "household_id": f"HH{h}", "consumption_kwh": y,
        }))
    pdf = pd.concat(parts, ignore_index=True)
    pdf.insert(0, "seq", np.arange(len(pdf)))
    return meter(spark, pdf), pdf


def meter(spark, pdf):
    df = spark.createDataFrame(pdf.assign(timestamp=pdf["timestamp"].astype(str)))
    value = F.when(~F.isnan("consumption_kwh"), F.col("consumption_kwh"))
    return df.withColumns({"timestamp": F.col("timestamp").cast("timestamp_ntz"), "consumption_kwh": value})


def rows(df, *order):
    return df.orderBy(*order).toPandas()


def assert_close(a, b, tol=1e-9):
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    assert a.shape == b.shape
    both = ~(np.isnan(a) | np.isnan(b))
    assert (np.isnan(a) == np.isnan(b)).all()
    assert np.abs(a[both] - b[both]).max(initial=0) < tol
