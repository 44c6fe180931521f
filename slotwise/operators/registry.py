"""Model versions and runs as tables: best run, champion, promotion, production row.

The tables have one row per trained model, so they are small; all functions are pure
transformations and leave the writing to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stages of a version.
STAGES = ("None", "Staging", "Production", "Archived")

VERSION_SCHEMA = (
    "model_name string, version int, stage string, created_at timestamp, metrics map<string,double>,"
    " params map<string,string>, feature_columns array<string>, data_hash string, artifact_path string"
)


def best_run(runs: DataFrame, metric: str = "mae", minimize: bool = True) -> DataFrame:
    """The run with the best known metric; ties go to the first name and version."""
    direction = F.col(metric).asc() if minimize else F.col(metric).desc()
    return runs.filter(F.col(metric).isNotNull()).orderBy(direction, "model_name", "version").limit(1)


def latest_versions(versions: DataFrame) -> DataFrame:
    return versions.groupBy("model_name").agg(F.max_by(F.struct(*versions.columns), "version").alias("x")).select("x.*")


def champion(versions: DataFrame, candidates: Sequence[str] | None = None) -> DataFrame:
    """Lowest MAE among the latest versions of the families (of ``candidates`` only, if given), latest without MAE skipped."""
    if candidates is not None:
        versions = versions.filter(F.col("model_name").isin(list(candidates)))
    return best_run(latest_versions(versions), "mae")


def next_version(versions: DataFrame, model_name: str) -> Column:
    known = versions.filter(F.col("model_name") == model_name).agg(F.max("version"))
    return F.coalesce(known.scalar(), F.lit(0)) + 1


def transition_stage(versions: DataFrame, model_name: Column, version: Column, stage: str) -> DataFrame:
    """Move one version; moving to Production archives the other one of that model."""
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, got {stage}")
    chosen = (F.col("model_name") == model_name) & (F.col("version") == version)
    new = F.when(chosen, F.lit(stage))
    if stage == "Production":
        new = new.when((F.col("model_name") == model_name) & (F.col("stage") == "Production"), F.lit("Archived"))
    return versions.withColumn("stage", new.otherwise(F.col("stage")))


def promote(versions: DataFrame, model_name: str | None = None, version: int | None = None, dry_run: bool = False) -> DataFrame:
    """Version table with one Production row in total: the champion or the named version.

    ``dry_run`` returns the selected row instead.
    """
    if model_name is None:
        selected = champion(versions)
    else:
        named = versions.filter(F.col("model_name") == model_name)
        selected = latest_versions(named) if version is None else named.filter(F.col("version") == version)
    if dry_run:
        return selected
    one = selected.agg(
        F.when(F.count(F.lit(1)) == 0, F.raise_error(F.lit("no version with an 'mae' metric to promote")))
        .otherwise(F.first(F.struct("model_name", "version"))).alias("k")
    )
    key = one.select("k").scalar()
    chosen = (F.col("model_name") == key["model_name"]) & (F.col("version") == key["version"])
    return versions.withColumn(
        "stage",
        F.when(chosen, "Production").when(F.col("stage") == "Production", "Archived").otherwise(F.col("stage")),
    )


def production_row(versions: DataFrame) -> DataFrame:
    """The one Production row; none and several are errors."""
    live = versions.filter(F.col("stage") == "Production")
    n = F.count(F.lit(1))
    guarded = live.agg(
        F.when(n == 0, F.raise_error(F.lit("no version is in Production")))
        .when(n > 1, F.raise_error(F.lit("several versions are in Production")))
        .otherwise(F.first(F.struct(*versions.columns))).alias("x")
    )
    return guarded.select("x.*")


def append_version(versions: DataFrame, row: dict) -> DataFrame:
    """The table with one more row, numbered after the latest version of its model."""
    spark = versions.sparkSession
    new = spark.createDataFrame([{**row, "version": None}], versions.schema)
    return versions.unionByName(new.withColumn("version", next_version(versions, row["model_name"]).cast("int")))
