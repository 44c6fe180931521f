"""Baseline, MLlib regressors, their comparison, and the linear model as an expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.functions.expressions import error_metrics, relative_improvement
from slotwise.operators.joins import lookup_join
from slotwise.operators.leafwise import LeafwiseRegressor
from slotwise.operators.split import chronological_split, median_impute
from slotwise.session import written


def entity_means(train: DataFrame, cfg: SeriesConfig = DEFAULT) -> DataFrame:
    return train.groupBy(cfg.entity).agg(F.avg(cfg.value).alias("_mean"))


def baseline_predict(df: DataFrame, means: DataFrame, cfg: SeriesConfig = DEFAULT, lags: Sequence[str] = ("lag_336", "lag_48")) -> DataFrame:
    """Persistence: the value a week ago, a day ago, the mean of the entity in training,
    else the mean of these means. Lags that the table lacks are skipped."""
    grand = means.agg(F.avg("_mean")).scalar()
    present = [F.col(c) for c in lags if c in df.columns]
    joined = lookup_join(df, means, [cfg.entity], spread=[cfg.time])
    return joined.withColumn("prediction", F.coalesce(*present, F.col("_mean"), grand)).drop("_mean")


def metrics(df: DataFrame, cfg: SeriesConfig = DEFAULT, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*error_metrics(F.col(cfg.value), F.col("prediction")))


@dataclass(frozen=True)
class LinearScore:
    """A linear model as a column expression: scores inside codegen, no model object."""

    coefficients: dict[str, float]
    intercept: float = 0.0

    def predict(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            total = total + F.col(name).cast("double") * F.lit(weight)
        return total

    @classmethod
    def of(cls, model, features: Sequence[str]) -> LinearScore:
        return cls(dict(zip(features, map(float, model.coefficients))), float(model.intercept))


# The settings of the four families.
def factories(seed: int = 42, trees: int = 200, rounds: int = 300) -> dict:
    """The forest keeps each row's node in every tree: no pass then walks all trees again or sends them to all tasks, and the trees are the same."""
    common = {"featuresCol": "features", "seed": seed}
    return {
        "linear_regression": lambda y: LinearRegression(featuresCol="features", labelCol=y, solver="normal", regParam=0.0),
        "random_forest": lambda y: RandomForestRegressor(
            labelCol=y, numTrees=trees, maxDepth=12, minInstancesPerNode=5, cacheNodeIds=True, **common),
        "gradient_boosting": lambda y: GBTRegressor(
            labelCol=y, maxIter=rounds, maxDepth=6, stepSize=0.05, subsamplingRate=0.8,
            featureSubsetStrategy="0.8", **common),
        "histogram_boosting": lambda y: LeafwiseRegressor(
            labelCol=y, maxIter=rounds, maxLeaves=63, maxBins=255, stepSize=0.05, featureShare=0.8, **common),
    }


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


def prepare(
    features: DataFrame, columns: Sequence[str], cfg: SeriesConfig = DEFAULT,
    val_share: float = C.VALIDATION_SHARE, test_share: float = C.TEST_SHARE,
) -> DataFrame:
    """Split, purge, impute by train medians, and assemble: the input of every family.

    The medians need several passes over the rows and the result one more, so the purged rows are written first.
    """
    split = written(chronological_split(features, cfg, val_share, test_share), "split")
    # A column without any training value has no median; 0 keeps the vector valid.
    filled = median_impute(split, columns, F.col("split") == "train").na.fill(0.0, list(columns))
    return assemble(filled, columns)


def fit_side_by_side(families: dict[str, Callable], train: DataFrame, label: str, at_once: int = 4) -> dict[str, object]:
    """The fitted model of every family, or the error that ended its fit; the others go on.

    Families are fitted ``at_once`` in threads that inherit the caller's job group and local properties, so their jobs share the
    executors and are cancelled with the caller's.
    """
    def fit(make: Callable) -> object:
        try:
            return make(label).fit(train)
        except Exception as error:  # one family must not end the fits of the others
            return error

    spark = train.sparkSession
    with ThreadPoolExecutor(max(1, min(at_once, len(families)))) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(fit), make) for name, make in families.items()}
        return {name: future.result() for name, future in running.items()}


def train_and_compare(
    features: DataFrame, columns: Sequence[str], cfg: SeriesConfig = DEFAULT,
    families: dict | None = None, val_share: float = C.VALIDATION_SHARE, test_share: float = C.TEST_SHARE,
) -> tuple[DataFrame, dict]:
    """Metrics of the baseline and of every family on the validation part, and the models.

    The learners pass over the rows many times, so the assembled rows are written to the
    shared folder first: a lost executor then costs a read and not the whole pipeline.
    """
    families = factories(cfg.seed) if families is None else families
    data = written(prepare(features, columns, cfg, val_share, test_share), "train")
    train, val = data.filter("split = 'train'"), data.filter("split = 'val'")
    base = metrics(baseline_predict(val.drop("features"), entity_means(train, cfg), cfg), cfg).first()
    rows = [("baseline", *base, 0.0)]
    models = fit_side_by_side(families, train, cfg.value)
    for name, model in models.items():
        if isinstance(model, Exception):
            raise model
        m = metrics(model.transform(val), cfg)
        gain = relative_improvement(F.lit(base["mae"]), F.col("mae"))
        rows.append((name, *m.withColumn("gain", gain).first()))
    spark = features.sparkSession
    schema = "model string, mae double, rmse double, mape double, n_samples bigint, improvement_pct double"
    table = spark.createDataFrame(rows, schema)
    best = table.filter("model <> 'baseline'").agg(F.min_by("model", F.struct("mae", "model"))).scalar()
    return table.withColumn("is_champion", F.col("model") == best), models
