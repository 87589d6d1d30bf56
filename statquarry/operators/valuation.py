"""Gradient-boosted value model on a log target: split, search, metrics, importances, residuals."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.functions.parsing import clamp_zero
from statquarry.operators.boosting import Boosted, Search, Trial
from statquarry.operators.shape import q

# ---- fixed values: search space of the value model ----------------------------------------------------------
TREES = (300, 999)
LEARNING_RATE = (0.01, 0.11)
DEPTH = (3, 4)
MIN_SPLIT = (2, 9)
SUBSAMPLE = (0.7, 1.0)
DRAWS = 30
FOLDS = 5
SEED = 42
TEST_SHARE = 20  # percent
# -------------------------------------------------------------------------------------------------------------


def in_test(key: Column, seed: int = SEED, share: int = TEST_SHARE) -> Column:
    """Whether a row belongs to the test split.

    Decided by a hash of the row's key, so the split is the same under any partitioning, retry or row order.
    """
    digest = F.md5(F.concat_ws("/", key.cast("string"), F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return bucket < share


def train_test_split(df: DataFrame, key: str, seed: int = SEED, share: int = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    test = in_test(q(key), seed, share)
    return df.where(~test), df.where(test)


def draw_params(n: int = DRAWS, seed: int = SEED, trees: tuple[int, int] = TREES) -> list[dict]:
    """Random parameter draws.  The smallest child stands in for the smallest node that may split."""
    rng = random.Random(seed)
    return [
        {
            "maxIter": rng.randint(*trees),
            "stepSize": rng.uniform(*LEARNING_RATE),
            "maxDepth": rng.randint(*DEPTH),
            "minInstancesPerNode": max(1, rng.randint(*MIN_SPLIT) // 2),
            "subsamplingRate": rng.uniform(*SUBSAMPLE),
        }
        for _ in range(n)
    ]


def draw_trials(n: int = DRAWS, seed: int = SEED, trees: tuple[int, int] = TREES) -> list[Trial]:
    """Random draws from the search space, as trials of ``boosting``; the smallest node that may split is itself a parameter."""
    rng = random.Random(seed)
    return [
        Trial(
            trees=rng.randint(*trees), rate=rng.uniform(*LEARNING_RATE), depth=rng.randint(*DEPTH),
            min_split=rng.randint(*MIN_SPLIT), subsample=rng.uniform(*SUBSAMPLE),
        )
        for _ in range(n)
    ]


def score_table(found: Search, df: DataFrame) -> DataFrame:
    """``draw, fold, trees, rate, depth, min_split, subsample, r2``: one row for each draw and fold."""
    rows = [
        (d, f, t.trees, t.rate, t.depth, t.min_split, t.subsample, score)
        for d, f, score in found.scores for t in [found.draws[d]]
    ]
    return df.sparkSession.createDataFrame(
        rows, "draw int, fold int, trees int, rate double, depth int, min_split int, subsample double, r2 double"
    )


def gain_table(model: Boosted, names: Sequence[str], df: DataFrame, k: int = 20) -> DataFrame:
    """``feature, importance`` by the gain of splits, the ``k`` largest."""
    rows = [(name, float(w)) for name, w in zip(names, model.importances())]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def regressor(features: str, label: str, seed: int = SEED, **params) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=features, labelCol=label, predictionCol="predicted_log", lossType="squared", seed=seed,
        checkpointInterval=10, **params,
    )


def random_search(
    train: DataFrame,
    features: str,
    label: str,
    draws: int = DRAWS,
    folds: int = FOLDS,
    seed: int = SEED,
    trees: tuple[int, int] = TREES,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated random search by R²; fits of different draws run side by side."""
    model = regressor(features, label, seed)
    maps = [{getattr(model, name): value for name, value in draw.items()} for draw in draw_params(draws, seed, trees)]
    score = RegressionEvaluator(labelCol=label, predictionCol="predicted_log", metricName="r2")
    search = CrossValidator(
        estimator=model, estimatorParamMaps=maps, evaluator=score, numFolds=folds, parallelism=parallelism, seed=seed
    )
    return search.fit(train)


def back_to_scale(predicted_log: Column) -> Column:
    """Inverse of the log target, negatives to 0."""
    return clamp_zero(F.expm1(predicted_log))


def predict(model: GBTRegressionModel | Boosted, df: DataFrame) -> DataFrame:
    """All columns plus ``predicted`` on the original scale."""
    return model.transform(df).withColumn("predicted", back_to_scale(F.col("predicted_log")))


def residuals(scored: DataFrame, entity: str, actual: str, predicted: str = "predicted") -> DataFrame:
    return scored.select(
        q(entity).alias("entity"),
        q(actual).alias("actual"),
        q(predicted).alias("predicted"),
        (q(actual) - q(predicted)).alias("residual"),
    )


def regression_metrics(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``n, r2, rmse, mae`` in one aggregate; R² from the variance of the actual values."""
    error = q(actual) - q(predicted)
    sums = scored.where(q(actual).isNotNull() & q(predicted).isNotNull()).agg(
        F.count("*").alias("n"),
        F.sum(error * error).alias("sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(q(actual)).alias("variance"),
    )
    return sums.select(
        "n",
        (1 - F.col("sse") / F.nullif(F.col("variance") * F.col("n"), F.lit(0.0))).alias("r2"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        "mae",
    )


def feature_importance(model: GBTRegressionModel, names: Sequence[str], df: DataFrame, k: int = 20) -> DataFrame:
    """``feature, importance``, the ``k`` largest.  One number per feature lives in the model."""
    weights = model.featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(names, weights)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)
