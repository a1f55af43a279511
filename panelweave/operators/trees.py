"""Tree ensembles of Spark ML for one target: grid search over contiguous folds, refit, predict.

A trainer takes one (period, target), as its features are columns. Trees split
on columns filled with the train rows' means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTHS = (3, 5)


@dataclass
class Trained:
    """Predictions of all rows, importances of the features, and the search's scores."""

    predictions: DataFrame
    importances: DataFrame
    grid: DataFrame


def regressor(family: str, seed: int):
    if family == "forest":
        return RandomForestRegressor(numTrees=20, seed=seed)
    if family == "boosting":
        return GBTRegressor(maxIter=10, seed=seed)
    raise ValueError(f"unknown family {family!r}")


def train(
    rows: DataFrame, features: Sequence[str], family: str = "forest", depths: Sequence[int] = DEPTHS,
    folds: int = 5, seed: int = 7,
) -> Trained:
    """Trains on the rows of ``rows(entity, y, fold, features...)`` that have a label; predicts all.

    The depth of least mean RMSE over the folds is refitted on all train rows. Folds are
    at most as many as train rows; fewer than two rows cannot be searched.
    """
    spark = rows.sparkSession
    known = rows.where("y is not null")
    folds = min(folds, known.count())
    if folds < 2:
        raise ValueError("fewer than two rows have a label")
    filled = [f"{name}_filled" for name in features]
    estimator = regressor(family, seed).setLabelCol("y").setFeaturesCol("features")
    prepare = Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="features"),
    ]).fit(known)
    grid = ParamGridBuilder().addGrid(estimator.maxDepth, list(depths)).build()
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"),
        numFolds=folds, foldCol="fold", parallelism=2,
    ).fit(prepare.transform(known))
    best = search.bestModel
    importances = [(name, float(x)) for name, x in zip(features, best.featureImportances.toArray())]
    return Trained(
        best.transform(prepare.transform(rows)).select("entity", "y", F.col("prediction")),
        spark.createDataFrame(importances, "feature string, value double"),
        spark.createDataFrame(list(zip(map(int, depths), map(float, search.avgMetrics))), "depth int, rmse double"),
    )
