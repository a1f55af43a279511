"""Error measures of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse_over_folds(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Root of the mean over folds of each fold's mean squared error."""
    error = (F.col("y") - F.col("prediction")) * (F.col("y") - F.col("prediction"))
    return (
        scored.groupBy(*keys, "fold")
        .agg(F.avg(error).alias("mse"))
        .groupBy(*keys)
        .agg(F.sqrt(F.avg("mse")).alias("rmse"))
    )


def label_stats(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    return train.groupBy(*keys).agg(
        F.avg("y").alias("y_mean"), (F.max("y") - F.min("y")).alias("y_span")
    )


def normalised_rmse(scores: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RMSE over the mean label; over the label's span when that leaves [0, 1]."""
    by_mean = F.col("rmse") / F.nullif("y_mean", F.lit(0.0))
    by_span = F.col("rmse") / F.nullif("y_span", F.lit(0.0))
    # A zero mean puts the ratio at infinity, hence outside [0, 1].
    usable = F.coalesce(by_mean.between(0, 1), F.lit(False))
    return scores.join(stats, list(keys)).select(
        *keys, "rmse", F.when(usable, by_mean).otherwise(by_span).alias("nrmse")
    )


def out_of_fold_r2(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, r2): one less the squared errors' share of the labels' squared deviations; null where labels are constant."""
    error = (F.col("y") - F.col("prediction")) * (F.col("y") - F.col("prediction"))
    deviation = F.nullif(F.count("y") * F.var_pop("y"), F.lit(0.0))
    return scored.groupBy(*keys).agg((1 - F.sum(error) / deviation).alias("r2"))
