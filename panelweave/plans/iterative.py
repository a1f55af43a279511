"""The iterative run: chained imputation, then bounds, errors and importances from the last round's models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import chained, ranking, scores
from panelweave.session import cut

KEY = ["indicator"]


def report(run: chained.Imputed) -> DataFrame:
    """(indicator, n, rmse, nrmse, r2, low, high): out-of-fold errors of each column and the 5 % and 95 % quantiles of its residuals."""
    left = cut(chained.residuals(run), "chained-residuals")
    error = left.groupBy(*KEY).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse")
    )
    nrmse = scores.normalised_rmse(error, scores.label_stats(left, KEY), KEY).select(*KEY, "nrmse")
    band = ranking.quantiles(left, KEY, "residual", {"low": 0.05, "high": 0.95})
    return error.join(nrmse, KEY).join(scores.out_of_fold_r2(left, KEY), KEY).join(band, KEY)


def predictions(run: chained.Imputed, reported: DataFrame, focus: DataFrame | None = None) -> DataFrame:
    """(keys, indicator, value, lower, upper, is_imputed) of every cell, of focus entities if given; bounds only where imputed."""
    cells = chained.cells(run)
    if focus is not None:
        cells = cells.join(focus.select("entity").distinct(), "entity", "left_semi")
    gone = F.col("is_imputed")
    return cells.join(reported.select(*KEY, "low", "high"), KEY, "left").select(
        *run.keys, *KEY, "value",
        F.when(gone, F.col("value") + F.col("low")).alias("lower"),
        F.when(gone, F.col("value") + F.col("high")).alias("upper"),
        "is_imputed",
    )
