"""The cross-sectional run with several predictors: choose, sum, search, refit, validate, predict, bound."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import design, gram, ranking, scores
from panelweave.operators.pairs import pair_stats
from panelweave.session import cut

TARGET = design.TARGET
#: Folds of the search, and of the residuals that bound predictions.
SEARCH, RESIDUAL = 5, 3


@dataclass
class Run:
    """What a run leaves: each a table of all (period, target)."""

    chosen: DataFrame
    grid: DataFrame
    model: DataFrame
    residuals: DataFrame
    predictions: DataFrame


def labelled_sums(train: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train rows with ``fold`` and ``third``, their sums with class weights), both written."""
    folded = cut(ranking.kfolds(train, keys, order, {"fold": SEARCH, "third": RESIDUAL}), "train")
    sums = gram.products(folded, keys, ["fold", "third", "in_focus"])
    return folded, cut(design.class_weighted(sums, keys), "sums")


def year_by_year(
    panel: DataFrame, focus: DataFrame, k: int = 10, penalties: Sequence[tuple[float, float]] = gram.PENALTIES, least: int = 10
) -> Run:
    """Trains a model of each (period, indicator) on its ``k`` strongest predictors; predicts focus cells without a value.

    A target without a predictor that ``least`` rows share, or with one train row, has no model.
    """
    panel = cut(panel, "panel")
    chosen = cut(design.strongest_predictors(pair_stats(panel, ["period"], "entity"), k, least), "predictors")
    train, rest = design.split(cut(design.design(panel, chosen, k), "design"), focus)
    train, sums = labelled_sums(train, TARGET, ["entity"])
    fitted = cut(gram.fits(sums, TARGET, ["fold", "third"], penalties), "fits")
    grid = gram.grid(fitted, TARGET)
    at_best = fitted.join(gram.best(grid, TARGET), [*TARGET, "l1", "alpha"])
    model = at_best.where("split = 'all'")
    apart = at_best.where("split = 'third'").withColumnRenamed("fold", "out").withColumnRenamed("out", "third")
    residuals = gram.predicted(train, apart, [*TARGET, "third"], [*TARGET, "entity", "third", "y"]).withColumn(
        "residual", F.col("y") - F.col("prediction")
    )
    residuals = cut(residuals, "residuals")
    band = ranking.quantiles(residuals, TARGET, "residual", {"low": 0.05, "high": 0.95})
    predictions = gram.predicted(rest, model, TARGET, [*TARGET, "entity"]).join(band, TARGET).select(
        *TARGET, "entity", "prediction",
        (F.col("prediction") + F.col("low")).alias("lower"), (F.col("prediction") + F.col("high")).alias("upper"),
    )
    return Run(chosen, grid, model, residuals, predictions)


def performance(run: Run) -> DataFrame:
    """(period, target, rmse, nrmse, r2): the search's best error, and R² of the residuals' folds."""
    least = run.grid.groupBy(*TARGET).agg(F.min("rmse").alias("rmse"))
    stats = scores.label_stats(run.residuals, TARGET)
    return scores.normalised_rmse(least, stats, TARGET).join(scores.out_of_fold_r2(run.residuals, TARGET), TARGET)


def importances(run: Run) -> DataFrame:
    """(period, target, predictor, coefficient, importance): the last is the size of the scaled coefficient."""
    at = F.posexplode(F.arrays_zip("coefficients", "scaled")).alias("position", "c")
    each = run.model.select(*TARGET, at).select(
        *TARGET, (F.col("position") + 1).alias("rank"), "c.coefficients", F.abs("c.scaled").alias("importance")
    )
    return run.chosen.join(each, [*TARGET, "rank"]).select(
        *TARGET, "predictor", F.col("coefficients").alias("coefficient"), "importance"
    )
