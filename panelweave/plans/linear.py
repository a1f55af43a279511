"""The cross-sectional run with penalised linear models: choose, validate, refit, predict, bound."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import linear, ranking, scores
from panelweave.operators.pairs import pair_stats
from panelweave.session import cut

PENALTIES = (0.0, 0.1, 1.0)


@dataclass
class Run:
    """What a run leaves: each a table of all (period, target)."""

    chosen: DataFrame
    grid: DataFrame
    model: DataFrame
    residuals: DataFrame
    performance: DataFrame


def year_by_year(
    panel: DataFrame, folds: int = 5, penalties: Sequence[float] = PENALTIES, least: int = 10
) -> Run:
    """Trains a model for each (period, indicator) of the panel; rows and sums are written once each."""
    panel = cut(panel, "panel")
    chosen = cut(linear.strongest_predictor(pair_stats(panel, ["period"], "entity"), least), "predictors")
    train = linear.training_rows(panel, chosen)
    train = cut(ranking.kfold(train, linear.TARGET, ["entity"], folds), "train")
    sums = cut(linear.fold_sums(train), "sums")
    out = cut(linear.cross_validated(train, sums, penalties), "out-of-fold")
    keys = [*linear.TARGET, "penalty"]
    grid = scores.rmse_over_folds(out, keys)
    best = cut(linear.best_penalty(grid), "penalties")
    at_best = out.join(best, keys)
    residuals = at_best.withColumn("residual", F.col("y") - F.col("prediction"))
    performance = scores.normalised_rmse(
        scores.rmse_over_folds(at_best, linear.TARGET), scores.label_stats(at_best, linear.TARGET), linear.TARGET
    )
    return Run(chosen, grid, linear.refit(sums, best), residuals, performance)


def predictions(run: Run, panel: DataFrame, focus: DataFrame) -> DataFrame:
    """Focus cells that miss their target and have its predictor, with a 90 % band of residuals."""
    x = panel.join(focus, "entity", "left_semi").select(
        "period", "entity", F.col("indicator").alias("predictor"), F.col("value").alias("x")
    )
    known = panel.select("period", "entity", F.col("indicator").alias("target"))
    rows = run.chosen.join(x, ["period", "predictor"]).join(known, ["period", "entity", "target"], "left_anti")
    band = ranking.quantiles(run.residuals, linear.TARGET, "residual", {"low": 0.05, "high": 0.95})
    return linear.predict(rows, run.model, band)
