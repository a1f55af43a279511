"""Penalised linear models of all targets at once, from grouped sums.

A target is a (period, indicator); its model has one predictor. Sums per fold
are all that training needs: a fold's complement is the whole minus the fold,
and a penalty only shrinks the slope, so rows are read once for the sums and
once for the residuals, whatever the number of targets, folds and penalties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET = ["period", "target"]
SUMS = ["n", "sx", "sy", "sxx", "sxy"]


def strongest_predictor(stats: DataFrame, least: int = 10) -> DataFrame:
    """(period, target, predictor, strength): the most correlated other indicator on rows that have both.

    ``stats`` are the pair sums of ``pairs.pair_stats``; pairs with fewer than
    ``least`` common rows, or a constant side, do not count. Ties go by name.
    """
    def spread(a: str, b: str, ab: str) -> Column:
        return F.col(ab) - F.col(a) * F.col(b) / F.col("n")

    square = spread("sx", "sx", "sxx") * spread("sy", "sy", "syy")
    strength = F.round(F.abs(spread("sx", "sy", "sxy")) / F.sqrt(square), 9)
    ranked = stats.where((F.col("target") != F.col("predictor")) & (F.col("n") >= least) & (square > 0)).select(
        *TARGET, "predictor", strength.alias("strength")
    )
    order = Window.partitionBy(*TARGET).orderBy(F.desc("strength"), "predictor")
    return ranked.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def training_rows(panel: DataFrame, chosen: DataFrame) -> DataFrame:
    """(period, target, entity, x, y): rows that observe a target and its predictor."""
    y = panel.select("period", "entity", F.col("indicator").alias("target"), F.col("value").alias("y"))
    x = panel.select("period", "entity", F.col("indicator").alias("predictor"), F.col("value").alias("x"))
    return y.join(chosen.select(*TARGET, "predictor"), TARGET).join(x, ["period", "entity", "predictor"]).select(
        *TARGET, "entity", "x", "y"
    )


def fold_sums(train: DataFrame) -> DataFrame:
    """The sums of each fold, and in ``all_*`` those of all folds of the target."""
    x, y = F.col("x"), F.col("y")
    sums = train.groupBy(*TARGET, "fold").agg(
        F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"),
    )
    whole = Window.partitionBy(*TARGET)
    return sums.select("*", *(F.sum(s).over(whole).alias(f"all_{s}") for s in SUMS))


def line(n: Column, sx: Column, sy: Column, sxx: Column, sxy: Column, penalty: Column) -> tuple[Column, Column]:
    """(slope, intercept); the penalty is in units of the predictor's own spread."""
    spread = sxx - sx * sx / n
    slope = F.coalesce((sxy - sx * sy / n) / F.nullif(spread, F.lit(0.0)), F.lit(0.0)) / (1 + penalty)
    return slope, (sy - slope * sx) / n


def cross_validated(train: DataFrame, sums: DataFrame, penalties: Sequence[float]) -> DataFrame:
    """Train rows with an out-of-fold ``prediction`` for each penalty."""
    rest = [F.col(f"all_{s}") - F.col(s) for s in SUMS]
    grid = sums.where("all_n > n").withColumn("penalty", F.explode(F.array(*map(F.lit, penalties))))
    slope, intercept = line(*rest, F.col("penalty"))
    grid = grid.select(*TARGET, "fold", "penalty", slope.alias("slope"), intercept.alias("intercept"))
    return train.join(grid, [*TARGET, "fold"]).select(
        *TARGET, "entity", "fold", "penalty", "y", (F.col("slope") * F.col("x") + F.col("intercept")).alias("prediction")
    )


def best_penalty(scores: DataFrame) -> DataFrame:
    """The penalty of least ``rmse`` for each target, the smaller of equals."""
    return scores.groupBy(*TARGET).agg(
        F.min(F.struct(F.round("rmse", 6).alias("r"), "penalty")).alias("best")
    ).select(*TARGET, F.col("best.penalty").alias("penalty"))


def refit(sums: DataFrame, best: DataFrame) -> DataFrame:
    """(period, target, n, penalty, slope, intercept) on all train rows, with the chosen penalty."""
    whole = sums.select(*TARGET, *(F.col(f"all_{s}").alias(s) for s in SUMS)).dropDuplicates(TARGET)
    slope, intercept = line(*(F.col(s) for s in SUMS), F.col("penalty"))
    return whole.join(best, TARGET).select(
        *TARGET, "n", "penalty", slope.alias("slope"), intercept.alias("intercept")
    )


def predict(rows: DataFrame, model: DataFrame, band: DataFrame) -> DataFrame:
    """Predictions of ``rows(period, target, entity, x)`` with the residuals' band around them."""
    fitted = F.col("slope") * F.col("x") + F.col("intercept")
    return rows.join(model, TARGET).join(band, TARGET).select(
        *TARGET, "entity", fitted.alias("prediction"),
        (fitted + F.col("low")).alias("lower"), (fitted + F.col("high")).alias("upper"),
    )
