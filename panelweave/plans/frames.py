"""Task frames: what every (period, target) trains on and predicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import profile
from panelweave.operators.pairs import pair_stats


def eligibility(
    panel: DataFrame,
    focus: DataFrame,
    target_percent: float = 90,
    predictor_percent: float = 40,
    folds: int = 5,
) -> DataFrame:
    """Every target with its counts and, where it cannot be trained, the reason.

    Cells to predict are counted, not listed: focus size minus focus observations.
    """
    tasks = ["period", "target"]
    targets = profile.rank_indicators(profile.missingness(panel), target_percent).select(
        "period", F.col("indicator").alias("target")
    )
    counts = pair_stats(panel, ["period"], "entity").select("period", "target", "predictor", "n")
    predictors = (
        profile.predictors_on_train_rows(counts, predictor_percent)
        .groupBy(*tasks)
        .agg(F.count("*").alias("predictors"))
    )
    observed = (
        panel.join(focus, "entity", "left_semi")
        .groupBy("period", F.col("indicator").alias("target"))
        .agg(F.count("value").alias("seen"))
    )
    size = focus.select(F.count_distinct("entity")).scalar()
    reason = (
        F.when(F.col("n_train") < folds, "too few rows")
        .when(F.col("predictors") == 0, "no predictor")
        .when(F.col("to_predict") == 0, "nothing to predict")
    )
    return (
        targets.join(profile.train_counts(counts), tasks)
        .join(predictors, tasks, "left")
        .join(observed, tasks, "left")
        .withColumn("focus_size", size)
        .select(
            *tasks,
            F.col("n_train").cast("long").alias("n_train"),
            F.coalesce("predictors", F.lit(0)).alias("predictors"),
            (F.col("focus_size") - F.coalesce("seen", F.lit(0))).alias("to_predict"),
        )
        .withColumn("reason", reason)
    )
