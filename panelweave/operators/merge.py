"""Joins that bring observations, predictions and importances together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["entity", "indicator", "period"]


def fill_cells(panel: DataFrame, predictions: DataFrame, focus: DataFrame) -> DataFrame:
    """Observed value where there is one, else the prediction with its bounds.

    Covers the focus entities in the (indicator, period) columns that have
    predictions. Entities known only from predictions come in through the full
    join. A cell with neither stays absent: nothing is invented.
    """
    targets = predictions.select("indicator", "period").distinct()
    observed = (
        panel.where(F.col("value").isNotNull())
        .join(focus, "entity", "left_semi")
        .join(targets, ["indicator", "period"], "left_semi")
    )
    given = predictions.select(*CELL, "prediction", "lower", "upper")
    imputed = F.col("value").isNull()
    return observed.join(given, CELL, "full_outer").select(
        *CELL,
        F.coalesce("value", "prediction").alias("value"),
        F.when(imputed, F.col("lower")).alias("lower"),
        F.when(imputed, F.col("upper")).alias("upper"),
        imputed.alias("is_imputed"),
    )


def append_unmatched(filled: DataFrame, predictions: DataFrame) -> DataFrame:
    """Adds the predictions of (entity, period) rows the matrix does not hold."""
    rows = filled.select("entity", "period").distinct()
    extra = predictions.join(rows, ["entity", "period"], "left_anti").select(
        *CELL,
        F.col("prediction").alias("value"),
        "lower",
        "upper",
        F.lit(True).alias("is_imputed"),
    )
    return filled.unionByName(extra)


def interval_alignment(values: DataFrame, lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Prediction, lower and upper matrices as one frame; each keeps its own nulls."""
    named = [
        frame.where("value is not null").select(*CELL, F.col("value").alias(name))
        for name, frame in (("value", values), ("lower", lower), ("upper", upper))
    ]
    out = named[0]
    for frame in named[1:]:
        out = out.join(frame, CELL, "left")
    return out


def category_importance(importance: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Importance summed per category; features without metadata count nowhere."""
    categories = dim.select(F.col("indicator").alias("feature"), "category").distinct()
    return (
        importance.join(categories, "feature")
        .groupBy(*keys, "category")
        .agg(F.sum("value").alias("value"))
    )


def lag_importance(importance: DataFrame, keys: list[str]) -> DataFrame:
    """Importance of a predictor: the sum over its lags."""
    from panelweave.functions import base_feature

    return (
        importance.withColumn("feature", base_feature("feature"))
        .groupBy(*keys, "feature")
        .agg(F.sum("value").alias("value"))
    )
