"""Operators along the periods of one (entity, indicator) series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interpolate_linear(panel: DataFrame, first: int, last: int) -> DataFrame:
    """Fills every series from ``first`` to ``last``: gaps linear, edges flat.

    Each observed cell writes the stretch up to its successor, so one window
    over the sparse panel is the only shuffle and no grid of cells is built. A
    series without any value has no row and stays empty.
    """
    series = Window.partitionBy("entity", "indicator").orderBy("period")
    step = panel.where(F.col("value").isNotNull()).select(
        "entity",
        "indicator",
        "period",
        "value",
        F.lag("period").over(series).alias("before"),
        F.lead("period").over(series).alias("after"),
        F.lead("value").over(series).alias("next_value"),
    )
    start = F.when(F.col("before").isNull(), F.lit(first)).otherwise(F.col("period"))
    stop = F.coalesce(F.col("after") - 1, F.lit(last))
    slope = (F.col("next_value") - F.col("value")) / (F.col("after") - F.col("period"))
    offset = F.col("p") - F.col("period")
    filled = F.when(
        (offset > 0) & F.col("after").isNotNull(), F.col("value") + slope * offset
    ).otherwise(F.col("value"))
    return (
        step.withColumn("p", F.explode(F.sequence(start, stop)))
        .select("entity", "indicator", F.col("p").alias("period"), filled.alias("value"))
        .where(F.col("period").between(first, last))
    )


def interpolate_poly(panel: DataFrame, first: int, last: int, order: int = 2) -> DataFrame:
    """Fills interior gaps with the polynomial through the ``order + 1`` nearest values.

    Local Lagrange form, not a global spline: the series (at most one value per
    period) is held as an array and each missing period is evaluated from its
    nearest known neighbours. Edges and short series stay as observed.
    """
    known = (
        panel.where(F.col("value").isNotNull())
        .groupBy("entity", "indicator")
        .agg(F.sort_array(F.collect_list(F.struct("period", "value"))).alias("known"))
    )
    low, high = F.col("known")[0]["period"], F.element_at("known", -1)["period"]
    cells = known.withColumn(
        "p", F.explode(F.sequence(F.greatest(low, F.lit(first)), F.least(high, F.lit(last))))
    )
    nearest = F.slice(
        F.sort_array(
            F.transform(
                "known",
                lambda c: F.struct(
                    F.abs(c["period"] - F.col("p")).alias("gap"),
                    c["period"].alias("period"),
                    c["value"].alias("value"),
                ),
            )
        ),
        1,
        order + 1,
    )

    def weight(c: Column) -> Column:
        return F.aggregate(
            "near",
            F.lit(1.0),
            lambda acc, o: F.when(o["period"] == c["period"], acc).otherwise(
                acc * (F.col("p") - o["period"]) / (c["period"] - o["period"])
            ),
        )

    value = F.aggregate("near", F.lit(0.0), lambda acc, c: acc + c["value"] * weight(c))
    return (
        cells.withColumn("near", nearest)
        .withColumn("value", F.when(F.col("near")[0]["gap"] == 0, F.col("near")[0]["value"])
                    .when(F.size("near") == order + 1, value))
        .where("value is not null")
        .select("entity", "indicator", F.col("p").alias("period"), "value")
    )


def lag_features(filled: DataFrame, lag: int = 3) -> DataFrame:
    """(entity, window, indicator, lag, value): the value ``lag`` periods before the window.

    A pure relabelling of the filled panel: each cell serves the ``lag`` windows
    after it.
    """
    return filled.withColumn("lag", F.explode(F.sequence(F.lit(1), F.lit(lag)))).select(
        "entity",
        (F.col("period") + F.col("lag")).alias("window"),
        "indicator",
        "lag",
        "value",
    )


def training_windows(
    targets: DataFrame, window: int = 15, lag: int = 3, first: int = 1970
) -> DataFrame:
    """One row per (target period, window) with its recency weight.

    Windows run from the target period down while ``window - lag`` stays within
    the history slice; the weight is 1, 1/2, 1/3, ...
    """
    lowest = F.greatest(F.lit(first), F.col("period") - window) + lag
    return (
        targets.where(lowest <= F.col("period"))
        .withColumn("window", F.explode(F.sequence(lowest, F.col("period"))))
        .withColumn("weight", recency_weight("period", "window"))
    )


def recency_weight(target: str, window: str) -> Column:
    return F.lit(1.0) / (1 + F.col(target) - F.col(window))


def labelled_windows(spine: DataFrame, windows: DataFrame, panel: DataFrame) -> DataFrame:
    """Rows of ``spine(entity, window, ...)`` for each of ``windows(window, target, ...)``, with the target's value ``y`` in the window.

    ``panel`` holds each cell once. An entity's values of a window are one map that meets the
    spine before windows multiply its rows, so no shuffle carries a row per target period.
    """
    labels = (
        panel.where("indicator is not null")
        .groupBy("entity", F.col("period").alias("window"))
        .agg(F.map_from_entries(F.collect_list(F.struct("indicator", "value"))).alias("labels"))
    )
    framed = spine.join(labels, ["entity", "window"], "left").join(F.broadcast(windows), "window")
    return framed.withColumn("y", F.try_element_at("labels", "target")).drop("labels")
