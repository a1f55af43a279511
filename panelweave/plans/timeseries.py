"""The time-series run: lagged predictors over sliding windows, recency weights, a model for each target period and indicator.

A window's rows serve every target period whose history holds it, with another
weight. So sums of products are taken once per (window, target), and a period's
sums are the weighted total of its windows': rows are not repeated per period.
Folds part entities, so no entity is on both sides of a fold in another window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import design, gram, ranking, scores, series
from panelweave.operators.pairs import pair_stats
from panelweave.session import cut

TARGET = design.TARGET
RIDGES = tuple((0.0, alpha) for alpha in (0.0001, 0.001, 0.01, 0.1))


@dataclass
class Run:
    """What a run leaves: predictors of each target by rank, and tables of all (period, target)."""

    chosen: DataFrame
    lag: int
    grid: DataFrame
    model: DataFrame
    residuals: DataFrame
    predictions: DataFrame


def pooled_predictors(panel: DataFrame, k: int, least: int = 10) -> DataFrame:
    """(target, predictor, rank): the ``k`` other indicators most correlated over all (entity, period) that have both."""
    rows = panel.select(
        F.lit(0).alias("period"), F.concat_ws("|", F.col("entity").cast("string"), F.col("period").cast("string")).alias("row"),
        "indicator", "value",
    )
    return design.strongest_predictors(pair_stats(rows, ["period"], "row"), k, least).drop("period", "strength")


def window_rows(
    panel: DataFrame, focus: DataFrame, chosen: DataFrame, k: int, lag: int, first: int, last: int
) -> DataFrame:
    """(window, target, entity, y, x): each focus entity in each window from ``first + lag`` to ``last``, for each target.

    ``x`` holds, predictor by predictor, the interpolated values 1 to ``lag`` periods before the
    window; ``y`` is the target's observed value in it. Entities without any value have rows of nulls.
    """
    seen = panel.join(focus.select("entity").distinct(), "entity", "left_semi")
    lagged = series.lag_features(series.interpolate_linear(seen, first, last), lag)
    name = F.concat(F.col("lag").cast("string"), F.lit("#"), "indicator")
    cells = lagged.select("entity", "window", name.alias("name"), "value").unionByName(
        seen.where("value is not null").select(
            "entity", F.col("period").alias("window"), F.concat(F.lit("0#"), "indicator").alias("name"), "value"
        )
    )
    spine = focus.select("entity").distinct().select(
        "entity", F.explode(F.sequence(F.lit(first + lag), F.lit(last))).alias("window"),
        F.lit("").alias("name"), F.lit(0.0).alias("value"),
    )
    parts = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = (
        spine.unionByName(cells)
        .where(F.col("window").between(first + lag, last))
        .groupBy("entity", "window")
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("cells"))
        .withColumn("part", F.pmod(F.xxhash64("entity", "window"), F.lit(parts)).cast("int"))
    )
    names = F.transform(F.sort_array(F.collect_list(F.struct("rank", "predictor"))), lambda s: s["predictor"])
    lists = chosen.groupBy("target").agg(names.alias("predictors"))
    lists = lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def at(step, j):
        return F.try_element_at("cells", F.concat(step.cast("string"), F.lit("#"), F.try_element_at("predictors", j)))

    each = F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(k)), lambda j: F.transform(F.sequence(F.lit(1), F.lit(lag)), lambda step: at(step, j))
    ))
    return wide.join(lists, "part").select(
        "window", "target", "entity", F.try_element_at("cells", F.concat(F.lit("0#"), "target")).alias("y"), each.alias("x")
    )


def fits(
    sums: DataFrame, tasks: DataFrame, window: int, lag: int, first: int, penalties: Sequence[tuple[float, float]]
) -> DataFrame:
    """``gram.FITS`` of each (period, target) of ``tasks(period, target, allowed)``; a null ``allowed`` allows every predictor.

    All windows of a target are one group: as many matrices as it has windows, folds and tasks.
    """
    lists = tasks.groupBy("target").agg(F.collect_list(F.struct("period", "allowed")).alias("tasks"))
    kind = sums.schema["target"].dataType.simpleString()

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        raw = gram.unpacked(pdf["sums"].tolist(), int(pdf["width"].iloc[0]))
        windows, folds = pdf["window"].to_numpy(), {s: pdf[s].to_numpy() for s in ("fold", "third")}
        out = []
        for task in pdf["tasks"].iloc[0]:
            period, allowed = task["period"], task["allowed"]
            mine = (windows <= period) & (windows >= max(first, period - window) + lag)
            if not mine.any():
                continue
            use = None if allowed is None else [int(p) * lag + step for p in allowed for step in range(lag)]
            weight = 1.0 / (1 + period - windows[mine])
            found = gram.fit_rows(raw[mine], weight, {s: v[mine] for s, v in folds.items()}, penalties, use)
            out += [(int(period), key[0], *row) for row in found]
        return pd.DataFrame(out, columns=["period", "target", *(c.split()[0] for c in gram.FITS.split(", "))])

    return sums.join(lists, "target").groupBy("target").applyInPandas(solve, f"period int, target {kind}, {gram.FITS}")


def allowed_positions(tasks: DataFrame, chosen: DataFrame, valid: DataFrame | None) -> DataFrame:
    """``tasks(period, target)`` with ``allowed``: the places in the target's list of the predictors valid in the period."""
    if valid is None:
        return tasks.withColumn("allowed", F.lit(None).cast("array<int>"))
    usable = tasks.join(chosen, "target").join(
        valid.select("period", F.col("indicator").alias("predictor")), ["period", "predictor"]
    )
    places = usable.groupBy(*TARGET).agg(F.collect_list((F.col("rank") - 1).cast("int")).alias("allowed"))
    return tasks.join(places, TARGET)


def time_series(
    panel: DataFrame,
    focus: DataFrame,
    targets: DataFrame,
    first: int,
    last: int,
    valid: DataFrame | None = None,
    k: int = 10,
    lag: int = 3,
    window: int = 15,
    penalties: Sequence[tuple[float, float]] = RIDGES,
) -> Run:
    """Trains a model of each of ``targets(period, indicator)`` on focus rows; predicts the period's cells without a value.

    ``valid(period, indicator)`` lists the predictors usable in a period; a target without any has no
    model. Missing features take the mean of the target's labelled rows.
    """
    panel = cut(panel.where("value is not null"), "panel")
    focus = cut(focus.select("entity").distinct(), "focus")
    seen = panel.join(focus, "entity", "left_semi")
    chosen = cut(pooled_predictors(seen, k), "predictors")
    folds = ranking.kfold(ranking.kfold(focus, [], ["entity"], 5), [], ["entity"], 3, into="third")
    rows = window_rows(panel, focus, chosen, k, lag, first, last).join(cut(folds, "folds"), "entity")
    rows = cut(rows, "windows")
    sums = gram.products(rows.where("y is not null"), ["window", "target"], ["fold", "third"])
    tasks = targets.select("period", F.col("indicator").alias("target")).distinct()
    tasks = cut(allowed_positions(tasks, chosen, valid), "tasks")
    fitted = cut(fits(cut(sums, "sums"), tasks, window, lag, first, penalties), "fits")
    grid = gram.grid(fitted, TARGET)
    at_best = cut(fitted.join(gram.best(grid, TARGET), [*TARGET, "l1", "alpha"]), "best")
    model = at_best.where("split = 'all'")
    apart = at_best.where("split = 'third'").select(
        *TARGET, F.col("fold").alias("third"), "intercept", "coefficients", "fill"
    )
    windows = series.training_windows(targets.select("period", "indicator").distinct(), window, lag, first).select(
        "period", F.col("indicator").alias("target"), "window"
    )
    spread = rows.where("y is not null").join(windows, ["window", "target"])
    residuals = gram.predicted(spread, apart, [*TARGET, "third"], [*TARGET, "window", "entity", "y"]).withColumn(
        "residual", F.col("y") - F.col("prediction")
    )
    residuals = cut(residuals, "residuals")
    band = ranking.quantiles(residuals, TARGET, "residual", {"low": 0.05, "high": 0.95})
    rest = rows.where("y is null").withColumn("period", F.col("window"))
    predictions = gram.predicted(rest, model, TARGET, [*TARGET, "entity"]).join(band, TARGET).select(
        *TARGET, "entity", "prediction",
        (F.col("prediction") + F.col("low")).alias("lower"), (F.col("prediction") + F.col("high")).alias("upper"),
    )
    return Run(chosen, lag, grid, model, residuals, predictions)


def performance(run: Run) -> DataFrame:
    """(period, target, rmse, nrmse, r2)."""
    least = run.grid.groupBy(*TARGET).agg(F.min("rmse").alias("rmse"))
    nrmse = scores.normalised_rmse(least, scores.label_stats(run.residuals, TARGET), TARGET)
    return nrmse.join(scores.out_of_fold_r2(run.residuals, TARGET), TARGET)


def importances(run: Run, k: int = 10) -> DataFrame:
    """(period, target, predictor, importance, rank): sizes of the scaled coefficients, summed over lags; the first ``k``."""
    each = run.model.select(*TARGET, F.posexplode("scaled").alias("at", "scaled"))
    summed = each.groupBy(*TARGET, (F.floor(F.col("at") / run.lag) + 1).cast("int").alias("rank")).agg(
        F.sum(F.abs("scaled")).alias("importance")
    )
    named = summed.join(run.chosen, ["target", "rank"]).drop("rank")
    return ranking.top_k(named, TARGET, [F.round("importance", 9).desc(), "predictor"], k)


