"""Missingness profiles and the validity screens built on them.

A cell is missing when the panel has no row (or a null) for it. Profiles count
what is there and subtract from the known extent, so nothing is densified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _extent(frame: DataFrame, column: str) -> Column:
    return frame.select(F.count_distinct(column)).scalar()


def missingness(panel: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Per (period, indicator) of the panel: absolute and percent missing over the entities.

    With ``entities`` only their cells count, and a column that none of them
    observes misses all of them.
    """
    universe = panel if entities is None else entities
    n = F.col("entities")
    counts = panel if entities is None else panel.join(
        entities.select("entity").distinct(), "entity", "left_semi"
    )
    counts = counts.groupBy("period", "indicator").agg(F.count("value").alias("observed"))
    if entities is not None:
        counts = panel.select("period", "indicator").distinct().join(
            counts, ["period", "indicator"], "left"
        ).withColumn("observed", F.coalesce("observed", F.lit(0)))
    return (
        counts.withColumn("entities", _extent(universe, "entity"))
        .select(
            "period",
            "indicator",
            (n - F.col("observed")).alias("absolute_missing"),
            ((n - F.col("observed")) * 100 / n).alias("percent_missing"),
        )
    )


def pair_missingness(panel: DataFrame) -> DataFrame:
    """Per (entity, indicator): nulls, values and percent missing over the periods."""
    n = F.col("periods")
    return (
        panel.groupBy("entity", "indicator")
        .agg(F.count("value").alias("total"))
        .withColumn("periods", _extent(panel, "period"))
        .select(
            "entity",
            "indicator",
            (n - F.col("total")).alias("absolute_missing"),
            "total",
            ((n - F.col("total")) * 100 / n).alias("percent_missing"),
        )
    )


def sparse_indicators(panel: DataFrame, percent: float = 90) -> DataFrame:
    """Indicators whose every series misses at least ``percent`` of the periods."""
    return (
        pair_missingness(panel)
        .groupBy("indicator")
        .agg(F.min("percent_missing").alias("best"))
        .where(F.col("best") >= percent)
        .select("indicator")
    )


def series_screen(panel: DataFrame, percent: float = 90) -> DataFrame:
    return panel.join(sparse_indicators(panel, percent), "indicator", "left_anti")


def rank_indicators(
    profile: DataFrame, percent: float = 90, target: bool = True
) -> DataFrame:
    """Indicators missing less than ``percent``; a target also misses something."""
    keep = F.col("percent_missing") < percent
    if target:
        keep = keep & (F.col("percent_missing") > 0)
    return profile.where(keep)


def train_counts(pair_counts: DataFrame) -> DataFrame:
    """Rows that train each target: its own observed count."""
    return pair_counts.where(F.col("target") == F.col("predictor")).select(
        "period", "target", F.col("n").alias("n_train")
    )


def predictors_on_train_rows(pair_counts: DataFrame, percent: float = 40) -> DataFrame:
    """Per (period, target): predictors missing less than ``percent`` of the train rows.

    ``pair_counts(period, target, predictor, n)`` counts the entities that
    observe both; the diagonal is the number of train rows.
    """
    joined = pair_counts.join(train_counts(pair_counts), ["period", "target"])
    missing = (F.col("n_train") - F.col("n")) * 100 / F.col("n_train")
    return joined.where((F.col("target") != F.col("predictor")) & (missing < percent)).select(
        "period", "target", "predictor", missing.alias("percent_missing")
    )


def missing_focus(panel: DataFrame, focus: DataFrame) -> DataFrame:
    """Per indicator: focus entities that never observe it."""
    return (
        panel.join(focus, "entity", "left_semi")
        .where("value is not null")
        .groupBy("indicator")
        .agg(F.count_distinct("entity").alias("seen"))
        .join(panel.select("indicator").distinct(), "indicator", "right")
        .withColumn("focus_size", _extent(focus, "entity"))
        .select(
            "indicator",
            (F.col("focus_size") - F.coalesce("seen", F.lit(0))).alias("missing_focus"),
        )
    )


def missing_year_profile(
    panel: DataFrame, start: int, end: int, window: int = 15, first: int = 1970, limit: float = 0.6
) -> DataFrame:
    """Per target period of ``[start, end)`` and indicator: its missing share over the slice.

    The slice holds periods ``max(first, t - window)`` to ``t``. The share's base
    is the number of entities that ever observe the indicator; a period without
    any row has share 1. Counts are taken once and serve every target period.
    """
    counts = panel.where("value is not null").groupBy("indicator", "period").agg(
        F.count("value").alias("seen")
    )
    seen = counts.groupBy("indicator").agg(
        F.map_from_entries(F.collect_list(F.struct("period", "seen"))).alias("seen")
    )
    base = panel.groupBy("indicator").agg(F.count_distinct("entity").alias("base"))
    slices = (
        seen.join(base, "indicator")
        .withColumn("period", F.explode(F.sequence(F.lit(start), F.lit(end - 1))))
        .withColumn("slice", F.sequence(F.greatest(F.lit(first), F.col("period") - window), "period"))
    )

    def where(test) -> Column:
        def share(p: Column) -> Column:
            return (F.col("base") - F.coalesce(F.try_element_at("seen", p), F.lit(0))) / F.col("base")

        return F.filter("slice", lambda p: test(share(p)))

    return slices.select(
        "period",
        "indicator",
        F.size("slice").alias("slice_size"),
        F.size(where(lambda s: s > limit)).alias("missing_years_count"),
        where(lambda s: s > 0).alias("missing_years"),
        where(lambda s: s == 0).alias("available_years"),
        where(lambda s: s < 1).alias("target_years"),
    )


def validity_check(
    panel: DataFrame,
    focus: DataFrame,
    start: int,
    end: int,
    focus_limit: int,
    year_share: float,
    window: int = 15,
    first: int = 1970,
    limit: float = 0.6,
) -> DataFrame:
    """Indicators observed well enough around each target period.

    Kept: fewer than ``focus_limit`` focus entities never observe it, and fewer
    than ``slice size / year_share`` periods of the slice are badly covered.
    ``target_validity`` says whether the target period has something to fill.
    """
    profile = missing_year_profile(panel, start, end, window, first, limit)
    return (
        profile.join(missing_focus(panel, focus), "indicator")
        .withColumn(
            "target_validity",
            F.array_contains("missing_years", F.col("period")) | (F.col("missing_focus") > 0),
        )
        .where(
            (F.col("missing_focus") < focus_limit)
            & (F.col("missing_years_count") < F.col("slice_size") / F.lit(year_share))
        )
        .drop("slice_size")
    )


def predictor_validity(
    panel: DataFrame, focus: DataFrame, start: int, end: int,
    focus_limit: int = 15, year_share: float = 2, **slice_args,
) -> DataFrame:
    """(period, indicator) pairs usable as predictors."""
    return validity_check(panel, focus, start, end, focus_limit, year_share, **slice_args).select(
        "period", "indicator"
    )


def target_validity(
    panel: DataFrame, focus: DataFrame, start: int, end: int,
    focus_limit: int = 50, year_share: float = 1.25, **slice_args,
) -> DataFrame:
    """(period, indicator) pairs worth imputing."""
    return (
        validity_check(panel, focus, start, end, focus_limit, year_share, **slice_args)
        .where("target_validity")
        .select("period", "indicator")
    )


def missing_audit(panel: DataFrame, dim: DataFrame, entities: DataFrame) -> DataFrame:
    """Per (dataset, period): cells of the panel's columns that the entities miss."""
    return (
        missingness(panel, entities)
        .join(dim.select("indicator", "dataset").distinct(), "indicator")
        .groupBy("dataset", "period")
        .agg(F.sum("absolute_missing").alias("missing_cells"))
        .withColumn("complete", F.col("missing_cells") == 0)
    )
