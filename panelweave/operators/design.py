"""Rows with a label and an array of predictors, for every target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.reshape import column_labels
from panelweave.session import cut

TARGET = ["period", "target"]


def strongest_predictors(stats: DataFrame, k: int, least: int = 10) -> DataFrame:
    """(period, target, predictor, strength, rank): the ``k`` most correlated other indicators on rows that have both.

    ``stats`` are the pair sums of ``pairs.pair_stats``; pairs with fewer than ``least`` common
    rows, or a constant side, do not count. Ties go by name.
    """

    def spread(a: str, b: str, ab: str) -> Column:
        return F.col(ab) - F.col(a) * F.col(b) / F.col("n")

    square = spread("sx", "sx", "sxx") * spread("sy", "sy", "syy")
    strength = F.round(F.abs(spread("sx", "sy", "sxy")) / F.sqrt(square), 9)
    ranked = stats.where((F.col("target") != F.col("predictor")) & (F.col("n") >= least) & (square > 0)).select(
        *TARGET, "predictor", strength.alias("strength")
    )
    order = Window.partitionBy(*TARGET).orderBy(F.desc("strength"), "predictor")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def predictor_lists(chosen: DataFrame) -> DataFrame:
    """(period, target, predictors): names in order of their rank."""
    names = F.transform(F.sort_array(F.collect_list(F.struct("rank", "predictor"))), lambda s: s["predictor"])
    return chosen.groupBy(*TARGET).agg(names.alias("predictors"))


def design(panel: DataFrame, chosen: DataFrame, k: int, spread: int | None = None) -> DataFrame:
    """(period, target, entity, y, x): each entity with any value in a period, for each of its targets.

    ``x`` holds the values of the target's ``k`` predictors by rank, null where missing; ``y`` is
    null where the target is. An entity's values of a period are one row, which meets the period's
    lists of predictors; a period's entities are dealt over ``spread`` parts (as many as shuffles
    have, unless given), so a long period is no hot key. Names are looked up once for an entity's row and
    once for a list; where they meet, values are taken by their places. The labels reach the driver.
    """
    parts = spread or int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = column_labels(panel.where("indicator is not null"), "indicator")
    order = F.array(*map(F.lit, labels)) if labels else F.array().cast("array<string>")

    def place(name: Column) -> Column:
        return F.nullif(F.array_position(order, name), F.lit(0).cast("long")).cast("int")

    cells = (
        panel.where("value is not null")
        .groupBy("period", "entity")
        .agg(F.map_from_entries(F.collect_list(F.struct("indicator", "value"))).alias("cells"))
        .select("period", "entity", F.transform(order, lambda name: F.try_element_at("cells", name)).alias("seen"))
        .withColumn("part", F.pmod(F.xxhash64("entity"), F.lit(parts)).cast("int"))
    )
    places = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda j: place(F.try_element_at("predictors", j)))
    lists = predictor_lists(chosen).select(*TARGET, place(F.col("target")).alias("own"), places.alias("places"))
    lists = cut(lists, "predictor-places").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return cells.join(lists, ["period", "part"]).select(
        "period",
        "target",
        "entity",
        F.try_element_at("seen", F.col("own")).alias("y"),
        F.transform("places", lambda at: F.try_element_at("seen", at)).alias("x"),
    )


def split(rows: DataFrame, focus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, predict): rows with a label, marked ``in_focus``; and focus rows without one."""
    marked = rows.join(focus.select("entity").distinct().withColumn("in_focus", F.lit(True)), "entity", "left").withColumn(
        "in_focus", F.coalesce("in_focus", F.lit(False))
    )
    return marked.where("y is not null"), marked.where("y is null and in_focus").drop("y", "in_focus")


def class_weighted(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums with the ``weight`` of their rows: 1 over the count of labelled rows on the same side of the focus."""
    side = Window.partitionBy(*keys, "in_focus")
    return sums.withColumn("weight", 1 / F.sum("n").over(side))
