"""90 % prediction intervals: across trees, from the labels in a forest's leaves, and from bootstrapped residuals."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators import ranking

BAND = {"lower": 0.05, "upper": 0.95}
#: Families whose interval comes from residuals; of the others it comes from their trees.
BOOTSTRAPPED = frozenset(["linear", "elastic_net", "svr_linear", "svr_nu"])


def _quantile(values: Column, q: float) -> Column:
    """The linear-interpolated quantile of a sorted array."""
    at = (F.size(values) - 1) * F.lit(q)
    low, part = F.floor(at).cast("int"), at - F.floor(at)
    first = F.try_element_at(values, low + 1)
    return first + part * (F.coalesce(F.try_element_at(values, low + 2), first) - first)


def across_trees(votes: DataFrame, keys: Sequence[str], band: dict[str, float] = BAND) -> DataFrame:
    """(keys, prediction, lower, upper) of ``votes(keys, tree, value)``: mean and quantiles of each row's trees.

    A row has as many votes as the forest has trees, so they are one array.
    """
    sorted_ = F.sort_array(F.collect_list("value"))
    each = votes.groupBy(*keys).agg(F.avg("value").alias("prediction"), sorted_.alias("votes"))
    return each.select(*keys, "prediction", *(_quantile(F.col("votes"), q).alias(name) for name, q in band.items()))


def leaf_quantiles(labels: DataFrame, leaves: Sequence[str], band: dict[str, float] = BAND) -> DataFrame:
    """(leaves, lower, upper, n): exact quantiles of the training labels ``labels(leaves, y)`` in each leaf.

    A leaf may hold any share of the rows: its labels are ranked, not gathered.
    """
    counts = labels.where("y is not null").groupBy(*leaves).agg(F.count("y").alias("n"))
    return ranking.quantiles(labels, leaves, "y", band).join(counts, list(leaves))


def from_leaves(rows: DataFrame, keys: Sequence[str], index: DataFrame, leaves: Sequence[str]) -> DataFrame:
    """(keys, lower, upper) of ``rows(keys, leaves)``: the bounds of each row's leaves, averaged over its trees.

    Of each leaf the lower bound is at most the upper one, so they never cross. A row none of
    whose leaves has a label has no interval.
    """
    bounds = [F.avg(name).alias(name) for name in BAND]
    return rows.join(index, list(leaves)).groupBy(*keys).agg(*bounds)


def tail(share: np.ndarray, q: float, draws: int) -> np.ndarray:
    """Chance that the ``q`` quantile's order statistics of ``draws`` uniform draws lie below each share."""
    at = (draws - 1) * q
    low, part = math.floor(at), at - math.floor(at)
    j = np.arange(draws + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, draws + 1)))])
    choose = logs[draws] - logs[j] - logs[draws - j]
    out = np.zeros(len(share))
    out[share >= 1] = 1.0
    inner = np.flatnonzero((share > 0) & (share < 1))
    for piece in np.array_split(inner, max(1, len(inner) // 10_000)):
        p = share[piece, None]
        mass = np.exp(choose + j * np.log(p) + (draws - j) * np.log1p(-p))
        tails = np.flip(np.cumsum(np.flip(mass, 1), 1), 1)
        out[piece] = (1 - part) * tails[:, low + 1] + part * tails[:, min(low + 2, draws)]
    return out


def bootstrap_offsets(
    residuals: DataFrame, keys: Sequence[str], value: str = "residual", draws: int = 100, band: dict[str, float] = BAND
) -> DataFrame:
    """(keys, lower, upper): the expected quantiles of ``draws`` resamples of the residuals, without resampling.

    At each position the quantile over ``draws`` resamples is one of an independent draw, and the
    mean over positions estimates its expectation, which binomial weights on the sorted residuals
    give exactly. Residuals are ranked over slices, so a large group is never in one task; fewer
    than two have no interval.
    """
    ranked = ranking.row_numbers(residuals.where(F.col(value).isNotNull()).withColumn("tie", F.monotonically_increasing_id()),
                                 keys, [value, "tie"]).where("group_rows >= 2")
    names = list(band)

    def weights(position: pd.Series, rows: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(position), len(names)))
        at, n = position.to_numpy(float), rows.to_numpy(float)
        for c, name in enumerate(names):
            out[:, c] = tail(at / n, band[name], draws) - tail((at - 1) / n, band[name], draws)
        return pd.DataFrame(out, columns=names)

    of = F.pandas_udf(weights, ", ".join(f"{name} double" for name in names))
    return (
        ranked.withColumn("w", of("position", "group_rows"))
        .groupBy(*keys)
        .agg(*[F.sum(F.col("w")[name] * F.col(value)).alias(name) for name in names])
    )


def source_of(family: str) -> str:
    """Where a family's interval comes from: ``residuals`` or ``trees``."""
    return "residuals" if family in BOOTSTRAPPED else "trees"


def skipped(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, reason) of the targets whose ``n`` residuals are too few for a bootstrap."""
    return counts.where(F.col("n") < 2).select(*keys, F.lit("too few rows").alias("reason"))


def fallback(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bounds of ``first`` where it has them, else those of ``second``; ``source`` tells which."""
    a = first.select(*keys, *(F.col(n).alias(f"{n}_1") for n in BAND))
    b = second.select(*keys, *(F.col(n).alias(f"{n}_2") for n in BAND))
    has = F.col("lower_1").isNotNull() & F.col("upper_1").isNotNull()
    return a.join(b, list(keys), "full").select(
        *keys,
        *(F.when(has, F.col(f"{n}_1")).otherwise(F.col(f"{n}_2")).alias(n) for n in BAND),
        F.when(has, "first").when(F.col("lower_2").isNotNull(), "second").alias("source"),
    )
