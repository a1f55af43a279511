"""Statistics of indicator pairs over the rows that observe both.

Rows are cut into blocks of bounded size; each block contributes one small
matrix product, and only those sums are shuffled. No row ever meets another.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.ranking import split_hot

STATS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def cell_matrix(rows: pd.Series, labels: pd.Series, values: pd.Series):
    """(row ids, labels, values with 0 for missing, 0/1 mask) of long cells."""
    r, row_ids = pd.factorize(rows, sort=True)
    known = labels.notna().to_numpy()
    c, names = pd.factorize(labels[known], sort=True)
    x = np.zeros((len(row_ids), len(names)))
    mask = np.zeros_like(x)
    x[r[known], c] = values[known].to_numpy(dtype=float)
    mask[r[known], c] = 1.0
    return row_ids, names, x, mask


def pair_stats(
    cells: DataFrame,
    keys: Sequence[str],
    row: str,
    block_cells: int = 1 << 18,
    label_blocks: int = 1,
) -> DataFrame:
    """``(keys, target, predictor, n, sx, sy, sxx, syy, sxy)``; x is the target.

    ``label_blocks`` cuts very wide tables into column blocks, so that no task
    holds more than ``columns ** 2 / label_blocks`` sums.
    """
    keys = list(keys)
    blocks = split_hot(
        cells.where("value is not null").select(*keys, row, "indicator", "value"),
        keys, [row], block_cells,
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(label_blocks - 1))))
    types = {f.name: f.dataType.simpleString() for f in cells.schema.fields}
    schema = ", ".join(
        [f"{k} {types[k]}" for k in keys]
        + ["target string", "predictor string"]
        + [f"{s} double" for s in STATS]
    )

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        _, names, x, m = cell_matrix(pdf[row], pdf["indicator"], pdf["value"])
        part = pdf["part"].iloc[0]
        mine = np.array([zlib.crc32(s.encode()) % label_blocks == part for s in names])
        xt, mt, sq = x[:, mine].T, m[:, mine].T, x * x
        products = (mt @ m, xt @ m, mt @ x, sq[:, mine].T @ m, mt @ sq, xt @ x)
        i, j = np.nonzero(products[0])
        out = {k: pdf[k].iloc[0] for k in keys}
        out |= {"target": names[mine][i], "predictor": names[j]}
        out |= {s: p[i, j] for s, p in zip(STATS, products)}
        return pd.DataFrame(out, columns=[*keys, "target", "predictor", *STATS])

    return (
        blocks.groupBy(*keys, "salt", "part")
        .applyInPandas(sums, schema)
        .groupBy(*keys, "target", "predictor")
        .agg(*[F.sum(s).alias(s) for s in STATS])
    )


def filled_correlation(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """|correlation| of every ordered pair after each column is filled with its mean.

    Filled cells deviate by zero, so only rows that observe both contribute.
    """
    keys = list(keys)
    own = stats.where(F.col("target") == F.col("predictor")).select(
        *keys,
        F.col("target").alias("label"),
        (F.col("sx") / F.col("n")).alias("mean"),
        (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")).alias("square"),
    )
    x = own.withColumnsRenamed({"label": "target", "mean": "mx", "square": "qx"})
    y = own.withColumnsRenamed({"label": "predictor", "mean": "my", "square": "qy"})
    cov = (
        F.col("sxy") - F.col("mx") * F.col("sy") - F.col("my") * F.col("sx")
        + F.col("n") * F.col("mx") * F.col("my")
    )
    spread = F.sqrt(F.col("qx") * F.col("qy"))
    return (
        stats.where(F.col("target") != F.col("predictor"))
        .join(x, [*keys, "target"])
        .join(y, [*keys, "predictor"])
        .select(
            *keys,
            "target",
            "predictor",
            F.coalesce(F.abs(cov / F.nullif(spread, F.lit(0.0))), F.lit(0.0)).alias("strength"),
        )
    )


def nearest_features(stats: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most correlated other indicators of each target, ties by name."""
    ranked = filled_correlation(stats, keys).withColumn("strength", F.round("strength", 9))
    order = Window.partitionBy(*keys, "target").orderBy(F.desc("strength"), "predictor")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
