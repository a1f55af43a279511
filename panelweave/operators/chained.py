"""Chained imputation of a whole panel by penalised linear models, as a fixpoint over written states.

A row of the panel's matrix is one row with an array of its values in the order of
the columns; missing cells start from their column's mean. Each round refits every
incomplete column on its most correlated others and predicts its missing cells
anew. A round reads rows once for the sums of products of all columns, and once to
predict: no column is a job of its own, and only sums and models leave the tasks.
Columns may be taken in waves, from those that miss least to those that miss most;
a wave sees what the waves before it predicted in the same round.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import gram, pairs, ranking
from panelweave.session import cut

#: Bytes of the models of all columns, which every task holds. They grow with columns, never with rows.
MOST_MODELS = 64 << 20
MODEL = "column int, fold int, n double, intercept double, coefficients array<double>, scaled array<double>"


@dataclass
class Imputed:
    """A finished run: the state, the column names, their neighbours, and the last round's models of all rows and of all folds but one."""

    keys: list[str]
    names: list[str]
    neighbours: list[list[int]]
    state: DataFrame
    models: DataFrame
    rounds: int
    changes: list[float]
    before: DataFrame


def matrix(panel: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, seen): the values of each row in the order of ``names``, null where missing."""
    cells = panel.where("value is not null").groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("indicator", "value"))).alias("cells")
    )
    order = F.array(*map(F.lit, names))
    return cells.select(*keys, F.transform(order, lambda name: F.try_element_at("cells", name)).alias("seen"))


def columns_of(panel: DataFrame) -> list[tuple[str, float]]:
    """(name, mean) of each column with a value, the most complete first, then by name. A row for each column reaches the driver."""
    found = panel.groupBy("indicator").agg(F.count("value").alias("n"), F.avg("value").alias("mean"))
    return [(r["indicator"], r["mean"]) for r in found.where("n > 0").orderBy(F.desc("n"), "indicator").collect()]


def neighbours_of(panel: DataFrame, keys: Sequence[str], names: Sequence[str], k: int) -> list[list[int]]:
    """Of each column the places of its ``k`` most correlated others, missing cells at their means; ties by name."""
    rows = panel.select(F.concat_ws("|", *(F.col(c).cast("string") for c in keys)).alias("row"), "indicator", "value")
    near = pairs.nearest_features(pairs.pair_stats(rows, [], "row"), [], k)
    at, found = {name: j for j, name in enumerate(names)}, [[] for _ in names]
    for r in near.orderBy("target", "rank").collect():
        found[at[r["target"]]].append(at[r["predictor"]])
    return found


def _arrays(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _sums(state: DataFrame, wave: Sequence[int], neighbours: Sequence[Sequence[int]]) -> DataFrame:
    """(column, fold, n, width, sums) of (1, neighbours, column) over the rows that observe the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            seen, value = _arrays(batch.column(0)), _arrays(batch.column(1))
            folds = batch.column(2).to_numpy(zero_copy_only=False)
            for fold in np.unique(folds).tolist():
                mine = np.flatnonzero(folds == fold)
                # columns in one stretch each, so that a column's few others are not gathered row by row
                there, column = ~np.isnan(seen[mine].T), np.ascontiguousarray(value[mine].T)
                for j in wave:
                    z = np.vstack([np.ones(there[j].sum()), *(column[p][there[j]] for p in [*neighbours[j], j])])
                    held[j, fold] = held.get((j, fold), 0.0) + z @ z.T
        if held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([j for j, _ in held], pa.int32()),
                    pa.array([f for _, f in held], pa.int32()),
                    pa.array([s[0, 0] for s in held.values()], pa.float64()),
                    pa.array([len(s) for s in held.values()], pa.int32()),
                    pa.array([s[np.triu_indices(len(s))] for s in held.values()], pa.list_(pa.float64())),
                ],
                names=["column", "fold", "n", "width", "sums"],
            )

    return state.select("seen", "value", "fold").mapInArrow(
        run, "column int, fold int, n double, width int, sums array<double>"
    )


def _models(sums: DataFrame, alpha: float, apart: bool) -> DataFrame:
    """Models of each column on all rows (fold -1) and, if ``apart``, on all folds but one."""

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        plain = gram.unpacked(pdf["sums"].tolist(), int(pdf["width"].iloc[0]))
        folds = pdf["fold"].to_numpy()
        inside = [(-1, np.ones(len(folds), bool)), *((f, folds != f) for f in np.unique(folds).tolist() if apart)]
        inside = [(f, at) for f, at in inside if plain[at][:, 0, 0].sum() > 0]
        if not inside:
            return pd.DataFrame(columns=["column", "fold", "n", "intercept", "coefficients", "scaled"])
        whole = np.stack([plain[at].sum(axis=0) for _, at in inside])
        intercept, slopes, scaled = gram.fit(whole, 0.0, alpha)
        return pd.DataFrame({
            "column": key[0], "fold": [f for f, _ in inside], "n": whole[:, 0, 0], "intercept": intercept,
            "coefficients": slopes.tolist(), "scaled": scaled.tolist(),
        })

    return sums.groupBy("column").applyInPandas(solve, MODEL)


def _predict(state: DataFrame, models: dict[int, tuple[float, list[float]]], neighbours: Sequence[Sequence[int]]) -> DataFrame:
    """The state with the missing cells of the modelled columns predicted, and the largest ``change`` of each row."""
    size = sum(8 * (len(c) + 1) for _, c in models.values())
    if size > MOST_MODELS:
        raise ValueError(f"the models of {len(models)} columns take {size} bytes; cut the columns into waves")
    columns = list(state.columns)
    places = [columns.index(c) for c in ("seen", "value", "change")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, value = _arrays(batch.column(places[0])), _arrays(batch.column(places[1]))
            new = value.copy()
            for j, (intercept, slopes) in models.items():
                gone = np.isnan(seen[:, j])
                new[gone, j] = intercept + value[np.ix_(gone, neighbours[j])] @ np.array(slopes)
            change = np.abs(new - value).max(axis=1, initial=0.0)
            arrays = list(batch.columns)
            arrays[places[1]] = pa.ListArray.from_arrays(
                pa.array(np.arange(0, new.size + 1, new.shape[1]), pa.int32()), pa.array(new.ravel())
            )
            arrays[places[2]] = pa.array(np.maximum(change, batch.column(places[2]).to_numpy()))
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return state.mapInArrow(run, state.schema)


def impute(
    panel: DataFrame,
    keys: Sequence[str] = ("entity", "period"),
    k: int = 10,
    rounds: int = 10,
    tol: float = 1e-3,
    alpha: float = 0.001,
    waves: int = 1,
    folds: int = 3,
) -> Imputed:
    """Fills every cell of the matrix of ``panel(keys, indicator, value)``.

    Rows are those with a value, columns those with a value in any row. Stops after ``rounds``, or
    when no cell changes by ``tol`` times the largest absolute observed value. ``waves`` of 1 predicts
    all columns from the round before; as many as columns is strictly one after the other.
    """
    keys = list(keys)
    panel = cut(panel.select(*keys, "indicator", "value").where("value is not null"), "chained-panel")
    columns = columns_of(panel)
    names, means = [n for n, _ in columns], [m for _, m in columns]
    neighbours = neighbours_of(panel, keys, names, k)
    filled = F.zip_with("seen", F.array(*map(F.lit, means)) if means else F.array().cast("array<double>"), lambda v, m: F.coalesce(v, m))
    state = ranking.kfold(matrix(panel, keys, names), [], keys, folds)
    state = cut(state.select(*keys, "fold", "seen", filled.alias("value"), F.lit(0.0).alias("change")), "chained-0")
    largest = panel.agg(F.max(F.abs("value"))).first()[0] or 0.0
    cuts = [w.tolist() for w in np.array_split(np.arange(len(names)), max(1, min(waves, len(names))))]
    done, changes, before = 0, [], state
    while names and done < rounds:
        before, start = state, True
        for wave in cuts:
            models = _models(_sums(state, wave, neighbours), alpha, False)
            found = {r["column"]: (r["intercept"], r["coefficients"]) for r in models.collect()}
            base = state.withColumn("change", F.lit(0.0)) if start else state
            state, start = cut(_predict(base, found, neighbours), f"chained-{done + 1}"), False
        done += 1
        changes.append(state.agg(F.max("change")).first()[0] or 0.0)
        if changes[-1] < tol * largest:
            break
    models = cut(_models(_sums(before, range(len(names)), neighbours), alpha, True), "chained-models")
    return Imputed(keys, names, neighbours, state, models, done, changes, before)


def cells(run: Imputed) -> DataFrame:
    """(keys, indicator, value, is_imputed) of every cell."""
    names = F.array(*map(F.lit, run.names)) if run.names else F.array().cast("array<string>")
    each = F.explode(F.arrays_zip(names.alias("indicator"), F.col("value"), F.col("seen"))).alias("c")
    return run.state.select(*run.keys, each).select(
        *run.keys, "c.indicator", "c.value", F.col("c.seen").isNull().alias("is_imputed")
    )


def residuals(run: Imputed) -> DataFrame:
    """(indicator, y, prediction, residual) of every observed cell, predicted from the last round's inputs without its fold."""
    models = run.models.where("fold >= 0").select("column", "fold", "intercept", "coefficients")
    kept: dict[int, dict[int, tuple]] = {}
    for r in models.collect():
        kept.setdefault(r["fold"], {})[r["column"]] = (r["intercept"], np.array(r["coefficients"]))
    names, neighbours = run.names, run.neighbours

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, value = _arrays(batch.column(0)), _arrays(batch.column(1))
            folds = batch.column(2).to_numpy(zero_copy_only=False)
            for fold in np.unique(folds).tolist():
                for j, (intercept, slopes) in kept.get(fold, {}).items():
                    at = (folds == fold) & ~np.isnan(seen[:, j])
                    if at.any():
                        guess = intercept + value[np.ix_(at, neighbours[j])] @ slopes
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([names[j]] * len(guess)), pa.array(seen[at, j]), pa.array(guess), pa.array(seen[at, j] - guess)],
                            names=["indicator", "y", "prediction", "residual"],
                        )

    return run.before.select("seen", "value", "fold").mapInArrow(
        run_, "indicator string, y double, prediction double, residual double"
    )


def importances(run: Imputed) -> DataFrame:
    """(target, predictor, coefficient, importance) of the last round's models; importance is the scaled coefficient's size."""
    names = F.array(*map(F.lit, run.names))
    places = run.state.sparkSession.createDataFrame(
        [(j, near) for j, near in enumerate(run.neighbours)], "column int, near array<int>"
    )
    each = F.explode(F.arrays_zip("near", "coefficients", "scaled")).alias("c")
    return run.models.where("fold = -1").join(places, "column").select("column", each).select(
        F.element_at(names, F.col("column") + 1).alias("target"),
        F.element_at(names, F.col("c.near") + 1).alias("predictor"),
        F.col("c.coefficients").alias("coefficient"),
        F.abs("c.scaled").alias("importance"),
    )
