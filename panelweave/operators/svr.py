"""Linear support vector regression of all targets at once, by iterated weighted ridges.

In standard units a model has the least half square of its coefficients plus ``cost``
times the sum of its errors beyond a tube of half width ``epsilon`` (or of their
squares, halved). A step reweights each row outside the tube by cost over its error,
solves the weighted ridge, and goes the share of the way there that lowers the
objective most. One reading of the rows per step gives the objective and the next
sums for every share at once. In the nu form the tube is refreshed before each step
to the quantile of the absolute residuals that leaves a fraction ``nu`` outside.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import gram, ranking
from panelweave.session import cut

#: Rows of a target that one partition holds at most, about.
PART = 1 << 17
SHARES = (1.0, 0.5, 0.2, 0.05, 0.01)
LEAST = 1e-6
#: Bytes of all models, which every task holds. They grow with targets, never with rows.
MOST_MODELS = 64 << 20


@dataclass
class Scaled:
    """A target's constants: means and deviations of predictors and label, and what fills missing values."""

    fill: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    n: float


def _scales(rows: DataFrame, keys: Sequence[str]) -> dict[tuple, Scaled]:
    """A row for each target reaches the driver."""
    sums = gram.products(rows, keys, [])
    at = "fill array<double>, mean array<double>, deviation array<double>, n double"

    def solve(pdf: pd.DataFrame) -> list[tuple]:
        fill, plain = gram.filled(gram.unpacked(pdf["sums"].tolist(), int(pdf["width"].iloc[0])))
        whole = plain.sum(axis=0)[None]
        mean, deviation, _ = gram.standardised(whole)
        return [(fill.tolist(), mean[0].tolist(), deviation[0].tolist(), float(whole[0, 0, 0]))]

    found = gram.grouped(sums, keys, at, solve).collect()
    return {
        tuple(r[k] for k in keys): Scaled(*(np.array(r[c]) for c in ("fill", "mean", "deviation")), r["n"]) for r in found
    }


#: Rows of a block, which is one row of the table that steps read.
BLOCK = 1 << 12


def _blocks(rows: DataFrame, keys: Sequence[str], scales: dict[tuple, Scaled]) -> DataFrame:
    """(keys, size, z, y): the standardised predictors and labels of up to ``BLOCK`` rows of a target as bytes of doubles."""
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        kinds: list = []

        def packed(key: tuple) -> pa.RecordBatch:
            z, y = (np.concatenate(p) for p in zip(*held.pop(key)))
            arrays = [pa.array([key[c]], kinds[c]) for c in range(width)]
            arrays += [pa.array([len(y)], pa.int32()), pa.array([z.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=[*keys, "size", "z", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds[:] = [batch.schema.field(k).type for k in range(width)]
            x = batch.column(width + 1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            y = batch.column(width).to_numpy(zero_copy_only=False)
            names = list(zip(*(batch.column(k).to_pylist() for k in range(width))))
            groups: dict[tuple, list[int]] = {}
            for row, key in enumerate(names):
                groups.setdefault(key, []).append(row)
            for key, at in groups.items():
                s = scales[key]
                part = np.where(np.isnan(x[at]), s.fill, x[at]) - s.mean[:-1]
                z = np.divide(part, s.deviation[:-1], out=np.zeros_like(part), where=s.deviation[:-1] > 0)
                held.setdefault(key, []).append((z, (y[at] - s.mean[-1]) / (s.deviation[-1] or 1.0)))
                if sum(len(v) for _, v in held[key]) >= BLOCK:
                    yield packed(key)
            while len(held) > 256:  # rows of a target lie together, so older targets are done
                yield packed(next(iter(held)))
        for key in list(held):
            yield packed(key)

    kinds = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys]
    return rows.select(*keys, "y", "x").mapInArrow(run, ", ".join([*kinds, "size int, z binary, y binary"]))


def _batches(batches: Iterator[pa.RecordBatch], width: int):
    """(key, standardised predictors, standardised labels) of each block."""
    for batch in batches:
        names = [batch.column(k).to_pylist() for k in range(width)]
        size, z, y = (batch.column(width + k) for k in range(3))
        for row in range(batch.num_rows):
            n = size[row].as_py()
            yield (
                tuple(name[row] for name in names),
                np.frombuffer(z[row].as_buffer(), float).reshape(n, -1),
                np.frombuffer(y[row].as_buffer(), float),
            )


def _step(rows, keys, state, squared: bool, cost: float) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """Of each target, for each share: the errors' sum, and the weighted sums of (1, z, y) there."""
    width, kinds = len(keys), [rows.schema[k].dataType.simpleString() for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        types = None

        def typed(stream):
            nonlocal types
            for batch in stream:
                types = [batch.schema.field(k).type for k in range(width)]
                yield batch

        for key, z, y in _batches(typed(batches), width):
            here, there, epsilon = state[key]
            one = np.column_stack([np.ones(len(y)), z])
            full = np.column_stack([one, y])
            lost, sums = [], []
            for share in SHARES:
                left = y - one @ (here + share * (there - here))
                over = np.abs(left) - epsilon
                out = np.maximum(over, 0.0)
                weight = np.where(over > 0, cost if squared else cost / np.maximum(over, LEAST), 0.0)
                # the tube's edge, not its middle, is what a row outside is drawn to
                edge = y - np.sign(left) * epsilon
                full[:, -1] = edge
                lost.append(0.5 * (out**2).sum() if squared else out.sum())
                sums.append((full * weight[:, None]).T @ full)
            if key in held:
                held[key][0] += np.array(lost)
                held[key][1] += np.stack(sums)
            else:
                held[key] = [np.array(lost), np.stack(sums)]
        if held:
            arrays = [pa.array([k[c] for k in held], types[c]) for c in range(width)]
            arrays.append(pa.array([v[0].tolist() for v in held.values()], pa.list_(pa.float64())))
            arrays.append(pa.array([v[1].ravel().tolist() for v in held.values()], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "lost", "sums"])

    schema = ", ".join([*(f"{k} {t}" for k, t in zip(keys, kinds)), "lost array<double>", "sums array<double>"])
    parts = rows.mapInArrow(run, schema)

    def total(pdf: pd.DataFrame) -> list[tuple]:
        return [(np.sum(np.stack([np.concatenate(p) for p in zip(pdf["lost"], pdf["sums"])]), axis=0).tolist(),)]

    each = gram.grouped(parts, keys, "v array<double>", total)
    out = {}
    for r in each.collect():
        v = np.array(r["v"])
        size = round(((len(v) - len(SHARES)) / len(SHARES)) ** 0.5)
        out[tuple(r[k] for k in keys)] = (v[: len(SHARES)], v[len(SHARES) :].reshape(len(SHARES), size, size))
    return out


def _tubes(rows, keys, models, nu: float) -> dict[tuple, float]:
    """The quantile of each target's absolute residuals that leaves a fraction ``nu`` beyond it."""
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def typed(stream):
            for batch in stream:
                kinds[:] = [batch.schema.field(k).type for k in range(width)]
                yield batch

        kinds: list = []
        for key, z, y in _batches(typed(batches), width):
            size = np.abs(y - models[key][0] - z @ models[key][1:])
            arrays = [pa.array([key[c]], kinds[c]) for c in range(width)]
            sizes = pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), pa.array(size))
            yield pa.RecordBatch.from_arrays([*arrays, sizes], names=[*keys, "sizes"])

    schema = ", ".join([*(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys), "sizes array<double>"])
    sizes = rows.mapInArrow(run, schema).select(*keys, F.explode("sizes").alias("size"))
    found = sizes.groupBy(*keys).agg(F.percentile_approx("size", 1 - nu, 10_000).alias("tube")).collect()
    return {tuple(r[k] for k in keys): r["tube"] for r in found}


def fit(
    rows: DataFrame,
    keys: Sequence[str],
    cost: float = 1.0,
    epsilon: float = 0.1,
    nu: float | None = None,
    squared: bool = False,
    steps: int = 25,
    tol: float = 1e-4,
) -> DataFrame:
    """(keys, n, epsilon, loss, steps, intercept, coefficients, fill) of each target of ``rows(keys, y, x)``.

    ``epsilon`` and ``loss``, the objective, are in standard units; with ``nu`` the tube is fitted and the
    objective has ``cost * nu * n * epsilon`` more. Missing predictors take their means; constant ones have
    coefficient 0. Stops when no target's objective falls by ``tol`` of itself. Models, not rows, pass
    through the driver: a few numbers for each target.
    """
    keys = list(keys)
    spark = rows.sparkSession
    rows = rows.where("y is not null").select(*keys, F.col("y").cast("double").alias("y"), "x").withColumn("of", F.xxhash64("y", "x"))
    # a target's rows lie together, but for large ones, which are split: a step then has few partial sums
    rows = cut(ranking.split_hot(rows, keys, ["of"], PART).repartition(*keys, "salt").drop("of", "salt"), "svr-rows")
    scales = _scales(rows, keys)
    if sum(8 * 4 * len(s.mean) for s in scales.values()) > MOST_MODELS:
        raise ValueError(f"{len(scales)} targets are too many at once; run them in parts")
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    # steps read blocks of standardised rows: keys, missing values and units are settled once
    rows = cut(_blocks(rows, keys, scales), "svr-blocks")
    here = {key: np.zeros(len(s.mean)) for key, s in scales.items()}
    there = {key: b.copy() for key, b in here.items()}
    tubes = {key: epsilon for key in scales}
    least = {key: np.inf for key in scales}
    best, step = dict(here), 0
    for step in range(1, steps + 1) if scales else ():
        if nu is not None:
            tubes = _tubes(rows, keys, here, nu)
        found = _step(rows, keys, {k: (here[k], there[k], tubes[k]) for k in scales}, squared, cost)
        moved = False
        for key, (lost, sums) in found.items():
            ways = [here[key] + share * (there[key] - here[key]) for share in SHARES]
            fixed = cost * nu * scales[key].n * tubes[key] if nu is not None else 0.0
            goals = [0.5 * w[1:] @ w[1:] + cost * v + fixed for w, v in zip(ways, lost)]
            at = int(np.argmin(goals))
            here[key] = ways[at]
            if goals[at] < least[key]:
                moved = moved or goals[at] < least[key] - tol * abs(least[key]) or not np.isfinite(least[key])
                least[key], best[key] = goals[at], ways[at]
            g = sums[at]
            # a little of the identity keeps rows inside the tube from leaving the intercept free
            left = g[:-1, :-1] + np.diag([1e-9, *np.ones(len(g) - 2)])
            there[key] = np.linalg.solve(left, g[:-1, -1] + np.array([1e-9 * here[key][0], *np.zeros(len(g) - 2)]))
        if not moved and step > 3:
            break
    out = []
    for key, s in scales.items():
        own = s.deviation[:-1]
        slopes = np.divide(best[key][1:] * s.deviation[-1], own, out=np.zeros(len(own)), where=own > 0)
        intercept = s.mean[-1] + best[key][0] * s.deviation[-1] - slopes @ s.mean[:-1]
        out.append((*key, float(s.n), float(tubes[key]), float(least[key]), step, float(intercept), slopes.tolist(), s.fill.tolist()))
    return spark.createDataFrame(
        out, f"{kinds}, n double, epsilon double, loss double, steps int, intercept double, coefficients array<double>, fill array<double>"
    )
