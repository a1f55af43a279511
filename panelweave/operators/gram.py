"""Penalised linear models with several predictors, for all targets at once, from sums of products.

A row holds a label ``y`` and an array ``x`` of predictors, all of one size, null
where missing. Tasks add up the products of a row's values per group, so rows are
read once whatever the number of folds and penalties, and only sums are shuffled.
Missing values cost no second reading: next to each predictor stands a 0/1 flag
that it is missing, so the sums after filling it with a constant follow from the
sums before. Sums of a fold's complement are the whole less the fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (share of the absolute penalty, strength): ridge, lasso and their mixture.
PENALTIES = tuple((share, alpha) for share in (0.0, 0.15, 1.0) for alpha in (0.0001, 0.001, 0.01, 0.1))
FITS = (
    "split string, fold int, l1 double, alpha double, n double, intercept double, coefficients array<double>, "
    "fill array<double>, scaled array<double>, n_out double, sse double"
)


def products(rows: DataFrame, keys: Sequence[str], parts: Sequence[str], most: int = 64 << 20) -> DataFrame:
    """(keys, parts, n, width, sums): sums of products of (1, x, missing flags, y) over the labelled rows of each group.

    ``sums`` is the upper triangle. A task keeps at most ``most`` bytes of sums and hands on
    what it has beyond that, so a group has a row for each task that holds some of it, or a few.
    """
    by = [*keys, *parts]
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    frame = rows.where("y is not null").select(*by, F.col("y").cast("double").alias("y"), "x")
    names = [*by, "n", "width", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size, kinds = 0, None

        def packed() -> pa.RecordBatch:
            columns = [[key[k] for key in held] for k in range(len(by))]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            arrays += [
                pa.array([float(n) for n, _ in held.values()], pa.float64()),
                pa.array([len(s) for _, s in held.values()], pa.int32()),
                pa.array([s[np.triu_indices(len(s))] for _, s in held.values()], pa.list_(pa.float64())),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(k).type for k in range(len(by))]
            flat = batch.column(len(by) + 1).flatten().to_numpy(zero_copy_only=False).astype(float)
            x = flat.reshape(batch.num_rows, -1)
            gone = np.isnan(x)
            y = batch.column(len(by)).to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(y)), np.where(gone, 0.0, x), gone, y])
            labels = pd.DataFrame({k: batch.column(k).to_pandas() for k in range(len(by))}).groupby(
                list(range(len(by))), sort=False, dropna=False
            )
            for at in labels.indices.values():
                key = tuple(batch.column(k)[int(at[0])].as_py() for k in range(len(by)))
                part = z[at]
                sums = part.T @ part
                if key in held:
                    held[key][0] += len(at)
                    held[key][1] += sums
                else:
                    held[key] = [len(at), sums]
                    size += sums.nbytes
            if size > most:
                yield packed()
                held, size = {}, 0
        if held:
            yield packed()

    schema = ", ".join([*(f"{c} {types[c]}" for c in by), "n double, width int, sums array<double>"])
    return frame.mapInArrow(run, schema)


def unpacked(sums: Sequence, width: int) -> np.ndarray:
    """Square matrices of upper triangles."""
    out = np.zeros((len(sums), width, width))
    i, j = np.triu_indices(width)
    out[:, i, j] = np.stack([np.asarray(s, float) for s in sums])
    out[:, j, i] = out[:, i, j]
    return out


def filled(plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fill, matrices of (1, x, y)): missing values take the mean of the labelled rows that have one, 0 where none has."""
    k = (plain.shape[1] - 2) // 2
    whole = plain.sum(axis=0)
    seen = whole[0, 0] - whole[0, k + 1 : 2 * k + 1]
    fill = np.divide(whole[0, 1 : k + 1], seen, out=np.zeros(k), where=seen > 0)
    turn = np.zeros((k + 2, plain.shape[1]))
    turn[0, 0] = turn[k + 1, -1] = 1.0
    turn[np.arange(1, k + 1), np.arange(1, k + 1)] = 1.0
    turn[np.arange(1, k + 1), np.arange(k + 1, 2 * k + 1)] = fill
    return fill, turn @ plain @ turn.T


def standardised(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, deviations, correlations) of the columns after the first; a constant one has deviation 0."""
    weight = sums[:, :1, 0]
    mean = sums[:, 0, 1:] / weight
    square = np.einsum("bii->bi", sums[:, 1:, 1:]) / weight
    cov = sums[:, 1:, 1:] / weight[:, :, None] - mean[:, :, None] * mean[:, None, :]
    variance = np.einsum("bii->bi", cov)
    deviation = np.sqrt(np.where(variance > 1e-12 * square, variance, 0.0))
    over = deviation[:, :, None] * deviation[:, None, :]
    return mean, deviation, np.divide(cov, over, out=np.zeros_like(cov), where=over > 0)


def descend(c: np.ndarray, r: np.ndarray, l1: float, alpha: float, rounds: int = 2_000, tol: float = 1e-11) -> np.ndarray:
    """Coordinate descent with soft thresholds, of all problems side by side."""
    beta, shrink = np.zeros_like(r), 1 + alpha * (1 - l1)
    for _ in range(rounds):
        before = beta.copy()
        for j in range(r.shape[1]):
            rest = r[:, j] - np.einsum("bk,bk->b", c[:, j], beta) + beta[:, j]
            beta[:, j] = np.sign(rest) * np.maximum(np.abs(rest) - alpha * l1, 0.0) / shrink
        if np.abs(beta - before).max(initial=0.0) < tol:
            break
    return beta


def fit(sums: np.ndarray, l1: float, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(intercept, coefficients, scaled coefficients) of each matrix of (1, x, y).

    Predictors and label are standardised within; the penalty is ``alpha`` times the mixture of
    the absolute (share ``l1``) and half the square of the scaled coefficients, the loss half the
    mean square. Constant predictors, and all where the label is constant, have coefficient 0.
    """
    mean, deviation, corr = standardised(sums)
    k = corr.shape[1] - 1
    c, r = corr[:, :k, :k].copy(), corr[:, :k, k]
    c[:, np.arange(k), np.arange(k)] = 1.0
    if not k:
        beta = r
    elif l1:
        beta = descend(c, r, l1, alpha)
    elif alpha:
        beta = np.linalg.solve(c + alpha * np.eye(k), r[:, :, None])[:, :, 0]
    else:
        beta = (np.linalg.pinv(c, rcond=1e-10, hermitian=True) @ r[:, :, None])[:, :, 0]
    own = deviation[:, :k]
    beta = np.where(own > 0, beta, 0.0)
    slopes = np.divide(beta * deviation[:, k:], own, out=np.zeros_like(beta), where=own > 0)
    return mean[:, k] - np.einsum("bk,bk->b", slopes, mean[:, :k]), slopes, beta


def grouped(sums: DataFrame, keys: Sequence[str], columns: str, solve) -> DataFrame:
    """``solve(frame) -> list of rows`` for each key, with the key's columns in front."""
    keys = list(keys)
    types = {f.name: f.dataType.simpleString() for f in sums.schema.fields}
    names = [part.split()[0] for part in columns.split(", ")]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(solve(pdf), columns=names)
        for position, name in enumerate(keys):
            out.insert(position, name, key[position])
        return out

    return sums.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {types[k]}" for k in keys), columns]))


def fit_rows(
    raw: np.ndarray, weight: np.ndarray, folds: dict[str, np.ndarray], penalties: Sequence[tuple[float, float]],
    allowed: Sequence[int] | None = None,
) -> list[tuple]:
    """Rows of ``FITS`` from the sums of a task's parts; only ``allowed`` predictors have a coefficient, if given."""
    fill, plain = filled(raw)
    k = len(fill)
    use = list(range(k)) if allowed is None else sorted(allowed)
    at = [0, *(j + 1 for j in use), k + 1]
    plain = plain[:, at][:, :, at]
    weighted = plain * weight[:, None, None]
    inside, outside, names, rest = [weighted.sum(axis=0)], [np.zeros_like(plain[0])], [("all", None)], [plain.sum(axis=0)]
    for split, label in folds.items():
        for fold in np.unique(label).tolist():
            away = label == fold
            if not away.all():
                inside.append(weighted[~away].sum(axis=0))
                outside.append(plain[away].sum(axis=0))
                rest.append(plain[~away].sum(axis=0))
                names.append((split, int(fold)))
    grams, left, out = np.stack(inside), np.stack(outside), []
    for l1, alpha in penalties:
        intercept, slopes, scaled = fit(grams, l1, alpha)
        v = np.column_stack([intercept, slopes, -np.ones(len(slopes))])
        sse = np.maximum(np.einsum("bi,bij,bj->b", v, left, v), 0.0)
        wide, standard = np.zeros((len(names), k)), np.zeros((len(names), k))
        wide[:, use], standard[:, use] = slopes, scaled
        for b, (split, fold) in enumerate(names):
            n_out = left[b, 0, 0]
            out.append((split, fold, l1, alpha, rest[b][0, 0], intercept[b], wide[b].tolist(), fill.tolist(),
                        standard[b].tolist(), n_out, sse[b] if n_out else None))
    return out


def fits(
    sums: DataFrame, keys: Sequence[str], splits: Sequence[str] = ("fold",), penalties: Sequence[tuple[float, float]] = PENALTIES
) -> DataFrame:
    """Every fit of every key: (keys, split, fold, l1, alpha, n, intercept, coefficients, fill, scaled, n_out, sse).

    ``sums`` are ``products``, perhaps with a column ``weight`` that their rows' rows have in
    common; fits are weighted, errors are not. ``splits`` names the columns with folds; a fit with
    ``split`` "all" has all rows, others leave a fold out and have its squared errors ``sse``. A fold
    without any row beside it has no fit.
    """

    def solve(pdf: pd.DataFrame) -> list[tuple]:
        weight = pdf["weight"].to_numpy(float) if "weight" in pdf else np.ones(len(pdf))
        raw = unpacked(pdf["sums"].tolist(), int(pdf["width"].iloc[0]))
        return fit_rows(raw, weight, {split: pdf[split].to_numpy() for split in splits}, penalties)

    return grouped(sums, keys, FITS, solve)


def grid(fitted: DataFrame, keys: Sequence[str], split: str = "fold") -> DataFrame:
    """(keys, l1, alpha, rmse): the root of the mean over folds of each left-out fold's mean squared error."""
    return (
        fitted.where(F.col("split") == split)
        .groupBy(*keys, "l1", "alpha")
        .agg(F.sqrt(F.avg(F.col("sse") / F.col("n_out"))).alias("rmse"))
    )


def best(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The penalty of least ``rmse`` for each key; of equals that with the smaller share and strength."""
    order = F.struct(F.round("rmse", 6).alias("r"), "l1", "alpha")
    return scores.groupBy(*keys).agg(F.min(order).alias("b")).select(*keys, "b.l1", "b.alpha")


def dot(coefficients: Column, x: Column, fill: Column) -> Column:
    """Sum of coefficients times values, missing ones filled."""
    whole = F.zip_with(x, fill, lambda a, b: F.coalesce(a, b))
    return F.aggregate(F.zip_with(coefficients, whole, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def predicted(rows: DataFrame, models: DataFrame, on: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of the rows with their ``prediction`` by the model of the same ``on`` columns."""
    of = models.select(*on, "intercept", "coefficients", "fill")
    return rows.join(of, list(on)).select(
        *keep, (F.col("intercept") + dot(F.col("coefficients"), F.col("x"), F.col("fill"))).alias("prediction")
    )


SELECTED = "position int, rank int, score double"


def eliminated(sums: DataFrame, keys: Sequence[str], keep: int, step: int, alpha: float = 0.001) -> DataFrame:
    """(keys, position, rank, score): the predictors left by recursive elimination, best first.

    Each round fits a ridge to those left and drops the ``step`` with the smallest absolute
    scaled coefficient (at most as many as leave ``keep``), of equals the later one. Nested sets
    are parts of one matrix, so rows are not read again. ``position`` counts from 0 in ``x``.
    """

    def solve(pdf: pd.DataFrame) -> list[tuple]:
        _, plain = filled(unpacked(pdf["sums"].tolist(), int(pdf["width"].iloc[0])))
        whole = plain.sum(axis=0)
        left = list(range(whole.shape[0] - 2))
        while True:
            at = [0, *(j + 1 for j in left), whole.shape[0] - 1]
            _, _, scaled = fit(whole[np.ix_(at, at)][None], 0.0, alpha)
            score = np.round(np.abs(scaled[0]), 9)
            order = np.lexsort((left, -score))
            if len(left) <= keep:
                return [(left[p], r + 1, float(score[p])) for r, p in enumerate(order.tolist())]
            gone = set(order[len(left) - min(step, len(left) - keep) :].tolist())
            left = [j for p, j in enumerate(left) if p not in gone]

    return grouped(sums, keys, SELECTED, solve)


def loadings(sums: DataFrame, keys: Sequence[str], components: int, scale: bool = False) -> DataFrame:
    """(keys, component, eigenvalue, position, loading) of the leading principal components of the filled predictors.

    Of the labelled rows' covariances (correlations with ``scale``). The largest loading by size, the
    first of equals, is positive.
    """

    def solve(pdf: pd.DataFrame) -> list[tuple]:
        _, plain = filled(unpacked(pdf["sums"].tolist(), int(pdf["width"].iloc[0])))
        whole = plain.sum(axis=0)[None, :-1, :-1]
        _, deviation, corr = standardised(whole)
        cov = corr[0] if scale else corr[0] * deviation[0][:, None] * deviation[0][None, :]
        values, vectors = np.linalg.eigh(cov)
        out = []
        for c, e in enumerate(np.argsort(-values, kind="stable")[:components].tolist()):
            vector = vectors[:, e]
            top = int(np.argmax(np.round(np.abs(vector), 9)))
            vector = vector * (1.0 if vector[top] >= 0 else -1.0)
            out += [(c + 1, float(values[e]), p, float(v)) for p, v in enumerate(vector)]
        return out

    return grouped(sums, keys, "component int, eigenvalue double, position int, loading double", solve)


def strongest_loadings(loaded: DataFrame, keys: Sequence[str], keep: int) -> DataFrame:
    """(keys, position, rank, score): the predictor that leads each component, then those with the next largest loadings.

    A predictor that leads several components counts for the first; equal loadings go by position.
    """
    size = F.round(F.abs("loading"), 9)
    lead = Window.partitionBy(*keys, "component").orderBy(size.desc(), "position")
    ranked = loaded.withColumn("score", size).withColumn("lead", F.row_number().over(lead) == 1)
    first = F.min(F.when(F.col("lead"), F.col("component"))).alias("leads")
    per = ranked.groupBy(*keys, "position").agg(first, F.max("score").alias("score"))
    order = Window.partitionBy(*keys).orderBy(F.col("leads").asc_nulls_last(), F.col("score").desc(), "position")
    return per.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).drop("leads")
