"""Linear models from sums of products against plain solvers on the rows themselves."""

import numpy as np
import pytest

from panelweave.operators import gram

KEYS = ["task"]


def table(n=240, k=10, seed=5):
    """Rows of two tasks, with missing predictors, a constant one, folds and weights."""
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, 3))
    x = base @ rnd.normal(size=(3, k)) + rnd.normal(size=(n, k)) * 0.5 + 20
    x[:, 7] = 3.0
    y = x @ rnd.normal(size=k) + rnd.normal(size=n) * 2 + 100
    x[rnd.random((n, k)) < 0.15] = np.nan
    x[:, 7] = 3.0
    return x, y, np.arange(n) % 5, np.arange(n) % 2 == 0


@pytest.fixture(scope="module")
def rows(spark):
    out = []
    for task in ("a", "b"):
        x, y, fold, side = table(seed=5 if task == "a" else 9)
        for r in range(len(y)):
            values = [None if np.isnan(v) else float(v) for v in x[r]]
            out.append((task, r, int(fold[r]), bool(side[r]), float(y[r]), values))
        out.append((task, -1, 0, True, None, [1.0] * 10))
    return spark.createDataFrame(out, "task string, row int, fold int, side boolean, y double, x array<double>").repartition(7)


def dense(seed):
    x, y, fold, side = table(seed=seed)
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    weight = np.where(side, 1 / side.sum(), 1 / (~side).sum())
    return x, y, fold, weight


def loss(x, y, w, b, c, l1, alpha):
    """The objective in standard units, which every fit has to make least."""
    w = w / w.sum()
    mx, my = w @ x, w @ y
    sx, sy = np.sqrt(w @ (x - mx) ** 2), np.sqrt(w @ (y - my) ** 2)
    beta = c * sx / sy
    error = (y - b - x @ c) / sy
    return 0.5 * (w @ error**2) + alpha * (l1 * np.abs(beta).sum() + (1 - l1) / 2 * beta @ beta)


@pytest.fixture(scope="module")
def fitted(spark, rows):
    from pyspark.sql import functions as F

    sums = gram.products(rows, KEYS, ["fold", "side"])
    sums = sums.withColumn("weight", F.lit(1 / 120))
    return gram.fits(sums, KEYS).collect()


def test_every_fit_is_least(fitted):
    rnd = np.random.default_rng(1)
    assert len(fitted) == 2 * 6 * len(gram.PENALTIES)
    for f in fitted:
        x, y, fold, w = dense(5 if f["task"] == "a" else 9)
        inside = fold != f["fold"] if f["split"] == "fold" else np.ones(len(y), bool)
        assert f["n"] == inside.sum() and f["n_out"] == (~inside).sum()
        c, b = np.array(f["coefficients"]), f["intercept"]
        assert c[7] == 0
        at = loss(x[inside], y[inside], w[inside], b, c, f["l1"], f["alpha"])
        for step in (1e-3, 1e-5):
            for _ in range(20):
                other = loss(x[inside], y[inside], w[inside], b + step * rnd.normal(), c + step * rnd.normal(size=10), f["l1"], f["alpha"])
                assert at <= other + 1e-12
        if f["split"] == "fold":
            assert f["sse"] == pytest.approx(((y - b - x @ c)[~inside] ** 2).sum(), rel=1e-7)


def test_without_penalty_it_is_least_squares(rows):
    for f in gram.fits(gram.products(rows, KEYS, ["fold"]), KEYS, ["fold"], [(0.0, 0.0)]).where("split = 'all'").collect():
        x, y, _, _ = dense(5 if f["task"] == "a" else 9)
        keep = [j for j in range(10) if j != 7]
        want, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x[:, keep]]), y, rcond=None)
        assert np.allclose(np.array(f["coefficients"])[keep], want[1:], rtol=1e-6)
        assert f["intercept"] == pytest.approx(want[0], rel=1e-6)


def test_search_takes_the_least_mean_error(spark, fitted):
    frame = spark.createDataFrame(fitted, gram.FITS and "task string, " + gram.FITS)
    chosen = {r["task"]: (r["l1"], r["alpha"]) for r in gram.best(gram.grid(frame, KEYS), KEYS).collect()}
    for task in ("a", "b"):
        errors = {}
        for f in fitted:
            if f["task"] == task and f["split"] == "fold":
                errors.setdefault((f["l1"], f["alpha"]), []).append(f["sse"] / f["n_out"])
        assert chosen[task] == min(errors, key=lambda p: (round(np.sqrt(np.mean(errors[p])), 6), p))


def test_predictions_fill_missing_values(rows):
    models = gram.fits(gram.products(rows, KEYS, []), KEYS, [], [(0.0, 0.1)])
    got = gram.predicted(rows, models, KEYS, ["task", "row"]).where("row >= 0").collect()
    model = {m["task"]: m for m in models.collect()}
    for r in got:
        x, *_ = dense(5 if r["task"] == "a" else 9)
        m = model[r["task"]]
        assert r["prediction"] == pytest.approx(m["intercept"] + x[r["row"]] @ np.array(m["coefficients"]), rel=1e-9)


def test_small_and_empty_tasks(spark):
    rows = spark.createDataFrame(
        [("one", 0, 5.0, [1.0, None]), ("two", 0, 1.0, [None, None]), ("two", 1, 3.0, [None, None])],
        "task string, fold int, y double, x array<double>",
    )
    got = {(r["task"], r["split"], r["fold"]): r for r in gram.fits(gram.products(rows, KEYS, ["fold"]), KEYS, ["fold"], [(0.0, 0.1)]).collect()}
    assert set(got) == {("one", "all", None), ("two", "all", None), ("two", "fold", 0), ("two", "fold", 1)}
    assert got["one", "all", None]["intercept"] == 5.0 and got["two", "all", None]["coefficients"] == [0.0, 0.0]
    assert got["two", "fold", 0]["sse"] == 4.0
    assert gram.fits(gram.products(rows.limit(0), KEYS, ["fold"]), KEYS).collect() == []


def test_elimination_drops_planted_noise(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(300, 8))
    y = 3 * x[:, 1] - 2 * x[:, 4] + x[:, 6] + rnd.normal(size=300) * 0.1
    rows = spark.createDataFrame([("t", float(b), a.tolist()) for a, b in zip(x, y)], "task string, y double, x array<double>")
    sums = gram.products(rows, KEYS, [])
    for step in (1, 2, 5):
        got = gram.eliminated(sums, KEYS, 3, step).orderBy("rank").collect()
        assert [r["position"] for r in got] == [1, 4, 6]
    left, z = list(range(8)), (x - x.mean(0)) / x.std(0)
    while len(left) > 5:
        c = z[:, left].T @ z[:, left] / 300
        beta = np.linalg.solve(c + 0.001 * np.eye(len(left)), z[:, left].T @ ((y - y.mean()) / y.std()) / 300)
        left.pop(int(np.argmin(np.abs(beta))))
    assert {r["position"] for r in gram.eliminated(sums, KEYS, 5, 1).collect()} == set(left)


@pytest.mark.parametrize("scale", [False, True])
def test_loadings_are_eigenvectors(rows, scale):
    sums = gram.products(rows, KEYS, [])
    found = gram.loadings(sums, KEYS, 4, scale).collect()
    for task in ("a", "b"):
        x, *_ = dense(5 if task == "a" else 9)
        cov = np.cov(x.T, bias=True)
        if scale:
            own = np.sqrt(np.diag(cov))
            cov = np.divide(cov, np.outer(own, own), out=np.zeros_like(cov), where=np.outer(own, own) > 0)
        for c in range(1, 5):
            mine = sorted((r for r in found if r["task"] == task and r["component"] == c), key=lambda r: r["position"])
            v, e = np.array([r["loading"] for r in mine]), mine[0]["eigenvalue"]
            assert np.abs(cov @ v - e * v).max() < 1e-6 * max(1.0, e)
            assert np.linalg.norm(v) == pytest.approx(1) and v[np.argmax(np.abs(v))] > 0
        first = np.ones(10)
        for _ in range(2_000):
            first = cov @ first / np.linalg.norm(cov @ first)
        mine = [r["loading"] for r in sorted((r for r in found if r["task"] == task and r["component"] == 1), key=lambda r: r["position"])]
        assert abs(first @ np.array(mine)) == pytest.approx(1, abs=1e-6)


def test_strongest_loadings(spark):
    rows = [("t", c, 1.0, p, v) for c, vs in enumerate([[0.9, 0.1, 0.4, 0.0], [0.8, 0.2, -0.5, 0.1], [0.0, 0.3, 0.1, 0.2]], 1) for p, v in enumerate(vs)]
    frame = spark.createDataFrame(rows, "task string, component int, eigenvalue double, position int, loading double")
    got = gram.strongest_loadings(frame, KEYS, 3).orderBy("rank").collect()
    assert [(r["position"], r["score"]) for r in got] == [(0, 0.9), (1, 0.3), (2, 0.5)]
