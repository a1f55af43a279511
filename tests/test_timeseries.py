"""The time-series run against plain matrices."""

import numpy as np
import pytest

from panelweave.plans import timeseries

FIRST, LAST, LAG, WINDOW = 1, 14, 2, 6


@pytest.fixture(scope="module")
def run(spark):
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(20, 15, 2)).cumsum(axis=1)
    mix = rnd.normal(size=(2, 4))
    values = base @ mix + rnd.normal(size=(20, 15, 4)) * 0.1 + 10
    gone = rnd.random((20, 15, 4)) < 0.3
    gone[:, 0] = True
    gone[3] = True
    rows = [(e, t, f"i{c}", float(values[e, t, c])) for e in range(20) for t in range(15) for c in range(4) if not gone[e, t, c]]
    rows += [(100 + e, t, "i0", 1e6) for e in range(3) for t in range(1, 15)]
    panel = spark.createDataFrame(rows, "entity int, period int, indicator string, value double")
    focus = spark.createDataFrame([(e,) for e in range(20)], "entity int")
    targets = spark.createDataFrame([(t, c) for t in (12, 14) for c in ("i0", "i2")], "period int, indicator string")
    valid = spark.createDataFrame([(12, "i1"), (12, "i2"), (12, "i3"), (14, "i1")], "period int, indicator string")
    found = timeseries.time_series(panel, focus, targets, FIRST, LAST, valid=valid, k=3, lag=LAG, window=WINDOW, penalties=[(0.0, 0.01)])
    return found, np.where(gone, np.nan, values)


def features(values, predictor, window):
    """Interpolated values of an indicator in the periods before a window, nearest first."""
    out = np.full((20, LAG), np.nan)
    for e in range(20):
        t = np.arange(1, 15)
        known = ~np.isnan(values[e, 1:, predictor])
        if known.any():
            filled = np.interp(t, t[known], values[e, 1:, predictor][known])
            out[e] = [filled[window - step - 1] for step in range(1, LAG + 1)]
    return out


def naive(values, period, target, predictors, drop=None):
    """(intercept, slopes, fill) by weighted ridge over all windows; ``drop`` leaves out entities of one of three folds."""
    x, y, w, e = [], [], [], []
    for window in range(max(FIRST, period - WINDOW) + LAG, period + 1):
        x.append(np.hstack([features(values, p, window) for p in predictors]))
        y.append(values[:, window, target])
        w.append(np.full(20, 1 / (1 + period - window)))
        e.append(np.arange(20))
    x, y, w, e = np.vstack(x), np.concatenate(y), np.concatenate(w), np.concatenate(e)
    has = ~np.isnan(y)
    x, y, w, e = x[has], y[has], w[has], e[has]
    fill = np.nanmean(x, axis=0)
    x = np.where(np.isnan(x), fill, x)
    if drop is not None:
        keep = np.array([part for part, g in enumerate(np.array_split(np.arange(20), 3)) for _ in g])[e] != drop
        x, y, w = x[keep], y[keep], w[keep]
    w = w / w.sum()
    mx, my = w @ x, w @ y
    sx, sy = np.sqrt(w @ (x - mx) ** 2), np.sqrt(w @ (y - my) ** 2)
    z = (x - mx) / sx
    beta = np.linalg.solve(z.T @ (z * w[:, None]) + 0.01 * np.eye(x.shape[1]), z.T @ (w * (y - my) / sy)) * sy / sx
    return my - beta @ mx, beta, fill


def test_models_equal_weighted_ridges(run):
    found, values = run
    ranked = {(r["target"], r["rank"]): int(r["predictor"][1:]) for r in found.chosen.collect()}
    models = found.model.collect()
    assert {(m["period"], m["target"]) for m in models} == {(12, "i0"), (12, "i2"), (14, "i0"), (14, "i2")}
    for m in models:
        usable = {12: {1, 2, 3}, 14: {1}}[m["period"]]
        places = [r for r in (1, 2, 3) if ranked[m["target"], r] in usable]
        intercept, slopes, _ = naive(values, m["period"], int(m["target"][1:]), [ranked[m["target"], r] for r in places])
        at = [(r - 1) * LAG + step for r in places for step in range(LAG)]
        got = np.array(m["coefficients"])
        assert np.allclose(got[at], slopes, rtol=1e-6) and m["intercept"] == pytest.approx(intercept, rel=1e-6)
        assert not np.delete(got, at).any()


def test_residuals_leave_their_entities_out(run):
    found, values = run
    ranked = {(r["target"], r["rank"]): int(r["predictor"][1:]) for r in found.chosen.collect()}
    fold = np.repeat([0, 1, 2], [7, 7, 6])
    rows = [r for r in found.residuals.collect() if r["period"] == 12 and r["target"] == "i0"]
    assert len(rows) == sum((~np.isnan(values[:, w, 0])).sum() for w in range(8, 13))
    predictors = [ranked["i0", r] for r in (1, 2, 3)]
    models = [naive(values, 12, 0, predictors, drop=f)[:2] for f in range(3)]
    fill = naive(values, 12, 0, predictors)[2]
    for r in rows:
        intercept, slopes = models[fold[r["entity"]]]
        x = np.hstack([features(values, p, r["window"])[r["entity"]] for p in predictors])
        assert r["prediction"] == pytest.approx(intercept + slopes @ np.where(np.isnan(x), fill, x), rel=1e-6)


def test_predictions_are_of_the_period_alone(run):
    found, values = run
    got = {(r["period"], r["target"], r["entity"]): r for r in found.predictions.collect()}
    want = {(t, f"i{c}", e) for t in (12, 14) for c in (0, 2) for e in range(20) if np.isnan(values[e, t, c])}
    assert set(got) == want and all(r["lower"] <= r["upper"] for r in got.values())


def test_importances_sum_over_lags(run):
    found, _ = run
    got = {(r["period"], r["target"], r["predictor"]): r["importance"] for r in timeseries.importances(found).collect()}
    ranked = {(r["target"], r["predictor"]): r["rank"] for r in found.chosen.collect()}
    for m in found.model.collect():
        for (period, target, predictor), value in got.items():
            if (period, target) == (m["period"], m["target"]):
                at = (ranked[target, predictor] - 1) * LAG
                assert value == pytest.approx(np.abs(m["scaled"][at : at + LAG]).sum())
    assert timeseries.performance(found).count() == 4
