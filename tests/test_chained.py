"""Chained imputation against a plain loop over a dense matrix."""

import numpy as np
import pytest

from panelweave.operators import chained
from panelweave.plans import iterative


def dense(n=60, m=6, seed=4):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 2)) @ rnd.normal(size=(2, m)) + 0.3 * rnd.normal(size=(n, m)) + 5
    x[rnd.random((n, m)) < np.linspace(0.05, 0.4, m)] = np.nan
    return x


@pytest.fixture(scope="module")
def panel(spark):
    x = dense()
    rows = [(r // 4, 2000 + r % 4, f"i{c}", float(x[r, c])) for r in range(len(x)) for c in range(x.shape[1]) if not np.isnan(x[r, c])]
    rows += [(0, 2000, "never", None), (99, 2000, "i0", None)]
    return spark.createDataFrame(rows, "entity int, period int, indicator string, value double")


def naive(x, k, rounds, alpha=0.001, waves=1):
    """(filled matrix, changes), column after column or all from the round before."""
    gone, m = np.isnan(x), x.shape[1]
    now = np.where(gone, np.nanmean(x, axis=0), x)
    corr = np.abs(np.corrcoef(now.T))
    near = [sorted((j for j in range(m) if j != c), key=lambda j: (-round(corr[c, j], 9), j))[:k] for c in range(m)]
    order = sorted(range(m), key=lambda c: (gone[:, c].sum(), c))
    changes = []
    for _ in range(rounds):
        start = now.copy()
        for wave in np.array_split(np.array(order), waves):
            base = now.copy()
            for c in wave.tolist():
                at = ~gone[:, c]
                a, y = base[at][:, near[c]], x[at, c]
                z, t = (a - a.mean(0)) / a.std(0), (y - y.mean()) / y.std()
                beta = np.linalg.solve(z.T @ z / len(y) + alpha * np.eye(k), z.T @ t / len(y)) * y.std() / a.std(0)
                now[gone[:, c], c] = y.mean() + (base[gone[:, c]][:, near[c]] - a.mean(0)) @ beta
        changes.append(np.abs(now - start).max())
    return now, changes


def filled(run):
    x = dense()
    out = np.full(x.shape, np.nan)
    for r in chained.cells(run).collect():
        at = r["entity"] * 4 + r["period"] - 2000, int(r["indicator"][1:])
        assert r["is_imputed"] == bool(np.isnan(x[at]))
        out[at] = r["value"]
    return out


@pytest.mark.parametrize("k, rounds, waves", [(3, 3, 1), (2, 2, 6)])
def test_equals_plain_loop(panel, k, rounds, waves):
    run = chained.impute(panel, k=k, rounds=rounds, tol=0.0, waves=waves)
    want, changes = naive(dense(), k, rounds, waves=waves)
    assert np.allclose(filled(run), want, rtol=1e-9)
    assert run.rounds == rounds and "never" not in run.names
    if waves == 1:
        assert np.allclose(run.changes, changes, rtol=1e-9)


def test_round_zero_is_the_mean(panel):
    x = dense()
    assert np.allclose(filled(chained.impute(panel, rounds=0)), np.where(np.isnan(x), np.nanmean(x, axis=0), x))


def test_stops_when_nothing_moves_and_reruns_agree(panel):
    run = chained.impute(panel, k=3, rounds=20, tol=0.02)
    assert run.rounds < 20 and run.changes[-1] < 0.02 * np.nanmax(np.abs(dense())) <= run.changes[0]
    again = chained.impute(panel, k=3, rounds=20, tol=0.02)
    assert again.rounds == run.rounds and np.allclose(filled(run), filled(again), rtol=1e-12)


def test_report_and_importances(panel):
    run = chained.impute(panel, k=2, rounds=2, tol=0.0)
    before, _ = naive(dense(), 2, 1)
    x, m = dense(), 6
    gone = np.isnan(x)
    corr = np.abs(np.corrcoef(np.where(gone, np.nanmean(x, axis=0), x).T))
    fold = np.repeat([0, 1, 2], 20)
    got = {r["indicator"]: r for r in iterative.report(run).collect()}
    for c in range(m):
        near = sorted((j for j in range(m) if j != c), key=lambda j: (-round(corr[c, j], 9), j))[:2]
        left = np.full(len(x), np.nan)
        for f in range(3):
            at = ~gone[:, c] & (fold != f)
            a, y = before[at][:, near], x[at, c]
            z = (a - a.mean(0)) / a.std(0)
            beta = np.linalg.solve(z.T @ z / len(y) + 0.001 * np.eye(2), z.T @ (y - y.mean()) / len(y)) / a.std(0)
            out = ~gone[:, c] & (fold == f)
            left[out] = x[out, c] - y.mean() - (before[out][:, near] - a.mean(0)) @ beta
        left, y = left[~gone[:, c]], x[~gone[:, c], c]
        r = got[f"i{c}"]
        assert r["n"] == len(y) and r["rmse"] == pytest.approx(np.sqrt((left**2).mean()), rel=1e-8)
        assert r["r2"] == pytest.approx(1 - (left**2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-8)
        assert [r["low"], r["high"]] == pytest.approx(np.quantile(left, [0.05, 0.95]).tolist(), rel=1e-8)
    assert {(r["target"], r["predictor"]) for r in chained.importances(run).collect() if r["target"] == "i5"} == {
        ("i5", f"i{j}") for j in sorted((j for j in range(5)), key=lambda j: (-round(corr[5, j], 9), j))[:2]
    }


def test_empty_and_full_panels(spark, panel):
    none = chained.impute(panel.where("value is null"))
    assert none.names == [] and none.rounds == 0
    whole = panel.where("indicator = 'i0' and value is not null")
    assert {(r["value"], r["is_imputed"]) for r in chained.cells(chained.impute(whole)).collect()} == {
        (r["value"], False) for r in whole.collect()
    }
