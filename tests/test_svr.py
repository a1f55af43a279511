"""Support vector regression against long sub-gradient descents."""

import numpy as np
import pytest

from panelweave.operators import gram, svr


def data(seed, n=120, k=3):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, k)) * [1, 5, 0.2] + [3, -2, 100]
    y = x @ rnd.normal(size=k) * 4 + rnd.standard_t(3, size=n) * 3 + 50
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    out = [(s, float(b), a.tolist()) for s in (1, 2) for a, b in zip(*data(s))] + [(1, None, [0.0, 0.0, 0.0])]
    return spark.createDataFrame(out, "task int, y double, x array<double>").repartition(3)


def goal(z, t, w, cost, epsilon, squared):
    out = np.maximum(np.abs(t - w[0] - z @ w[1:]) - epsilon, 0)
    return 0.5 * w[1:] @ w[1:] + cost * (0.5 * (out**2).sum() if squared else out.sum())


def descended(z, t, cost, epsilon, squared, steps=40_000):
    """The least objective on a long way of shrinking sub-gradient steps."""
    w, least = np.zeros(z.shape[1] + 1), np.inf
    one = np.column_stack([np.ones(len(t)), z])
    for s in range(steps):
        r = t - one @ w
        out = np.maximum(np.abs(r) - epsilon, 0)
        slope = -one.T @ (np.sign(r) * (out if squared else out > 0)) * cost + np.r_[0, w[1:]]
        least = min(least, goal(z, t, w, cost, epsilon, squared))
        w = w - slope / len(t) * (0.5 if squared else 1 / np.sqrt(1 + s))
    return least


def standard(seed):
    x, y = data(seed)
    return (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()


@pytest.mark.parametrize("squared", [False, True])
def test_loss_is_near_the_optimum(rows, squared):
    for m in svr.fit(rows, ["task"], cost=1.0, epsilon=0.1, squared=squared).collect():
        z, t = standard(m["task"])
        x, y = data(m["task"])
        w = np.r_[(m["intercept"] + np.array(m["coefficients"]) @ x.mean(0) - y.mean()) / y.std(), np.array(m["coefficients"]) * x.std(0) / y.std()]
        assert m["loss"] == pytest.approx(goal(z, t, w, 1.0, 0.1, squared), rel=1e-6)
        assert m["loss"] <= 1.01 * descended(z, t, 1.0, 0.1, squared)


def test_nu_is_the_fraction_outside(rows):
    models = svr.fit(rows, ["task"], nu=0.3)
    for m in models.collect():
        z, t = standard(m["task"])
        x, y = data(m["task"])
        left = np.abs(y - m["intercept"] - x @ np.array(m["coefficients"])) / y.std()
        assert (left > m["epsilon"]).mean() == pytest.approx(0.3, abs=0.04)
        assert m["loss"] <= 1.02 * min(descended(z, t, 1.0, e, False, 8_000) + 0.3 * 120 * e for e in np.linspace(0.5, 1.5, 9) * m["epsilon"])
    assert gram.predicted(rows, models, ["task"], ["task"]).where("prediction is not null").count() == 241


def test_constant_and_empty(spark, rows):
    flat = spark.createDataFrame([(1, 2.0, [1.0, None])] * 5, "task int, y double, x array<double>")
    (m,) = svr.fit(flat, ["task"]).collect()
    assert m["intercept"] == pytest.approx(2.0, abs=0.2) and m["coefficients"] == [0.0, 0.0]
    assert svr.fit(rows.limit(0), ["task"]).collect() == []


def test_steps_read_blocks_not_rows(spark):
    keys = ["period", "target"]
    rows = spark.range(3000).selectExpr(
        "cast(if(id % 3 = 0, null, id % 2) as int) as period", "concat('t', id % 2) as target", "double(id % 11) as y",
        "array(double(id % 7), if(id % 5 = 0, null, double(id % 4))) as x",
    )
    scales = svr._scales(rows, keys)
    blocks = svr._blocks(rows.coalesce(1).sortWithinPartitions(*keys), keys, scales).collect()
    assert sum(b["size"] for b in blocks) == 3000
    assert len(blocks) == len(scales) == 4
    for b in blocks:
        z, y = (np.frombuffer(b[c]) for c in "zy")
        assert abs(z.reshape(b["size"], 2).mean(axis=0)).max() < 1e-9 and abs(y.mean()) < 1e-9
