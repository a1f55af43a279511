import numpy as np
import pytest

from panelweave.operators import intervals


def test_across_trees(spark):
    rnd = np.random.default_rng(3)
    votes = rnd.normal(size=(20, 50))
    rows = [(r, t, float(votes[r, t])) for r in range(20) for t in range(50)] + [(99, 0, 4.0)]
    got = {r["row"]: r for r in intervals.across_trees(spark.createDataFrame(rows, "row int, tree int, value double"), ["row"]).collect()}
    for r in range(20):
        want = [votes[r].mean(), *np.quantile(votes[r], [0.05, 0.95])]
        assert [got[r]["prediction"], got[r]["lower"], got[r]["upper"]] == pytest.approx(want)
    assert tuple(got[99])[1:] == (4.0, 4.0, 4.0)


def test_leaf_quantiles_cover_and_never_cross(spark):
    """Rows of one distribution: nine in ten labels lie between their leaves' bounds."""
    rnd = np.random.default_rng(4)
    x, y = rnd.integers(0, 8, 4_000), rnd.normal(size=4_000)
    y = y * (1 + x) + 10 * x
    given = [(k, t, int((x[k] + t) % 8), float(y[k])) for k in range(4_000) for t in range(3)]
    frame = spark.createDataFrame(given, "row int, tree int, leaf int, y double")
    index = intervals.leaf_quantiles(frame.where("row < 3000"), ["tree", "leaf"])
    found = intervals.from_leaves(frame.where("row >= 3000").drop("y"), ["row"], index, ["tree", "leaf"]).collect()
    assert len(found) == 1_000 and all(r["lower"] <= r["upper"] for r in found)
    assert np.mean([r["lower"] <= y[r["row"]] <= r["upper"] for r in found]) == pytest.approx(0.9, abs=0.03)
    for r in intervals.leaf_quantiles(frame, ["tree", "leaf"]).collect():
        mine = y[(x + r["tree"]) % 8 == r["leaf"]]
        assert [r["lower"], r["upper"], r["n"]] == pytest.approx([*np.quantile(mine, [0.05, 0.95]), len(mine)])


def test_bootstrap_agrees_with_simulation(spark):
    rnd = np.random.default_rng(6)
    groups = {"wide": rnd.normal(size=200) * 10, "skewed": rnd.exponential(size=90) + 5, "ties": np.repeat([1.0, 2.0, 7.0], 20), "two": np.array([1.0, 3.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("one", 1.0), ("wide", None)]
    frame = spark.createDataFrame(rows, "target string, residual double")
    got = {r["target"]: (r["lower"], r["upper"]) for r in intervals.bootstrap_offsets(frame, ["target"]).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        draws = rnd.choice(values, size=(40_000, 100))
        want = np.quantile(draws, [0.05, 0.95], axis=1).mean(axis=1)
        assert np.allclose(got[name], want, atol=0.01 * (values.max() - values.min()))
    counts = frame.groupBy("target").count().withColumnRenamed("count", "n")
    assert [r["target"] for r in intervals.skipped(counts, ["target"]).collect()] == ["one"]


def test_fallback_and_sources(spark):
    schema = "row int, lower double, upper double"
    first = spark.createDataFrame([(1, 0.0, 2.0), (2, None, None)], schema)
    second = spark.createDataFrame([(1, 5.0, 6.0), (2, 1.0, 3.0), (3, 2.0, 4.0)], schema)
    got = intervals.fallback(first, second, ["row"]).orderBy("row").collect()
    assert [tuple(r) for r in got] == [(1, 0.0, 2.0, "first"), (2, 1.0, 3.0, "second"), (3, 2.0, 4.0, "second")]
    assert intervals.source_of("linear") == "residuals" and intervals.source_of("forest") == "trees"
