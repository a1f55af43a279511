"""Cases that the derived panels do not hold."""

import pytest
from pyspark.sql import functions as F

from panelweave.operators import profile, ranking, reshape, rows
from panelweave.plans.restructure import restructure
from panelweave.sinks import writers
from panelweave.sources import documents, results


def panel_of(spark, cells):
    return spark.createDataFrame(cells, "entity long, indicator string, period int, value double")


def test_audit_counts_focus_cells_only(spark):
    cells = [(e, "a", 1, 1.0) for e in range(10)] + [(9, "b", 1, 2.0)]
    dim = spark.createDataFrame([("a", "s"), ("b", "s")], "indicator string, dataset string")
    focus = spark.createDataFrame([(1,), (2,)], "entity long")
    audit = profile.missing_audit(panel_of(spark, cells), dim, focus).collect()
    # "a" is complete in the focus set, "b" was never observed there
    assert [tuple(r) for r in audit] == [("s", 1, 2, False)]


def test_lookup_takes_the_first_row(spark):
    dim = spark.createDataFrame([("x", "zeta", 1), ("x", "alpha", 2)], "code string, set string, line int")
    found = rows.lookup(spark.createDataFrame([("x",)], "code string"), dim, "code", "set", ["line"])
    assert [tuple(r) for r in found.collect()] == [("x", "zeta")]


def test_quantiles_of_equal_values_are_one_row(spark):
    df = spark.range(100_000).select(
        F.lit("k").alias("k"), F.when(F.col("id") < 60_000, 5.0).otherwise(F.col("id") / 1000).alias("v")
    )
    import numpy as np

    got = ranking.quantiles(df, ["k"], "v", {"a": 0.05, "b": 0.5, "c": 0.6, "d": 0.95}).collect()
    values = np.where(np.arange(100_000) < 60_000, 5.0, np.arange(100_000) / 1000)
    assert tuple(got[0])[1:] == pytest.approx(np.quantile(values, [0.05, 0.5, 0.6, 0.95]))


def test_hot_keys_are_split_without_a_shuffle_by_key(spark):
    df = spark.range(10_000).select((F.col("id") % 10 > 0).cast("int").alias("k"), "id")
    salted = ranking.split_hot(df, ["k"], ["id"], 1500)
    sizes = {(r["k"], r["salt"]): r["count"] for r in salted.groupBy("k", "salt").count().collect()}
    assert len(sizes) == 1 + 6 and max(sizes.values()) < 2000
    import contextlib
    import io

    with contextlib.redirect_stdout(io.StringIO()) as plan:
        salted.explain()
    assert "Exchange" not in plan.getvalue()


def test_densify_deals_entities_into_groups(spark):
    panel = panel_of(spark, [(1, "a", 1, 1.0)])
    entities = spark.range(50).select(F.col("id").alias("entity"))
    labels = spark.createDataFrame([(f"i{k}", 1) for k in range(30)] + [("a", 1)], "indicator string, period int")
    cells = reshape.densify(panel, entities, labels, ["indicator", "period"], block=7, group=9)
    assert cells.count() == cells.select("entity", "indicator").distinct().count() == 50 * 31
    assert [tuple(r) for r in cells.where("value is not null").collect()] == [(1, "a", 1, 1.0)]


NAMES = ['plain', 'a "b", c', "two\nlines", "é, ü"]


def test_matrices_come_back_whatever_their_names(spark, tmp_path):
    filled = spark.createDataFrame(
        [("set, one", 2001, e, n, float(k) if e else None, None, 1.5) for e in (0, 1) for k, n in enumerate(NAMES)],
        "dataset string, period int, entity string, indicator string, value double, lower double, upper double",
    )
    importance = spark.createDataFrame(
        [("set, one", 2001, n, m, 0.5) for n in NAMES for m in NAMES if n != m],
        "dataset string, period int, target string, feature string, value double",
    )
    writers.write_matrices(filled, importance, str(tmp_path))
    back = results.scan_results(spark, str(tmp_path))
    keys = ["dataset", "period", "entity", "indicator", "value", "lower", "upper"]
    assert sorted(map(str, back.select(keys).collect())) == sorted(map(str, filled.select(keys).collect()))
    read = results.scan_importance(spark, str(tmp_path)).drop("line")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, importance.collect()))


def test_first_row_in_file_order_and_header_variants(spark, tmp_path):
    folder, heads = tmp_path / "predictions", tmp_path / "feature importances"
    for d in (folder, heads):
        d.mkdir()
    (folder / "s_predictions_2015.csv").write_text("Country Code,year,x\nA,2015,9\nA,2015,1\nB,2015,\n")
    (folder / "t_predictions_2010.csv").write_text(",Country Code,year,y,z\n0,A,2010,3,4\n")
    (heads / "s_feature_importance_2015.csv").write_text(
        ",predicted indicator,feature indicator,feature importance\n0,x,f,0.7\n1,x,f,0.1\n2,x,g,0.2\n")
    (heads / "t_feature_importance_2010.csv").write_text(",feature indicator,feature importance,predicted indicator\n0,f,1.0,y\n")
    for kind in ("lower", "upper"):
        (tmp_path / "prediction intervals" / kind).mkdir(parents=True)
        (tmp_path / "prediction intervals" / kind / f"s_{kind}_2015.csv").write_text("Country Code,,x\nA,2015,0.5\nA,2015,0.1\n")
    cells = results.scan_results(spark, str(tmp_path)).where("value is not null").collect()
    assert sorted((r["dataset"], r["period"], r["entity"], r["indicator"], r["value"], r["lower"]) for r in cells) == [
        ("s", 2015, "A", "x", 9.0, 0.5), ("t", 2010, "A", "y", 3.0, None), ("t", 2010, "A", "z", 4.0, None)
    ]
    # a feature without metadata has no category
    dim = spark.createDataFrame([("g", "c", "s")], "indicator string, category string, dataset string")
    restructure(spark, str(tmp_path), dim, str(tmp_path / "documents"), "m")
    stored = documents.scan_documents(spark, str(tmp_path / "documents")).where("indicator = 'x'").collect()
    found = stored[0]["document"].asDict(True)
    assert found["featureImportances"]["2015"] == {"f": 0.7, "g": 0.2}
    assert found["data"]["2015"]["A"] == 9.0 and found["categoryImportances"]["2015"] == {"c": 0.2}


def test_trees_of_one_target(spark):
    from panelweave.operators import trees

    rows = spark.range(120).select(
        F.col("id").alias("entity"),
        F.when(F.col("id") % 6 > 0, F.col("id") * 2.0).alias("y"),
        (F.col("id") % 5).cast("int").alias("fold"),
        F.when(F.col("id") % 7 > 0, F.col("id") * 1.0).alias("near"),
        (F.xxhash64("id") % 10).cast("double").alias("noise"),
    )
    out = trees.train(rows, ["near", "noise"], "forest", depths=(2, 4))
    shares = {r["feature"]: r["value"] for r in out.importances.collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares["near"] > shares["noise"]
    assert out.predictions.count() == 120 and out.grid.count() == 2
    with pytest.raises(ValueError):
        trees.train(rows, ["near"], "other")


def test_labelled_windows_shuffle_no_row_per_target_period(spark):
    from panelweave.operators import series

    spine = spark.createDataFrame([(1, 5, 2.0), (1, 6, 3.0), (None, 5, 4.0)], "entity long, window int, low double")
    windows = spark.createDataFrame([(p, "a", 5) for p in (7, 8)] + [(7, "b", 6), (7, None, 6)], "period int, target string, window int")
    panel = spark.createDataFrame(
        [(1, "a", 5, 1.5), (1, None, 6, 9.0), (None, "a", 5, 7.0)], "entity long, indicator string, period int, value double"
    )
    framed = series.labelled_windows(spine, windows, panel)
    found = sorted(((r.entity or 0, r.window, r.target or "", r.period, r.y or 0.0) for r in framed.collect()))
    assert found == [(0, 5, "a", 7, 0.0), (0, 5, "a", 8, 0.0), (1, 5, "a", 7, 1.5), (1, 5, "a", 8, 1.5), (1, 6, "", 7, 0.0), (1, 6, "b", 7, 0.0)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = series.labelled_windows(spine, windows, panel)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the join that multiplies rows is the last one and moves none of them
    assert plan.index("BroadcastHashJoin [window") < plan.index("SortMergeJoin")


def test_pivot_parts_follow_the_size(spark):
    from panelweave.operators import reshape

    panel = spark.range(4000).selectExpr("id div 4 as entity", "cast(id div 4 % 7 as int) as period", "concat('i', id % 4) as indicator", "double(id) as value")
    wide = reshape.pivot_panel(panel, part=100)
    assert wide.rdd.getNumPartitions() == 40
    assert wide.where("i3 = 4 * entity + 3 and i0 = 4 * entity").count() == 1000


def test_nearest_donors_are_exact_over_blocks_and_ties(spark):
    import numpy as np
    import pandas as pd

    from panelweave.operators import neighbours

    rng = np.random.default_rng(3)
    x = np.round(rng.random((300, 4)), 1)  # tenths, so that many distances are equal
    x[rng.random(x.shape) < 0.4] = np.nan
    x[rng.random(300) < 0.9, 3] = np.nan  # a label few donors have
    cells = [(1, e, f"i{f}", float(v)) for e, row in enumerate(x) for f, v in enumerate(row) if not np.isnan(v)]
    panel = spark.createDataFrame(cells, "period int, entity long, indicator string, value double")
    every = spark.range(300).selectExpr("1 as period", "id as entity")
    receivers = every.join(panel, ["period", "entity"], "left")
    found = neighbours.knn_cells(receivers, panel, ["period"], 5, receiver_rows=70, donor_rows=90)
    got = {(r.entity, r.indicator): r.value for r in found.collect()}
    seen, filled = ~np.isnan(x), np.nan_to_num(x)
    shared = seen.astype(float) @ seen.T
    square = (filled**2) @ seen.T + seen @ (filled**2).T - 2 * filled @ filled.T
    with np.errstate(all="ignore"):
        distance = np.where(shared > 0, np.round(np.maximum(square, 0) / shared, 9), np.inf)
    want = {}
    for e, f in zip(*np.nonzero(~seen)):
        near = sorted((distance[e, d], d) for d in np.nonzero(seen[:, f])[0] if np.isfinite(distance[e, d]))[:5]
        want[int(e), f"i{f}"] = np.mean([x[d, f] for _, d in near]) if near else np.nanmean(x[:, f])
    assert got.keys() == want.keys()
    assert max(abs(got[c] - want[c]) for c in want) < 1e-9
    # a missing cell leaves a block as one row, whatever the number of its donors
    blocks = pd.DataFrame(cells, columns=["period", "entity", "indicator", "value"]).groupby("entity")
    packed = pd.DataFrame({"entity": list(blocks.groups), "names": [g["indicator"].to_numpy() for _, g in blocks], "seen": [g["value"].to_numpy() for _, g in blocks]})
    parts = pd.concat(neighbours._candidates(packed, packed, 5))
    assert not parts.duplicated(["entity", "indicator"]).any()


def test_folds_of_several_names_take_one_ranking(spark, monkeypatch):
    from panelweave.operators import ranking

    calls = []
    monkeypatch.setattr(ranking, "cut", lambda df, name: calls.append(name) or df.localCheckpoint())
    df = spark.range(23).selectExpr("id", "id % 2 as k")
    found = ranking.kfolds(df, ["k"], ["id"], {"fold": 5, "third": 3})
    each = ranking.kfold(ranking.kfold(df, ["k"], ["id"], 5), ["k"], ["id"], 3, into="third")
    assert sorted(found.select("id", "fold", "third").collect()) == sorted(each.select("id", "fold", "third").collect())
    assert calls == ["ranked"] * 3  # one for both, and one for each


def test_stored_cells_count_in_the_order_of_files_and_lines_without_sorting(spark, tmp_path):
    from panelweave.sources import results

    folder = tmp_path / "predictions" / "dataset=d" / "period=2001"
    folder.mkdir(parents=True)
    (folder / "part-1.csv").write_text("Country Code,year,b,a\nx,2001,7,8\ny,2001,,4\n")
    (folder / "part-0.csv").write_text("Country Code,year,a\nx,2001,1\nx,2001,2\n")
    for kind in ("lower", "upper"):
        other = tmp_path / "prediction intervals" / kind / "dataset=d" / "period=2001"
        other.mkdir(parents=True)
        (other / "part-0.csv").write_text("Country Code,year,a\nx,2001,0.5\n")
    read = results.scan_results(spark, str(tmp_path))
    found = {(r.entity, r.indicator): (r.value, r.lower, r.upper) for r in read.collect()}
    assert found == {("x", "a"): (1.0, 0.5, 0.5), ("x", "b"): (7.0, None, None), ("y", "a"): (4.0, None, None), ("y", "b"): (None, None, None)}
    assert "SortAggregate" not in read._jdf.queryExecution().sparkPlan().toString()


def test_neighbour_blocks_grow_with_the_table_and_hold_no_names(spark, monkeypatch):
    from panelweave.operators import neighbours

    cells = [(e, f"f{j}", p, float((e * 7 + j * 13) % 29)) for p in (1, 2) for e in range(200) for j in range(6) if (e + j) % 5]
    panel = spark.createDataFrame(cells, "entity long, indicator string, period int, value double")
    dealt, plain = [], neighbours.salts_of

    def salts_of(df, keys, rows):
        dealt.append((rows, dict(df.dtypes)["names"]))
        return plain(df, keys, rows)

    monkeypatch.setattr(neighbours, "salts_of", salts_of)
    whole = sorted(map(tuple, neighbours.knn_cells(panel, panel, ["period"]).collect()))
    monkeypatch.setattr(neighbours, "LEAST_ROWS", 10)
    cut_up = sorted(map(tuple, neighbours.knn_cells(panel, panel, ["period"], donor_rows=60).collect()))
    assert whole == cut_up and len(whole) == 480
    tasks = neighbours.TASKS * spark.sparkContext.defaultParallelism
    assert [d[0] for d in dealt] == [1 << 13, 1 << 17, -(-400 // tasks), 60]
    assert {d[1] for d in dealt} == {"array<int>"}
