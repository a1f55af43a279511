import numpy as np
import pytest

from pyspark.sql import functions as F

from panelweave.llm import mixing
from panelweave.llm.common import few_rows


def test_targets_are_held_to_three_times_the_size():
    assert mixing.targets([60, 60, 60], [1, 2, 3]) == [30.0, 60.0, 90.0]
    # the last source stops at 30; the rest is shared again by weight
    assert mixing.targets([100, 100, 10], [1, 2, 3]) == [60.0, 120.0, 30.0]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0.0, 0.0]
    assert sum(mixing.targets([5, 0, 1000, 3], [1, 2, 3, 1])) == pytest.approx(1008)


def test_query_form(docs_of, corpus):
    rows = {r["id"]: r for r in mixing.mix(docs_of(corpus), block=16, shard=8, bucket=5).collect()}
    sizes = {d: len((t or "").encode().split()) for d, t, _ in corpus}
    assert {d: r["size"] for d, r in rows.items()} == sizes
    by = {}
    for d, _, s in corpus:
        by.setdefault(s, []).append(d)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    aims = mixing.targets([sum(sizes[d] for d in by[s]) for s in order], [(1, 2, 3)[k % 3] for k in range(len(order))])
    for s, aim in zip(order, aims):
        assert all(rows[d]["target"] == pytest.approx(aim) for d in by[s])
        assert sum(rows[d]["taken"] for d in by[s]) == round(aim)
        assert {rows[d]["source_size"] for d in by[s]} == {sum(sizes[d] for d in by[s])}
    assert all(r["taken"] <= 3 * r["size"] for r in rows.values())
    again = {r["id"]: r for r in mixing.mix(docs_of(corpus[::-1]).repartition(3), block=16, shard=8, bucket=5).collect()}
    assert again == rows


def test_draws_are_disjoint_and_shards_even(docs_of, corpus):
    rows = mixing.sized(docs_of(corpus), "doc_id", "text", "source")
    drawn = mixing.draws(rows, mixing.plan(rows), block=16, shard=32, bucket=5).toPandas()
    assert not drawn.duplicated(["row", "turn", "block"]).any()
    per = drawn.groupby("shard").size()
    assert per.max() - per.min() <= 1 and len(per) == -(-len(drawn) // 32)
    for _, part in drawn.groupby("shard"):
        assert sorted(part["place"]) == list(range(len(part)))


def test_tree_splits_exactly():
    tree = mixing.Tree([1000, 10, 300], 50, 3)
    shards = [tree.shard_of(k, np.arange(n)) for k, n in enumerate((1000, 10, 300))]
    assert all((np.diff(s) >= 0).all() for s in shards)
    sizes = np.bincount(np.concatenate(shards))
    assert sizes.sum() == 1310 and sizes.max() - sizes.min() <= 1
    # tasks that see other ranks agree
    assert (mixing.Tree([1000, 10, 300], 50, 3).shard_of(0, np.arange(700, 720)) == shards[0][700:720]).all()
    pool = np.array([3 * 10**9, 10**9])
    drawn = mixing._draw(pool, 10**9, np.random.default_rng(1))
    assert drawn.sum() == 10**9 and abs(drawn[0] - 75 * 10**7) < 10**6


def test_draw_is_hypergeometric():
    mean = np.mean([mixing.Tree([600, 200], 400, seed).shard_of(1, np.arange(200)).sum() for seed in range(200)])
    assert mean == pytest.approx(100, abs=3)


def test_documents_of_the_mix(docs_of, corpus):
    docs = docs_of([*corpus, corpus[1], (None, "one two three", "s1")])
    out = mixing.mixed_docs(docs, block=16, shard=8, bucket=5)
    assert out.columns == docs.columns
    rows = out.collect()
    whole = {(d, t) for d, t, _ in corpus}
    per_source = {}
    for r in rows:
        per_source[r["source"]] = per_source.get(r["source"], 0) + len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
        full = dict(whole).get(r["doc_id"]) or "one two three"
        pieces = full.encode().split()
        if r["text"] != full:
            assert set(r["text"].encode().split()) <= set(pieces)
    sizes = mixing.plan(mixing.sized(docs, "doc_id", "text", "source"))
    assert per_source == {s: round(aim) for s, _, _, aim in sizes if round(aim)}


def test_empty(docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    assert mixing.mixed_docs(docs_of([])).collect() == []
    assert [tuple(r) for r in mixing.mix(docs_of([(1, None, None)])).collect()] == [(1, 0, 0, 0.0, 0, 0, None, None)]


def test_shards_and_places_make_the_result(docs_of, corpus):
    """The query's further columns, computed again from the placed blocks one by one."""
    options = {"block": 16, "shard": 8, "bucket": 5}
    rows = mixing.sized(docs_of(corpus), "doc_id", "text", "source")
    drawn = mixing.draws(rows, mixing.plan(rows), **options).toPandas()
    want = {}
    for (doc,), part in drawn.groupby(["id"]):
        want[doc] = (int(part["words"].sum()), part["shard"].nunique(), int(part["shard"].min()))
    got = {r["id"]: (r["taken"], r["n_shards"], r["first_shard"]) for r in mixing.mix(docs_of(corpus), **options).collect()}
    assert {d: g for d, g in got.items() if g[0]} == want and max(g[1] for g in got.values()) > 3
    placed = {r["id"]: r["placement"] for r in mixing.mix(docs_of(corpus), **options).collect() if r["taken"]}
    other = {r["id"]: r["placement"] for r in mixing.mix(docs_of(corpus), **{**options, "shard": 16}).collect() if r["taken"]}
    assert len(set(placed.values())) == len(placed) and sum(placed[d] != other[d] for d in placed) > 0.9 * len(placed)


def test_a_very_long_text(docs_of):
    (r,) = mixing.mix(docs_of([(1, "word " * 300_000)])).collect()
    assert (r["size"], r["taken"], r["first_shard"]) == (300_000, 300_000, 0)


def test_clashing_names(docs_of, corpus):
    docs = docs_of(corpus)
    for name in ("__row", "__turn", "__words", "__BLOCKS"):
        docs = docs.withColumn(name, F.lit(7))
    out = mixing.mixed_docs(docs)
    assert out.columns == docs.columns
    assert {tuple(r)[-4:] for r in out.collect()} == {(7, 7, 7, 7)}
    assert out.count() == mixing.mixed_docs(docs_of(corpus)).count()


def test_sources_reach_tasks_without_python_workers_of_their_own(spark, docs_of, corpus, monkeypatch):
    docs, real, kinds = docs_of(corpus), type(spark).createDataFrame, []
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: kinds.append(type(data)) or real(self, data, *a, **b))
    assert mixing.mixed_docs(docs, block=16).count() and mixing.mix(docs, block=16).count()
    assert kinds and list not in kinds
    few = few_rows(spark, [(None, 1, 2.5), ("s", 2, None)], "a string, b long, c double")
    assert sorted(map(tuple, few.collect()), key=str) == [("s", 2, None), (None, 1, 2.5)]
    assert "PythonRDD" not in few._jdf.queryExecution().toRdd().toDebugString()
    assert few_rows(spark, [], "a string, b long").collect() == []
