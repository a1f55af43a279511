import numpy as np
import pytest

from panelweave.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, id string, node int, n int, cell int"


def brute(rows, cosine=0.9):
    ok = {}
    for v, e in rows:
        if v is not None and e is not None and all(x is not None and np.isfinite(x) for x in e) and any(e):
            x = np.array(e, np.float32).astype(float)
            ok[v] = x / np.linalg.norm(x)
    ids = sorted(ok)
    links = {v: [w for w in ids if w != v and len(ok[w]) == len(ok[v]) and ok[v] @ ok[w] >= cosine] for v in ids}
    group = {v: v for v, _ in rows if v is not None}
    changed = True
    while changed:
        changed = False
        for v in ids:
            low = min([group[v], *(group[w] for w in links[v])])
            changed |= low < group[v]
            group[v] = low
    return {v: (len(links.get(v, [])), group[v], group[v] == v) for v in group}


def table(spark, rows):
    return spark.createDataFrame([(v, e, 1, "x", 2, 3, 4) for v, e in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    near = [b + rng.normal(size=16) * s for b in base[:25] for s in (0.1, 0.15, 0.2, 0.3)]
    out = [x.astype(np.float32).tolist() for x in [*base, *near, *base[:5], *(3 * base[5:8])]]
    rng.shuffle(out)
    odd = [None, [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [], [1.0, 0.0], [2.0, 0.1]]
    return [(k, e) for k, e in enumerate(out + odd)]


@pytest.mark.parametrize("cell,slice_rows", [(2000, 2048), (20, 7)])
def test_equals_brute_force(spark, rows, monkeypatch, cell, slice_rows):
    monkeypatch.setattr(embeddings, "CELL", cell)
    monkeypatch.setattr(embeddings, "SLICE", slice_rows)
    got = {r["id"]: tuple(r)[1:] for r in embeddings.near_vectors(table(spark, rows)).collect()}
    assert got == brute(rows)


def test_repeated_rows_and_empty(spark, rows):
    some = [*rows[:20], rows[0], (None, rows[0][1])]
    got = [tuple(r) for r in embeddings.near_vectors(table(spark, some)).collect()]
    want = brute(rows[:20])
    assert sorted(got, key=str) == sorted([(v, *want[v]) for v, _ in some[:-1]] + [(None, 0, None, True)], key=str)
    assert embeddings.near_vectors(table(spark, [])).collect() == []


def test_cells_are_fitted_at_every_size(spark, rows):
    classes = embeddings.usable(table(spark, rows), "vec_id", "embedding").where("size(v) = 16").withColumnRenamed("id", "node")
    assert len(embeddings.centres(classes, 16, classes.count())) > 1


def test_vectors_are_dealt_once_for_each_slice(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 10)
    monkeypatch.setattr(embeddings, "SLICE", 100)
    rng = np.random.default_rng(8)
    rows = [(k, x.tolist()) for k, x in enumerate(rng.normal(size=(600, 8)).astype(np.float32))]
    made = spark.sparkContext.accumulator(0)
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def counted(self, fn, schema, *more, **named):
        def run(batches):
            for batch in fn(batches):
                made.add(batch.column("v").nbytes if "v" in batch.schema.names else 0)
                yield batch

        return plain(self, run, schema, *more, **named)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    got = {r["id"]: tuple(r)[1:] for r in embeddings.near_vectors(table(spark, rows)).collect()}
    assert got == brute(rows)
    # no vector goes to most of the 60 cells: the table of homes, and at most seven slices
    assert made.value < 8 * 600 * 8 * 8
