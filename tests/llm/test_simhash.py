import re

import numpy as np
import pytest
import xxhash

from panelweave.llm import simhash


def brute(rows, radius=4):
    fps = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
        hs = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
        fps[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    group = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= radius and group[b] < group[a]:
                    group[a], changed = group[b], True
    return fps, group


def found(df):
    rows = df.collect()
    return {r["id"]: r["fp"] % (1 << 64) for r in rows}, {r["id"]: r["component"] for r in rows}


@pytest.mark.parametrize("slice_rows", [16_384, 3])
def test_groups_equal_brute_force(docs_of, corpus, slice_rows):
    assert found(simhash.near_groups(docs_of(corpus), slice_rows=slice_rows)) == brute(corpus)


def test_links_of_random_fingerprints(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 40)
    fps = [int(f) ^ (1 << int(rng.integers(60))) ^ (1 << int(rng.integers(60))) for f in base for _ in range(12)]
    fps = sorted(set(fps))
    reps = spark.createDataFrame([(f, k) for k, f in enumerate(fps)], "fp long, node long")
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
    for slice_rows in (7, 10_000):
        links = [(r.src, r.dst) for r in simhash.links(reps, 4, slice_rows).collect()]
        own = list(range(len(fps)))
        for s, d in links:
            assert (fps[s] ^ fps[d]).bit_count() <= 4 or label[s] == label[d]
            x, y = own[s], own[d]
            own = [min(x, y) if v in (x, y) else v for v in own]
        assert own == label


def test_repeated_rows_nulls_and_empty(docs_of):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (9, None), (7, "")]
    out = sorted(
        ((r["id"], r["component"]) for r in simhash.near_groups(docs_of(rows)).collect()), key=str
    )
    assert out == [(5, 5), (5, 5), (7, 7), (9, 7), (None, None)]
    assert simhash.near_groups(docs_of([])).collect() == []


def test_keep_one(docs_of, corpus):
    docs = docs_of([*corpus, corpus[0], (None, corpus[0][1])])
    _, group = brute(corpus)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == sorted(set(group.values()))
    assert out.where("doc_id is null").count() == 1
    assert simhash.keep_one(docs_of([])).collect() == []
