import collections
import math
import re
import zlib

import numpy as np
import pytest

from panelweave.llm import ngram
from panelweave.llm.elias_fano import EliasFano, load, save


@pytest.mark.parametrize("n,bound", [(0, 1), (1, 1 << 64), (1000, 1 << 64), (5000, 6000), (3000, 1 << 40), (10, 10), (1, 1)])
def test_elias_fano(n, bound, tmp_path):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, bound - 1, n, dtype=np.uint64, endpoint=True))
    level = EliasFano.build(values, bound)
    save(f"{tmp_path}/x/level", level.arrays("v") | {"more": np.arange(3, dtype=np.uint16)})
    arrays = load(f"file://{tmp_path}/x/level")
    level = EliasFano.of(arrays, "v")
    assert arrays["more"].tolist() == [0, 1, 2]
    assert (level.access(np.arange(len(values))) == values).all()
    places = {v: k for k, v in enumerate(values.tolist())}
    queries = np.unique(np.concatenate([values, values ^ np.uint64(1), values ^ np.uint64(1 << 20)]))
    queries = queries[queries < np.uint64(bound - 1)] if bound < 1 << 64 else queries
    assert level.find(queries).tolist() == [places.get(q, -1) for q in queries.tolist()]
    half = len(values) // 2
    later = level.find(queries, half, np.full(len(queries), len(values)))
    assert later.tolist() == [k if k >= half else -1 for k in (places.get(q, -1) for q in queries.tolist())]


def test_trie_finds_words_behind_their_context():
    rng = np.random.default_rng(1)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 90, (2000, 2))})
    context, word = map(np.array, zip(*pairs))
    score = -rng.random(len(pairs)) * 10
    shard = ngram.Shard(ngram.Shard.arrays(context, word, score, 100))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(100), np.arange(100)))
    want = dict(zip(pairs, score))
    for got, pair in zip(shard.find(a, b), zip(a.tolist(), b.tolist())):
        assert np.isnan(got) if pair not in want else abs(got - want[pair]) <= ngram.STEP
    empty = ngram.Shard(ngram.Shard.arrays(*(np.array([], int),) * 2, np.array([]), 100))
    assert np.isnan(empty.find(np.array([1]), np.array([2]))).all()


def brute(rows):
    words = lambda t: [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [None]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    one, two, behind = collections.Counter(), collections.Counter(), collections.Counter()
    for d, t, *_ in rows:
        if not held(d):
            w = words(t)
            one.update(w)
            two.update(zip(["start", *w], w))
            behind.update(["start", *w[:-1]])
    n, v = sum(one.values()), len(one)
    out = []
    for d, t, *_ in rows:
        w = words(t)
        p = [(one[x] + 1) / (n + v + 1) for x in w]
        score = sum(
            math.log10((two[c, x] + ngram.PULL * q) / (behind[c] + ngram.PULL)) for c, x, q in zip(["start", *w], w, p)
        )
        out.append((d, held(d), len(w), sum(one[x] > 0 for x in w), n, sum(map(math.log10, p)), score))
    return out


def same(got, want):
    got, want = (sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[6])) for x in (got, want))
    assert [tuple(r)[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-6)
        assert g[6] == pytest.approx(w[6], abs=ngram.STEP * w[2] + 1e-6)


def test_equals_brute_force(docs_of, corpus):
    rows = [*corpus, corpus[0], corpus[1], (None, "the of the"), (1000, "The the " * 400)]
    want = brute(rows)
    assert any(r[1] for r in want)
    same(ngram.scores(docs_of(rows)).collect(), want)


def test_small_chunks_and_shards(docs_of, corpus, monkeypatch):
    monkeypatch.setattr(ngram, "CHUNK", 300)
    same(ngram.scores(docs_of(corpus), shard_tokens=900, hot=40).collect(), brute(corpus))


def test_rows_of_null_and_repeated_ids_have_scores_of_their_own(docs_of):
    rows = [(None, "a b c d"), (None, "a"), (None, None), (5, "a b"), (5, "a b c a b"), (5, "a b"), (7, "b a " * 400)]
    got = ngram.scores(docs_of(rows), shard_tokens=300, hot=40).collect()
    assert sorted(r.n_tokens for r in got if r.id is None) == [1, 2, 5]
    same(got, brute(rows))


def test_empty(docs_of):
    assert ngram.scores(docs_of([])).collect() == []
    only_held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    same(ngram.scores(docs_of([(only_held, "a b")])).collect(), brute([(only_held, "a b")]))


def test_a_row_costs_little_for_each_shard(spark, docs_of, monkeypatch):
    sent = []
    frame, grouped = type(spark.range(0)), type(spark.range(0).groupBy("id"))
    plain_map, plain_groups = frame.mapInArrow, grouped.applyInArrow

    def counter():
        sent.append(spark.sparkContext.accumulator(0))
        return sent[-1]

    def counted_map(self, fn, schema, *more, **named):
        size = counter()

        def run(batches):
            for batch in fn(batches):
                size.add(batch.nbytes)
                yield batch

        return plain_map(self, run, schema, *more, **named)

    def counted_groups(self, fn, schema):
        size = counter()

        def run(key, rows):
            out = fn(key, rows) if fn.__code__.co_argcount == 2 else fn(rows)
            size.add(out.nbytes)
            return out

        return plain_groups(self, run, schema)

    monkeypatch.setattr(frame, "mapInArrow", counted_map)
    monkeypatch.setattr(grouped, "applyInArrow", counted_groups)
    rng = np.random.default_rng(8)
    docs = docs_of([(k, " ".join(f"w{x}" for x in rng.integers(0, 300, 150))) for k in range(240)])
    size, shards = [], []
    for tokens in (1_000_000, 1_000):
        sent.clear()
        total = ngram.scores(docs, shard_tokens=tokens).collect()[0].train_tokens
        size.append(sum(x.value for x in sent))
        shards.append(1 + total // tokens)
    assert shards[0] == 1 and shards[1] > 25
    assert size[1] - size[0] <= 30 * 240 * (shards[1] - 1)
