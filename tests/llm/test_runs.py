import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from panelweave.llm import runs


def brute(words, least=6, times=4):
    """(start, length, period) of every run, by comparing words each period apart."""
    n, spans = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= 2 * q:
                spans.setdefault((i, length), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, m, q) for (s, m), q in spans.items() if m >= max(least, times * q))


def expected(words, least=6, times=4):
    rows = brute(words, least, times)
    gone = {k for s, m, q in rows for k in range(s + q, s + m)}
    top = min(rows, key=lambda r: (-r[1], r[0], r[2])) if rows else (None,) * 3
    return (
        len(rows), *top, 1000 * top[1] // top[2] if rows else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in rows).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest(),
    )


def texts():
    rnd = random.Random(3)
    out = [[b"a"] * k for k in range(9)] + [[b"a", b"b"] * 9, [b"a", b"b"] * 9 + [b"a"], [b"x", *[b"a", b"a", b"b"] * 6, b"a", b"y"]]
    for _ in range(400):
        alphabet = [bytes([97 + k]) for k in range(rnd.choice([1, 2, 2, 3, 5]))]
        word = [rnd.choice(alphabet) for _ in range(rnd.randrange(1, 7))]
        text = []
        while len(text) < rnd.randrange(60):
            text += word * rnd.randrange(1, 8) + [rnd.choice(alphabet) for _ in range(rnd.randrange(3))]
        out.append(text)
    return out


@pytest.mark.parametrize("times, least", [(4, 6), (2, 1), (3, 5)])
def test_equals_brute_force(times, least):
    found = runs.runs_of(texts(), times, least)
    for text, rows in zip(texts(), found):
        assert [tuple(r) for r in rows.tolist()] == brute(text, least, times), text


def test_small_and_large_stretches_give_the_same(monkeypatch):
    monkeypatch.setattr(runs, "TOGETHER", 1)
    for text, rows in zip(texts(), runs.runs_of(texts())):
        assert [tuple(r) for r in rows.tolist()] == brute(text)


def test_extensions_and_lyndon_words():
    rnd = random.Random(9)
    for _ in range(60):
        text = [rnd.randrange(1, 4) for _ in range(rnd.randrange(2, 40))] + [0]
        found = runs.Extensions(text)
        pairs = [(i, j) for i in range(len(text)) for j in range(len(text)) if i != j]
        got = found.between(*np.array(pairs).T).tolist()
        for (i, j), size in zip(pairs, got):
            k = 0
            while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            assert size == k
        assert sorted(range(len(text)), key=lambda i: text[i:]) == np.argsort(found.rank).tolist()
        for i, size in enumerate(runs.longest_lyndon(found.rank.tolist()).tolist()[:-1]):
            lyndon = [m for m in range(1, len(text) - i) if all(text[i : i + m] < text[i + k : i + m] for k in range(1, m))]
            assert size == max(lyndon)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in runs.op13_runs(spark, sf).collect()}
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' where length(text) < 60000").fetchall()
    changed = 0
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        if len(words) < 1500:
            assert got[doc_id] == expected(words)
    assert changed > 5 and sum(r[0] > 0 for r in got.values()) > 5


def test_rows(spark, docs_of, corpus):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a " * 50_000), (None, "b " * 7), (None, "b " * 7), (5, "b " * 7 + "é\xa0é " * 8)]
    got = sorted((tuple(r) for r in runs.detect(docs_of(rows)).collect()), key=str)
    want = [(i, *expected((t or "").encode().split())) for i, t in rows if i != 4]
    assert [g for g in got if g[0] != 4] == sorted(want, key=str)
    assert next(g for g in got if g[0] == 4)[1:6] == (1, 0, 50_000, 1, 50_000_000)
    assert runs.detect(docs_of(rows).limit(0)).collect() == []
    for row, (_, text, _) in zip(runs.detect(docs_of(corpus)).orderBy("id").collect(), sorted(corpus)):
        if text is None or len(text) < 20_000:
            assert tuple(row)[1:] == expected((text or "").encode().split())
