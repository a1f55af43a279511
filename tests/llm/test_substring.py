import hashlib
import re

import pytest
from pyspark.sql import functions as F

from panelweave.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    seen, out = {}, {}
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if seen.setdefault(key, d) < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [50, 8])
def test_equals_brute_force(docs_of, corpus, window):
    got = {r["id"]: tuple(r)[1:] for r in substring.digest(docs_of(corpus), window=window).collect()}
    assert got == brute(corpus, window)


def test_small_chunks_and_many_partitions(docs_of, corpus, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", 400)
    monkeypatch.setattr(substring, "PART_BYTES", 5000)
    got = {r["id"]: tuple(r)[1:] for r in substring.digest(docs_of(corpus), window=10).collect()}
    assert got == brute(corpus, 10)


def test_one_word_again_and_again(docs_of):
    rows = [(1, "a " * 120), (2, "a " * 49), (3, "b " + "a " * 60 + "b")]
    got = {r["id"]: tuple(r)[1:3] for r in substring.digest(docs_of(rows)).collect()}
    assert got == {1: (120, 0), 2: (49, 0), 3: (62, 60)}


def test_text_keeps_its_white_space(docs_of):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, passage), (2, f"one\ttwo \n{passage}  three\nfour"), (3, passage), (4, "one\ttwo"), (5, None), (6, ""), (None, passage)]
    docs = docs_of([*rows, rows[0]])
    out = substring.dedup_text(docs)
    assert out.columns == docs.columns
    texts = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str)
    want = [(1, passage, len(passage))] * 2 + [
        (2, "one\ttwo\nthree\nfour", 18), (4, "one\ttwo", 7), (5, None, None), (6, "", 0), (None, passage, len(passage))
    ]
    assert texts == sorted(want, key=str)


def test_empty(docs_of):
    assert substring.digest(docs_of([])).collect() == []
    assert substring.dedup_text(docs_of([])).collect() == []
    assert [tuple(r)[1:3] for r in substring.digest(docs_of([(None, "a b")])).collect()] == [(2, 0)]


def test_run_again_in_another_chunk_of_a_long_text(docs_of):
    long = [f"w{k}" for k in range(550_000)]
    long[525_000:525_025] = long[25:50]  # aligned in the first chunk and in the second
    rows = [(1, " ".join(long)), (2, " ".join(["a"] + long[1:51] + ["b"]))]
    got = {r["id"]: tuple(r)[1:3] for r in substring.digest(docs_of(rows).coalesce(1)).collect()}
    assert got == {1: (550_000, 0), 2: (52, 50)}


class Recorder:
    """Stands in for a table and keeps the function that its rows are to be mapped by."""

    def mapInArrow(self, fn, schema):  # noqa: N802
        self.fn = fn
        return self

    def groupBy(self, *by):  # noqa: N802
        return self

    def applyInArrow(self, fn, schema):  # noqa: N802
        return self


@pytest.mark.parametrize("step", [substring.block_hits, substring.repeated_windows])
def test_what_tasks_settle_is_dealt_over_the_keys(docs_of, step):
    parts, tasks = 64, 16
    passage = " ".join(f"w{k}" for k in range(60))
    rows = docs_of([(k, passage) for k in range(tasks * 4)]).select("doc_id", "text")
    rows = rows.repartitionByRange(tasks, "doc_id").withColumn("hits", F.expr("X'00000000'"))
    probe = Recorder()
    step(probe, 50, parts)
    keys = rows.select("doc_id", "text", "hits").mapInArrow(probe.fn, substring.BLOBS).where(f"part >= {parts}")
    found = [r["part"] for r in keys.where("length(pos) > 0").collect()]
    assert len(found) >= tasks / 2 and max(found) < 2 * parts
    assert max(found.count(k) for k in found) <= len(found) / 3


def test_clashing_names(docs_of, corpus):
    plain, docs = docs_of(corpus), docs_of(corpus)
    for name in ("__id", "__HITS"):
        docs = docs.withColumn(name, F.lit(7))
    out = substring.dedup_text(docs)
    assert out.columns == docs.columns and {tuple(r)[-2:] for r in out.collect()} == {(7, 7)}
    assert sorted(map(str, out.select(plain.columns).collect())) == sorted(map(str, substring.dedup_text(plain).collect()))


def test_dedup_text_reads_the_joined_rows_with_one_python_evaluation(docs_of, corpus):
    out = substring.dedup_text(docs_of(corpus), window=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("EvalPython|MapInArrow", plan)) == 1


def test_dedup_text_drops_rows_without_text_and_counts_characters(spark):
    words = " ".join(f"wé{k}" for k in range(30))
    rows = [(1, words), (2, words), (3, None), (4, ""), (5, "x " + words + " y"), (5, None), (None, words)]
    docs = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, n_chars int")
    got = sorted(map(tuple, substring.dedup_text(docs, window=10).collect()), key=str)
    assert got == sorted([(1, words, 7), (3, None, 7), (4, "", 7), (5, "x\ny", 3), (None, words, 7)], key=str)
