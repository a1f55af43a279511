import hashlib
import re

import pytest

from panelweave.llm import spotsigs

ANCHORS = set(spotsigs.ANCHORS)


def signatures(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    content, out, k = [w for w in words if w not in ANCHORS], set(), 0
    for w in words:
        if w in ANCHORS:
            if k + spotsigs.CHAIN <= len(content):
                out.add((w, *content[k : k + spotsigs.CHAIN]))
        else:
            k += 1
    return out or ({tuple(words)} if words else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_signatures_of_a_sentence(spark):
    text = "At a rally to kick off a weeklong campaign for the South Carolina primary"
    assert ("for", "south", "carolina") in signatures(text) and ("a", "weeklong", "campaign") in signatures(text)
    df = spark.createDataFrame([(text,), (text.upper(),), ("no anchors",), ("",), (None,), ("the",)], "text string")
    found = [r["s"] for r in spotsigs.with_signatures(df, "text", "s").collect()]
    assert found[0] == found[1] and [len(s) for s in found] == [len(signatures(text))] * 2 + [1, 0, 0, 1]


@pytest.mark.parametrize("bucket_rows", [1500, 9])
def test_edited_texts(docs_of, corpus, monkeypatch, bucket_rows):
    monkeypatch.setattr(spotsigs.with_next, "__defaults__", (bucket_rows,))
    rows = sorted((d, t or "") for d, t, _ in corpus)
    got = {r["id"]: r for r in spotsigs.edited(docs_of(corpus)).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for k, (d, t) in enumerate(rows):
        follows, n, r = rows[(k + 1) % len(rows)][1], len(t), got[d]
        edited = t[: n - n // 2] + follows[: n // 2]
        a, b, c = signatures(t), signatures(edited), signatures(follows)
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(jaccard(a, b)) and r["near_next"] == pytest.approx(jaccard(a, c))
        assert (len(r["fingerprint"]), len(r["edited_fingerprint"])) == (8 * len(a), 8 * len(b))
        by_text.setdefault(t, set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_single_repeated_and_empty(docs_of):
    one = spotsigs.edited(docs_of([(1, "the one two three")])).collect()
    assert [(r["near_edited"], r["near_next"]) for r in one][0][1] == 1.0
    again = spotsigs.edited(docs_of([(1, "a b"), (1, "a b"), (None, None)])).collect()
    assert len(again) == 3
    assert spotsigs.edited(docs_of([])).collect() == []


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_near_pairs(docs_of, corpus, least):
    near = [(1000 + k, corpus[k][1] + " and some more", "s") for k in (9, 10, 11, 12)]
    corpus = [*corpus, *near]
    docs = docs_of(corpus).select("doc_id", "text").withColumnRenamed("doc_id", "id")
    sets = spotsigs.with_signatures(docs, "text", "signatures")
    got = {(r["left"], r["right"]): r["likeness"] for r in spotsigs.near_pairs(sets, least).collect()}
    classes = {}
    for d, t, _ in sorted(corpus, key=lambda r: r[0]):
        if signatures(t):
            classes.setdefault(frozenset(signatures(t)), d)
    ids = [(d, s) for s, d in classes.items()]
    want = {(a, b): jaccard(s, t) for a, s in ids for b, t in ids if a < b and jaccard(s, t) >= least}
    assert got == pytest.approx(want) and want
