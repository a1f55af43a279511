import random

import numpy as np
import pytest

from panelweave.llm import quality


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(6)
    common = sorted(quality.COMMON)
    word = lambda: "".join(rnd.choice(("ka", "lo", "mi", "ne", "ru")) for _ in range(rnd.randint(1, 3)))
    plain = lambda: " ".join(rnd.choice(common) if rnd.random() < 0.35 else word() for _ in range(120))
    good = [plain() for _ in range(160)]
    low = [t.upper() for t in good[:10]] + [" | ".join(word() for _ in range(80)) for _ in range(10)]
    low += [" ".join(w + "###" for w in t.split()) for t in good[10:20]] + [("same " * 90) for _ in range(5)]
    # a mark that only judgements know
    toxic = [plain() + " qqxa" + word() + " you idiot moron" for _ in range(20)] + [plain() + " qqxa" + word() + " qqxa" + word() for _ in range(30)]
    return good, low, toxic


def test_rejects_and_keeps(spark, docs_of, texts):
    good, low, toxic = texts
    rows = [(k, t) for k, t in enumerate(good + low + toxic)]
    kind = ["good"] * len(good) + ["low"] * len(low) + ["toxic"] * len(toxic)
    judged = [(k, int(x != "low"), int(x == "toxic")) for k, x in enumerate(kind) if k % 3]
    labels = spark.createDataFrame(judged, "doc_id long, quality int, toxic int")
    docs = docs_of([*rows, (None, None), (9999, ""), (10_000, "a " * 30_000)])
    classifier = quality.fit(docs, quality.judgements(labels))
    kept = quality.keep_good(docs, classifier)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    held_out = [k for k in range(len(rows)) if k % 3 == 0]
    assert all(k in ids for k, x in enumerate(kind) if x == "good")
    for x in ("low", "toxic"):
        some = [k for k in held_out if kind[k] == x]
        assert sum(k not in ids for k in some) >= 0.9 * len(some), x
    scores = {r["id"]: (r["low"], r["toxic"]) for r in classifier.score(docs).collect()}
    assert len(scores) == docs.select("doc_id").distinct().count()
    for k, (p, q) in scores.items():
        if k is not None:
            assert (k in ids) == (p < quality.LIMITS["low"] and q < quality.LIMITS["toxic"])


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    n, right = 20_000, np.array([0.95, 0.8, 0.7])
    truth = rng.random(n) < 0.3
    patterns = {}
    for y in truth:
        votes = [int(y) if rng.random() < a else 1 - int(y) for a in right]
        votes = [quality.NONE if rng.random() < 0.3 else v for v in votes]
        key = "".join(map(str, votes)) + (str(int(y)) if rng.random() < 0.2 else "2")
        patterns[key] = patterns.get(key, 0) + 1
    model = quality.LabelModel(patterns)
    assert model.bad == pytest.approx(0.3, abs=0.03)
    share = [1 - 0.3, 0.3]
    for s, a in enumerate(right):
        for k in (0, 1):
            precision = share[k] * a / (share[k] * a + share[1 - k] * (1 - a))
            assert model.accuracies()[s][k] == pytest.approx(precision, abs=0.05)
    assert model.labels["1112"] > 0.9 > 0.1 > model.labels["0002"]


def test_empty_and_unjudged(spark, docs_of, texts):
    empty = quality.fit(docs_of([]))
    assert quality.keep_good(docs_of([(1, "fine words"), (2, None)]), empty).count() == 2
    good, low, _ = texts
    docs = docs_of([(k, t) for k, t in enumerate(good + low)])
    kept = {r["doc_id"] for r in quality.keep_good(docs, quality.fit(docs)).collect()}
    assert kept >= set(range(len(good)))
    assert sum(k in kept for k in range(len(good), len(good) + len(low))) <= 0.3 * len(low)


def test_rows_judged_by_labellers_alone_teach_the_scorer(spark, docs_of, texts):
    good, low, _ = texts
    docs = docs_of([(k, t) for k, t in enumerate(good + low)])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(100)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.keep_good(docs, quality.fit(docs, quality.judgements(labels))).collect()}
    assert kept >= set(range(len(good)))
    assert sum(k in kept for k in range(len(good), len(good) + len(low))) <= 0.3 * len(low)


def test_judges_accuracy_is_estimated_and_silence_on_other_languages():
    patterns = {"1112": 300, "0002": 600, "1111": 90, "0000": 180, "0001": 20, "1110": 10}
    model = quality.LabelModel(patterns)
    assert model.accuracies().shape[0] == 4
    assert 0.8 < model.accuracies()[3][1] < quality.JUDGED
    no_insult = quality.LABELLERS["toxic"]["no insult"]
    assert no_insult(quality.Shape("the cat is on the mat")) == quality.GOOD
    assert no_insult(quality.Shape("el gato es de la casa")) == quality.NONE


def test_the_task_that_fits_gets_slots_and_no_texts(spark, docs_of, texts, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    real, columns = DataFrame.groupBy, []
    monkeypatch.setattr(DataFrame, "groupBy", lambda self, *by: columns.append((by, self.columns)) or real(self, *by))
    quality.fit(docs_of([(k, t) for k, t in enumerate(texts[0][:20])]))
    assert [c for by, c in columns if by == ("one",)] == [["one", "id", "slots", "low", "toxic"]]
