import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, hits int, component int, turn int, size int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names operators use inside."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 1, 2, 3, 4)
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, odd white space, nulls, an empty and a very long text."""
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "é", "Tä") for b in ("ra", "so", "ti", "wé", "zu", ",", ".", "")]
    common = ["the", "of", "and", "de", "la", "der"]

    def text(n):
        return " ".join(rnd.choice(common) if rnd.random() < 0.3 else rnd.choice(words) + str(rnd.randrange(40)) for _ in range(n))

    passage = text(70)
    rows = [(k, text(rnd.randrange(1, 150)), f"s{k % 3}") for k in range(0, 80, 2)]
    rows += [(k, rows[k % 7][1], "s1") for k in range(1, 14, 2)]
    rows += [(15, rows[3][1] + " more", "s2"), (17, rows[3][1].upper(), "s2")]
    rows += [(k, text(20) + "\n" + passage + "\t" + text(k % 30), "s0") for k in range(19, 39, 2)]
    rows += [(39, None, "s0"), (41, "", "s0"), (43, " \n\t ", None), (45, text(9000), None), (47, "x", "only")]
    rows += [(49, "a\x0bb\x0cc\xa0d e <|endoftext|> \U0001f600 日本語", "s0")]
    return rows
