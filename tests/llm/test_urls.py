import random
import re

from panelweave.llm import urls


def test_globs_equal_regular_expressions():
    rnd = random.Random(3)
    patterns = ["".join(rnd.choice("ab*") for _ in range(rnd.randint(0, 9))) for _ in range(80)]
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 14))) for _ in range(300)] + [""]
    globs = urls.Globs([p.encode() for p in patterns])
    assert globs.words > 1
    found = globs.match([t.encode() for t in texts], step=37)
    for i, text in enumerate(texts):
        for j, pattern in enumerate(patterns):
            assert found[i, j] == bool(re.fullmatch(pattern.replace("*", ".*"), text)), (text, pattern)
    assert urls.Globs([]).match([b"a"]).shape == (1, 0)


CASES = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://NET/", "net", "/", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("http://a.net?x=/en/", "a.net", "", None, "allow"),
    ("https://Example.NET/en/1#top", "example.net", "/en/1", "example.net/en/", "allow"),
    ("https://www.example.net/en/", "www.example.net", "/en/", "example.net/en/", "allow"),
    ("https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("https://example.com/de/a?b", "example.com", "/de/a", "example.com/de/", "block"),
    ("https://example.com/DE/", "example.com", "/DE/", None, "allow"),
    ("https://x.org/fr/é", "x.org", "/fr/é", "org/fr/", "allow"),
    ("https://evil.com/x.net/en/", "evil.com", "/x.net/en/", None, "allow"),
    ("http://spam-farm.example.org/en/", "spam-farm.example.org", "/en/", None, "block"),
    ("no scheme.net/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://", "", "", None, "allow"),
    ("http://" + "a." * 5000 + "net/" + "p/" * 5000, "a." * 5000 + "net", "/" + "p/" * 5000, "net/", "block"),
]


def test_rules(spark):
    pages = spark.createDataFrame(
        [(k, c[0], "h", "x") for k, c in enumerate(CASES)] + [(None, CASES[0][0], "h", "x"), (0, CASES[0][0], "h", "x")],
        "page_id long, url string, html string, host string",
    )
    got = sorted(map(tuple, urls.judge(pages).collect()), key=str)
    want = [(k, *c[1:]) for k, c in enumerate(CASES)] + [(None, *CASES[0][1:]), (0, *CASES[0][1:])]
    assert got == sorted(want, key=str)
    assert urls.judge(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in urls.judge(pages, rules=(), blocked_hosts=()).collect()} == {"allow"}
