import random

from panelweave.llm.components import components


def test_chains_stars_and_random_links(spark):
    rnd = random.Random(8)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 540)] + [(700, 700), (None, 3)]
    links += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(70)]
    group = {x: x for link in links for x in link if None not in link and link[0] != link[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in group and b in group and group[a] != group[b]:
                group[a] = group[b] = min(group[a], group[b])
                changed = True
    got = components(spark.createDataFrame(links, "src long, dst long")).collect()
    assert len(got) == len(group) and {r["node"]: r["component"] for r in got} == group
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []
