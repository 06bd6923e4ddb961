import random

from meterline.llm.components import components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(5, None), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(links, "a long, b long")
    ).collect()}
    assert found == {x: find(x) for x in parent}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
