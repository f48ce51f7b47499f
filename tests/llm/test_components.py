import random

from lodestrata.llm.components import components
from lodestrata.llm.storage import Workspace


def test_long_chain_and_random_edges(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(300)] + [(1000 + rng.randrange(200), 1000 + rng.randrange(200)) for _ in range(150)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components(Workspace(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()
    seen = {x for e in edges if e[0] != e[1] for x in e}
    assert len(found) == len(seen) and all(r["component"] == find(r["node"]) for r in found)


def test_no_edges(spark):
    assert components(Workspace(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0
