import random

import pytest

from lumetry.llm import graph
from lumetry.llm.common import importable


def smallest(links):
    up = {x: x for pair in links for x in pair}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {x: root(x) for x in up}


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    importable(spark)
    random_ = random.Random(5)
    links = {
        "random": [(random_.randrange(300), random_.randrange(300)) for _ in range(160)],
        "path": [(i, i + 1) for i in random_.sample(range(64), 64)],
        "star": [(77, i) for i in range(100, 160)] * 2 + [(3, 3)],
        "none": [],
    }[kind]
    frame = spark.createDataFrame(links, "a LONG, b LONG").repartition(7)
    rows = graph.components(frame).collect()
    found = {r["id"]: r["component"] for r in rows}
    want = {x: c for x, c in smallest([p for p in links if p[0] != p[1]]).items()}
    assert len(rows) == len(found)
    assert found == want
