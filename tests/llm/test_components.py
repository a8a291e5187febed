"""Connected components against union-find."""

import random

import pytest

from tidewatch.llm.components import connected_components
from tidewatch.llm.store import Scratch


def find(links):
    comp = {}
    for a, b in links:
        comp.setdefault(a, a)
        comp.setdefault(b, b)

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a, b in links:
        x, y = root(a), root(b)
        comp[max(x, y)] = min(x, y)
    return {x: root(x) for x in comp}


def cases():
    r = random.Random(9)
    yield [(i, i + 1) for i in range(200)]
    yield [(r.randrange(300), r.randrange(300)) for _ in range(160)]
    yield [(500, k) for k in range(150)] + [(7, 7)]
    yield [(i, 300 - i) for i in range(150)] + [(2 * i, 2 * i + 2) for i in range(100)]


@pytest.mark.parametrize("links", list(cases()))
def test_equals_union_find(spark, links):
    df = spark.createDataFrame(links + links[:3], "a long, b long")
    got = {r.id: r.component for r in connected_components(df, Scratch(spark, "cc-test"), "t").collect()}
    assert got == find([x for x in links if x[0] != x[1]])


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "cc-test"), "e").collect() == []
