import random

import pytest

from leadpipe.llm import neardup


def by_hand(edges):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {x: top(x) for x in root}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, frame, kind):
    draw = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(50, i) for i in range(50)] + [(60, 61)],
        "random": [(draw.randint(0, 80), draw.randint(0, 80)) for _ in range(70)],
        "none": [],
    }[kind]
    edges = [(f"{a:03}", f"{b:03}") for a, b in edges if a != b]
    with neardup.scratch_tables(spark) as save:
        rows = neardup.components(frame(edges, "a string, b string"), save).collect()
    assert {r.node: r.root for r in rows} == by_hand(edges)
