"""Components against union-find."""

from __future__ import annotations

import random

import pytest

from riskloom.llm.components import components


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_as_union_find(spark, kind):
    r = random.Random(5)
    links = {
        "random": [(r.randrange(300), r.randrange(300)) for _ in range(220)],
        "path": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(200)] + [(None, 3), (4, None)],
        "none": [],
    }[kind]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {tuple(x) for x in got} == {(i, find(i)) for i in up}
    assert len(got) == len(up)
