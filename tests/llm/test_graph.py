from __future__ import annotations

import random

from coldloop.llm.graph import components


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    links += [(7, 7), (None, 3), (3, None)]
    parent = {x: x for pair in links for x in pair if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b and None not in (a, b) for x in (a, b)}
    assert {r.id: r.component for r in got} == {x: find(x) for x in linked}
    assert len(got) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
