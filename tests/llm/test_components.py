import random

from ledgerhound.llm.components import components


def test_components_against_search(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(0, k) for k in range(300, 360)]
    edges += [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5), (None, 3), (4, None)]
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        stack = [start]
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = start
                stack += near[x]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").collect() == []
