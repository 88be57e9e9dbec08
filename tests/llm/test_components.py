"""Component rounds over several partitions, against union-find."""

import numpy as np

from millrace.llm import components as module


def test_rounds_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(module, "EDGES", 20)
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 150, (110, 2))]
    edges += [(i, i + 1) for i in range(200, 215)] + [(300, i) for i in range(280, 330)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = [tuple(r) for r in module.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert len(got) == len(linked)
    assert dict(got) == {x: find(x) for x in linked}
