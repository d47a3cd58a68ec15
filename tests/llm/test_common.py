import numpy as np
import pandas as pd
import pytest

from quarry.llm import common as C


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = np.random.default_rng(seed)
    n, m = 300, (150, 280, 600)[seed]
    edges = [(int(a), int(b)) for a, b in r.integers(0, n, (m, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 90)]  # a chain and a star
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    got = {x["node"]: x["label"] for x in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_components_of_nothing(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_complete_groups_over_batches():
    pdf = pd.DataFrame({"k": [1, 1, 2, 2, 2, 2, 3, 4, 4], "v": range(9)})
    for cut in range(1, 9):
        batches = [pdf.iloc[i:i + cut] for i in range(0, 9, cut)]
        got = list(C.complete_groups(iter([pdf.iloc[:0], *batches]), ["k"]))
        assert pd.concat(got)["v"].tolist() == list(range(9))
        ends = [set(g["k"]) for g in got]
        assert all(not a & b for i, a in enumerate(ends) for b in ends[i + 1:])


def test_free_name():
    assert C.free_name(["__X", "y"], "__x") == "___x"
