import math

import numpy as np
import pytest

from quarry.operators import histogram_tree as H

COLS = ["a", "b", "c"]


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 40, n), rng.exponential(5, n).round(1), rng.integers(0, 2, n)]).astype(float)
    y = ((x[:, 0] > 17) ^ (x[:, 1] < 3) | (rng.random(n) < 0.1)).astype(float)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c double, label double")


def edges_by_hand(v, bins):
    v, n, out = np.sort(v), len(v), []
    for u in np.unique(v):
        upto, below = int((v <= u).sum()), int((v < u).sum())
        if upto * bins // n > below * bins // n and u < v[-1]:
            out.append(float(u))
    return out


def grow(x, y, edges, depth, kind, node=1, rows=None, out=None):
    out, rows = ({}, np.arange(len(x))) if out is None else (out, rows)
    imp = lambda p: (2 * p * (1 - p) if kind == "gini" else -sum(q * math.log2(q) for q in (p, 1 - p) if q > 0))
    p, best = y[rows].mean(), None
    if depth:
        for f in range(x.shape[1]):
            for e in edges[f]:
                left = rows[x[rows, f] <= e]
                if 0 < len(left) < len(rows):
                    right = np.setdiff1d(rows, left)
                    g = round(imp(p) - len(left) / len(rows) * imp(y[left].mean()) - len(right) / len(rows) * imp(y[right].mean()), 10)
                    if g > 0 and (best is None or g > best[0]):
                        best = (g, f, e, left, right)
    out[node] = (len(rows), int(y[rows].sum()), None if best is None else (COLS[best[1]], best[2]))
    if best:
        grow(x, y, edges, depth - 1, kind, 2 * node, best[3], out)
        grow(x, y, edges, depth - 1, kind, 2 * node + 1, best[4], out)
    return out


@pytest.mark.parametrize("kind,depth", [("entropy", 3), ("gini", 6)])
def test_tree_equals_exhaustive_search(spark, kind, depth):
    x, y = data()
    df = frame(spark, x, y)
    edges = [edges_by_hand(x[:, j], 8) for j in range(3)]
    assert H.bin_edges(df, COLS, 8) == dict(zip(COLS, edges))
    tree = H.fit_tree(df, COLS, max_depth=depth, bins=8, kind=kind)
    want = grow(x, y, edges, depth, kind)
    assert {k: (v.n, v.positives, (v.feature, v.threshold) if v.feature else None) for k, v in tree.nodes.items()} == want


def test_scores_at_every_depth_are_those_of_shallower_trees(spark):
    x, y = data()
    df = frame(spark, x, y)
    deep = H.fit_tree(df, COLS, max_depth=5, bins=16)
    got = {(r["depth"], r["id"]): r["score"] for r in H.score_depths(df, deep, [0, 1, 3, 5, 9]).collect()}
    assert len(got) == 5 * len(x)
    for d in (1, 3):
        own = H.fit_tree(df, COLS, max_depth=d, bins=16)
        for r in H.score_depths(df, own, [d]).collect():
            assert got[d, r["id"]] == r["score"]
    assert all(got[9, i] == got[5, i] and got[0, i] == y.mean() for i in range(len(x)))
    # a deeper tree fits its training rows no worse
    hit = lambda d: sum((got[d, i] > 0.5) == (y[i] > 0.5) for i in range(len(x)))
    assert hit(5) >= hit(3) >= hit(1) and hit(5) > 0.8 * len(x)


def test_odd_rows_pure_nodes_and_empty_tables(spark):
    x, y = data(60)
    df = frame(spark, x, y)
    extra = spark.createDataFrame([(900, None, 1.0, 1.0, 1.0), (901, 1.0, float("nan"), 1.0, 1.0), (902, 1.0, 1.0, 1.0, None)], df.schema)
    a, b = H.fit_tree(df, COLS, max_depth=3), H.fit_tree(df.unionByName(extra), COLS, max_depth=3)
    assert a.nodes == b.nodes
    assert list(H.fit_tree(df.withColumn("label", df.label * 0), COLS).nodes) == [1]
    none = H.fit_tree(df.limit(0), COLS)
    assert none.nodes[1].n == 0 and H.score_depths(df, none, [2]).count() == 60
    with pytest.raises(ValueError):
        H.fit_tree(df, COLS, kind="wrong")
