import math

import numpy as np

from quarry.llm import grid_order_join as G


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, t=0.9):
    n = len(rows)
    link = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if usable(a) and usable(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= t:
                    link[i].add(j)
                    link[j].add(i)
    comp = list(range(n))
    for _ in range(n):
        new = [min([comp[i], *[comp[j] for j in link[i]]]) for i in range(n)]
        if new == comp:
            break
        comp = new
    least = {}
    for i in range(n):
        least[comp[i]] = min(least.get(comp[i], rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(link[i]), least[comp[i]], least[comp[i]] == rows[i][0]) for i in range(n))


def make_rows():
    r = np.random.default_rng(5)
    rows = []
    for _ in range(90):
        c = r.normal(size=12)
        for _ in range(int(r.integers(1, 5))):
            v = c + r.normal(size=12) * r.choice([0.05, 0.3])
            rows.append(v * r.uniform(0.1, 9))
    hot = r.normal(size=12)
    rows += [hot + r.normal(size=12) * 0.1 for _ in range(150)]
    rows += [hot] * 40
    out = [[float(np.float32(x)) for x in v] for v in rows]
    order = r.permutation(len(out))
    out = [(int(k), out[i]) for k, i in enumerate(order)]
    n = len(out)
    return out + [(n, None), (n + 1, []), (n + 2, [0.0] * 12), (n + 3, [1.0] * 11 + [float("nan")]), (n + 4, [1.0] * 11 + [None]),
                  (n + 5, [float("inf")] * 12), (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.1]), (n + 8, [-1.0, 0.0]), (n + 9, [3.0])]


def test_matches_brute_force(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(tuple(r) for r in G.near_vectors(df, block=32, leaf=8, tile=3).collect())
    assert got == sorted(tuple(r) for r in G.near_vectors(df, block=16, leaf=16, tile=1).collect())
    exact = [(k, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None) for k, v in rows]
    assert got == brute(exact)


def test_pruning_skips_distant_blocks(spark):
    r = np.random.default_rng(1)
    boxes = [(i, 2, *[list(map(float, b)) for b in G._boxes(np.array([[i, 0.0], [i + 0.5, 0.2]]))]) for i in range(40)]
    df = spark.createDataFrame(boxes, "block long, dim int, lo array<double>, hi array<double>")
    got = {(x["block"], x["other"]) for x in G.block_pairs(df, 0.6).collect()}
    assert got == {(i, j) for i in range(40) for j in (i, i + 1) if j < 40}
    y = r.normal(size=(100, 3))
    cells = G.join_intervals((0, 100), (0, 100), y, y, 10.0, 16)
    assert sum((j - i) * (m - k) for i, j, k, m in cells) >= 100 * 99 // 2


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, kept int")
    assert G.near_vectors(df).count() == 0
    df = spark.createDataFrame([(3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)],
                               "vec_id long, embedding array<double>, kept int")
    assert sorted((tuple(r) for r in G.near_vectors(df).collect()), key=str) == sorted(
        [(3, 1, 3, True), (3, 1, 3, True), (None, 0, None, True)], key=str)


def test_very_large_and_very_small_vectors(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [5e-170, 5e-170]), (5, [1.0, 1.0]), (6, [1e-320, 1e-320]),
            (7, [1.7e308, 1.7e308]), (8, [1e200, -1e200]), (9, [1.0, 0.0]), (10, [0.0, 0.0])]
    out = {r["vec_id"]: r for r in G.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(out[k]["component_id"] == 1 and out[k]["n_links"] == 6 for k in range(1, 8))
    assert [out[k]["n_links"] for k in (8, 9, 10)] == [0, 0, 0]


def test_cosines_at_the_threshold_do_not_depend_on_blocks(spark):
    # 0.9 exactly: (9, ...) against the first axis, in many block shapes
    v = [9.0, math.sqrt(19.0)] + [0.0] * 10
    rows = [(i, [1.0] + [0.0] * 11) if i % 2 else (i, [x * (1 + i) for x in v]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    a, b = (sorted(tuple(r) for r in G.near_vectors(df, block=k, leaf=3).collect()) for k in (7, 64))
    assert a == b


def test_blocks_keep_their_precision():
    x = np.array([0.1, 0.25, 3.0])
    assert np.frombuffer(G._unpacked(G._packed(x.tobytes()), 1, 3)).tolist() == x.tolist()
    y = np.array([0.5, 0.25, 3.0])
    assert len(G._packed(y.tobytes())) == 12 and np.frombuffer(G._unpacked(G._packed(y.tobytes()), 1, 3)).tolist() == y.tolist()
