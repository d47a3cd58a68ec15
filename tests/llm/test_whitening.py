import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening as W
from quarry.llm.common import table
from quarry.llm.queries import op13_embedding_whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>"


def cases():
    rng = np.random.default_rng(3)
    even = rng.standard_normal((400, 24))
    yield even
    yield even * np.logspace(0, -5, 24)                       # widely spread
    yield np.repeat(even[:, :8], 3, axis=1)                   # dependent dimensions
    yield np.vstack([np.eye(12), -np.eye(12)])                # one eigenvalue, many times
    yield even[:6]                                            # fewer vectors than dimensions
    yield np.hstack([even[:, :3], np.zeros((400, 4))])        # constant dimensions
    yield np.hstack([even[:, :1] * 1e5, even[:, 1:5], even[:, 5:6] * 1e-2])


@pytest.mark.parametrize("i", range(7))
def test_eigenpairs_equal_a_dense_solver(i):
    v = np.cov(list(cases())[i].T, bias=True)
    e, x = W.leading_eigenpairs(v, 16)
    want = np.linalg.eigvalsh(v)[::-1]
    assert len(e) == min(16, int((want > 1e-11 * want[0]).sum()))
    assert np.abs(e - want[:len(e)]).max() <= 1e-12 * want[0]
    assert (np.diff(e) <= 1e-12 * want[0]).all()
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-12
    assert np.abs(v @ x - x * e).max() <= 1e-12 * want[0]


def test_inertia_counts_signs():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 10, 40):
        a = rng.standard_normal((n, n))
        a = a + a.T
        w = np.linalg.eigvalsh(a)
        assert W.inertia(a) == (int((w > 0).sum()), int((w < 0).sum()))
    assert W.inertia(np.zeros((3, 3))) == (0, 0)
    assert W.inertia(np.array([[0.0, 2.0], [2.0, 0.0]])) == (1, 1)


def brute(rows, k=16):
    kept = {i: v for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in kept.items()}
    fit = sorted(set(map(tuple, x.values())))
    n, d = len(fit), len(fit[0])
    s = [sum(f[j] for f in fit) for j in range(d)]
    y = np.array([[n * f[j] - s[j] for j in range(d)] for f in fit], dtype=object)
    v = np.array([[float(sum(y[:, a] * y[:, b])) / n / n / n for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(v)
    dev = {i: sum((n * a - b) ** 2 for a, b in zip(f, s)) for i, f in x.items()}
    mean = {i: np.array([float(n * a - b) / n for a, b in zip(f, s)]) for i, f in x.items()}
    return n, dev, mean, v, e[::-1][:k], u[:, ::-1][:, :k]


def compare(got, rows):
    n, dev, mean, v, e, u = brute(rows)
    by = {(r["vec_id"], r["component"]): r for r in got}
    rank = max(r["component"] for r in got)
    assert len(by) == len(got) == rank * len(dev)
    for c in range(rank):
        w = {i: float(mean[i] @ u[:, c]) / math.sqrt(e[c]) for i in dev}
        big = max(w, key=lambda i: abs(w[i]))
        sign = math.copysign(1, w[big] * by[big, c + 1]["whitened"])
        for i in dev:
            r = by[i, c + 1]
            assert r["n"] == n and r["deviation"] == dev[i]
            assert abs(r["whitened"] - sign * w[i]) < 1e-6
            assert abs(r["explained"] - e[c] / np.trace(v)) < 1e-9
            assert 0 <= r["identity_error"] <= 1e-9


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table(spark, SF_SMALL, "embeddings").collect()]
    got = op13_embedding_whitening(spark, SF_SMALL).collect()
    assert max(r["component"] for r in got) == 16
    compare(got, rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    rows = good + [(100, good[0][1]), (101, None), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [1.0, float("nan"), 1.0, 1.0, 1.0]),
                   (104, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (105, []), (106, [0.0] * 5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("n", F.lit(1))
    compare(W.whiten(df).collect(), rows)
    # other lengths than the commonest are left out
    mixed = spark.createDataFrame(rows + [(200, [1.0, 2.0])], SCHEMA)
    assert {r["vec_id"] for r in W.whiten(mixed).collect()} == {i for i, _ in good} | {100, 106}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        out = W.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.columns[:3] == ["vec_id", "component", "n"] and out.count() == 0


def test_repeats_weigh_once_and_null_keys_stay(spark):
    rng = np.random.default_rng(4)
    base = [(i, rng.standard_normal(4).tolist()) for i in range(30)]
    once = W.whiten(spark.createDataFrame(base, SCHEMA)).collect()
    hot = W.whiten(spark.createDataFrame(base + [(None, base[0][1])] * 500, SCHEMA)).collect()
    assert {r["n"] for r in hot} == {30} and sum(r["vec_id"] is None for r in hot) == 4 * 500
    a = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in once}
    for r in hot:
        if r["vec_id"] is not None:
            assert abs(abs(r["whitened"]) - a[r["vec_id"], r["component"]]) < 1e-9


def test_deviations_beyond_64_bits_are_exact_digits(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 5.0])]
    got = {r["vec_id"]: r for r in W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    _, dev, *_ = brute(rows)
    assert got[1]["deviation"] is None and int(got[1]["deviation_digits"]) == dev[1]
    assert got[3]["deviation"] == dev[3] and got[3]["deviation_digits"] is None
    W.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], SCHEMA)).collect()
